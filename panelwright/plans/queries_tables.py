"""Scans, cleaning, reshaping, joins, grid (S*, P*, J*, A1, A15, A16, W7, W8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import scalars as X
from ..operators import clean, grid, joins, reshape
from ..operators.aggregates import mean_of_numeric, spatial_mean
from ..operators.joins import bucket_join
from ..operators.keywords import first_keyword_of_table
from ..operators.series import entity_stats, fill_linear, row_frames, step_change, trailing_mean
from ..session import materialise, scratch_path
from ..sources import tables
from ..sources.lookups import name_codes
from . import inputs as I
from .registry import query


@query("scan_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv(spark, sf):
    """A table written as CSV and read back as text, then typed."""
    path = tables.export_text(I.table(spark, sf, "supplier"), scratch_path(spark, "supplier"))
    text = tables.read_text_table(spark, "supplier", path)
    return text.select(
        X.to_number("s_suppkey").cast("long").alias("s_suppkey"), "s_name",
        X.to_number("s_nationkey").cast("int").alias("s_nationkey"),
        X.to_number("s_acctbal").alias("s_acctbal"),
    )


@query("scan_csv_latin1", """
SELECT c_custkey AS id, 'Côte ' || c_name || ' é' AS label, c_mktsegment AS segment FROM customer
""")
def scan_csv_latin1(spark, sf):
    """Latin-1 CSV whose columns are named by position."""
    raw = I.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("a"), F.concat(F.lit("Côte "), "c_name", F.lit(" é")).alias("b"),
        F.col("c_mktsegment").alias("segment"))
    path = tables.export_text(raw, scratch_path(spark, "customer"), tables.LATIN1)
    text = tables.read_text_table(spark, "customer", path, tables.LATIN1, by_position=["id", "label"])
    return text.withColumn("id", X.to_number("id").cast("long"))


@query("write_read_panel", "WITH " + I.PANEL + """
SELECT e, strftime(t, '%Y-%m') AS month, CAST(year(t) AS INTEGER) AS y, v_cents FROM panel
WHERE year(t) >= 1998
""")
def write_read_panel(spark, sf):
    """The panel stored by year; the reload prunes partitions."""
    panel = I.monthly_panel(spark, sf).select(
        "e", X.month_text("t").alias("month"), "v_cents", F.year("t").alias("y"))
    path = tables.write_table(panel, scratch_path(spark, "panel"), ["y"])
    return tables.read_table(spark, "panel", path).filter("y >= 1998").select("e", "month", "y", "v_cents")


def _stored(spark, sf, name):
    """The monthly panel stored by year, bucketed by nation and sorted by month."""
    panel = I.monthly_panel(spark, sf).withColumn("y", F.year("t"))
    return tables.store_panel(panel, name, scratch_path(spark, name), ["e"], "t", 8, ["y"])


@query("stored_rolling", "WITH " + I.PANEL + """
SELECT e, strftime(t, '%Y-%m') AS month, v, round_even(avg(v) OVER (w ROWS 2 PRECEDING), 4) AS v_avg_3,
       round_even(v - lag(v) OVER w, 4) AS step
FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)
""")
def stored_rolling(spark, sf):
    """Series features of a reloaded panel need no exchange."""
    frames = {"v_avg_3": trailing_mean("v", 3), "step": step_change("v")}
    panel = _stored(spark, sf, "panel_rolling").select("e", "t", "v")
    made = row_frames(panel, ["e"], "t", frames, before=3, bounded=True)
    return made.select("e", X.month_text("t").alias("month"), "v", *[X.round_even(c).alias(c) for c in frames])


@query("stored_join", "WITH " + I.PANEL + "," + I.SPARSE + """
SELECT p.e, strftime(p.t, '%Y-%m') AS month, p.v, s.p1, s.p3
FROM panel p LEFT JOIN sparse s ON p.e = s.e AND year(p.t) = s.y
""")
def stored_join(spark, sf):
    """Monthly and annual panels stored with the same buckets meet without an exchange."""
    annual = I.annual_sparse(spark, sf).select("e", "y", "p1", "p3")
    annual = tables.store_panel(annual, "annual_join", scratch_path(spark, "annual_join"), ["e"], "y", 8)
    return bucket_join(_stored(spark, sf, "panel_join"), annual, ["e"], ["y"]).select(
        "e", X.month_text("t").alias("month"), "v", "p1", "p3")


@query("pruned_periods", "WITH " + I.PANEL + """,
best AS (SELECT year(t) AS y FROM panel GROUP BY 1 ORDER BY sum(v_cents) DESC, y LIMIT 2)
SELECT e, strftime(t, '%Y-%m') AS month, v_cents, CAST(year(t) AS INTEGER) AS y FROM panel WHERE year(t) IN (SELECT y FROM best)
""")
def pruned_periods(spark, sf):
    """The two best years, found by a query, are the only partitions of the stored panel read."""
    panel = _stored(spark, sf, "panel_pruned")
    best = panel.groupBy("y").agg(F.sum("v_cents").alias("total")).orderBy(F.desc("total"), "y").limit(2)
    kept = joins.prune_to(panel, best, "y")
    return kept.select("e", X.month_text("t").alias("month"), "v_cents", "y")


@query("export_selection", "WITH " + I.SCORED + """
SELECT e, strftime(t, '%Y-%m') AS month, class FROM scored WHERE class IN ('High', 'Extreme')
""")
def export_selection(spark, sf):
    """A filtered selection exported as CSV, read back."""
    chosen = I.scored_panel(spark, sf).filter(F.col("class").isin("High", "Extreme")).select(
        "e", X.month_text("t").alias("month"), "class")
    path = tables.export_text(chosen, scratch_path(spark, "selection"))
    back = tables.read_text_table(spark, "selection", path)
    return back.select(F.col("e").cast("int").alias("e"), "month", "class")


@query("json_run_log", "WITH " + I.PANEL + """
SELECT count(*) AS data_rows, 4 AS data_columns, count(DISTINCT e) AS countries,
       strftime(min(t), '%Y-%m-%d') || ' to ' || strftime(max(t), '%Y-%m-%d') AS date_range,
       0.5::DOUBLE AS f1, 1.25::DOUBLE AS rmse
FROM panel
""")
def json_run_log(spark, sf):
    """Run record appended as a JSON line, read back."""
    record = tables.run_record(
        I.monthly_panel(spark, sf), {"Forest": {"f1_weighted": 0.5, "accuracy": 0.75}},
        {"Ridge": {"RMSE": 1.25, "MAE": 1.0, "R2": 0.5}}, "e", "t")
    path = scratch_path(spark, "runs")
    tables.append_run(record, path)
    back = spark.read.schema(record.schema).json(path)
    return back.select(
        "data_rows", "data_columns", "countries", "date_range",
        F.col("classification")["Forest"]["f1_weighted"].alias("f1"),
        F.col("regression")["Ridge"]["RMSE"].alias("rmse"))


@query("clean_indicators", "WITH " + I.CLEAN + " SELECT e AS entity, ind_score, ind_raw, plain, price FROM clean")
def clean_indicators(spark, sf):
    """P1, P3, P5-P7, P9, T1, T15."""
    return clean.clean_indicators(I.dirty_indicators(spark, sf), {"e": "entity", "absent": "x"}, "entity")


@query("sentinel_exact", "WITH " + I.DIRTY + """
SELECT e, nullif(plain, 9999) AS plain, nullif(ind_raw, 9999) AS ind_raw, nullif(price, 9999) AS price FROM dirty
""")
def sentinel_exact(spark, sf):
    """P6b."""
    return clean.blank_sentinel_everywhere(I.dirty_indicators(spark, sf).drop("ind_score"))


@query("round_numeric_cols", """
SELECT s_suppkey, s_name, s_nationkey, round_even(s_acctbal / 7, 4) AS share FROM supplier
""")
def round_numeric_cols(spark, sf):
    """P13."""
    supplier = I.table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", (F.col("s_acctbal") / 7).alias("share"))
    return clean.round_numeric(supplier)


@query("two_pass_median_fill", "WITH " + I.CLEAN + """,
pass1 AS (
  SELECT e, price,
         coalesce(ind_score, median(ind_score) OVER (PARTITION BY e)) AS ind_score,
         coalesce(ind_raw, median(ind_raw) OVER (PARTITION BY e)) AS ind_raw FROM clean
)
SELECT e, price, round_even(coalesce(ind_score, (SELECT median(ind_score) FROM pass1)), 6) AS ind_score,
       round_even(coalesce(ind_raw, (SELECT median(ind_raw) FROM pass1)), 6) AS ind_raw
FROM pass1
""")
def two_pass_median_fill(spark, sf):
    """W8, A3, T26."""
    cleaned = clean.clean_indicators(I.dirty_indicators(spark, sf), {}, "e").drop("plain")
    filled = clean.fill_two_pass(materialise(cleaned), "e", ["ind_score", "ind_raw"])
    return filled.withColumns({c: X.round_even(c, 6) for c in ("ind_score", "ind_raw")})


@query("two_pass_empty_entity", "WITH " + I.CLEAN + """,
holes AS (SELECT e, price, CASE WHEN e % 5 <> 3 THEN ind_raw END AS ind_raw FROM clean),
pass1 AS (SELECT e, price, coalesce(ind_raw, median(ind_raw) OVER (PARTITION BY e)) AS ind_raw FROM holes)
SELECT e, price, round_even(coalesce(ind_raw, (SELECT median(ind_raw) FROM pass1)), 6) AS ind_raw FROM pass1
""")
def two_pass_empty_entity(spark, sf):
    """Entities without any value take the median of the filled column."""
    cleaned = clean.clean_indicators(I.dirty_indicators(spark, sf), {}, "e").select("e", "price", "ind_raw")
    holes = cleaned.withColumn("ind_raw", F.when(F.col("e") % 5 != 3, F.col("ind_raw")))
    filled = clean.fill_two_pass(materialise(holes), "e", ["ind_raw"])
    return filled.withColumn("ind_raw", X.round_even("ind_raw", 6))


@query("group_mean_all_numeric", """
SELECT l_returnflag, l_linestatus, round_even(avg(l_quantity), 4) AS l_quantity,
       round_even(avg(l_extendedprice), 4) AS l_extendedprice, round_even(avg(l_discount), 4) AS l_discount,
       round_even(avg(l_tax), 4) AS l_tax, round_even(avg(l_linenumber), 4) AS l_linenumber
FROM lineitem GROUP BY 1, 2
""")
def group_mean_all_numeric(spark, sf):
    """A1, P9, T13."""
    line = I.table(spark, sf, "lineitem")
    return mean_of_numeric(line, ["l_returnflag", "l_linestatus"], ["l_orderkey", "l_partkey", "l_suppkey"])


# "small bolt" is shadowed by "small"; many parts match nothing
PART_KEYWORDS = [("small", "little"), ("WIDGET", "widget"), ("small bolt", "never"), ("Promo", "offer"), ("gear", "gear")]


@query("keyword_classify", """
SELECT name, count(*) AS parts, count(DISTINCT p_type) AS types FROM (
  SELECT p_type, CASE WHEN contains(lower(p_name || ' ' || p_type), 'small') THEN 'little'
              WHEN contains(lower(p_name || ' ' || p_type), 'widget') THEN 'widget'
              WHEN contains(lower(p_name || ' ' || p_type), 'small bolt') THEN 'never'
              WHEN contains(lower(p_name || ' ' || p_type), 'promo') THEN 'offer'
              WHEN contains(lower(p_name || ' ' || p_type), 'gear') THEN 'gear' END AS name FROM part)
WHERE name IS NOT NULL GROUP BY 1
""")
def keyword_classify(spark, sf):
    """X1, P19, A5."""
    text = F.concat_ws(" ", "p_name", "p_type")
    part = I.table(spark, sf, "part").select("p_type", X.first_keyword(text, PART_KEYWORDS).alias("name"))
    return part.filter(F.col("name").isNotNull()).groupBy("name").agg(
        F.count(F.lit(1)).alias("parts"), F.count_distinct("p_type").alias("types"))


@query("keyword_table", """
WITH k AS (SELECT lower(substr(p_name, 1 + CAST(p_partkey % 4 AS INT), 3 + CAST(p_partkey % 5 AS INT))) AS word, p_partkey AS priority FROM part
           WHERE p_partkey % 7 = 6
           UNION ALL SELECT 'none' || p_partkey, -p_partkey FROM part),
texts AS (SELECT DISTINCT lower(p_name || ' ' || p_type || ' ' || p_brand) AS text FROM part),
hits AS (SELECT text, min(priority) AS priority FROM texts JOIN k ON contains(text, word) GROUP BY 1)
SELECT p_partkey, 'k' || priority AS name FROM part LEFT JOIN hits ON lower(p_name || ' ' || p_type || ' ' || p_brand) = text
""")
def keyword_table(spark, sf):
    """A keyword table with as many entries as there are parts and more, most of which match nothing."""
    part = I.table(spark, sf, "part")
    key = F.col("p_partkey")
    word = F.substring("p_name", (1 + key % 4).cast("int"), (3 + key % 5).cast("int"))
    words = part.filter(key % 7 == 6).select(word.alias("keyword"), key.alias("priority"))
    words = words.unionByName(part.select(F.concat(F.lit("none"), key).alias("keyword"), (-key).alias("priority")))
    words = words.withColumn("clean_name", F.concat(F.lit("k"), "priority"))
    texts = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("text"))
    return first_keyword_of_table(texts, "text", words, "name").select("p_partkey", "name")


@query("regex_filter", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'Gear|^RED|bo.t$', 'i')
""")
def regex_filter(spark, sf):
    """P18."""
    return I.table(spark, sf, "part").filter(X.matches("p_name", "Gear|^RED|bo.t$")).select("p_partkey", "p_name")


_FIRST = ", ".join(f"min_by(value, ord) FILTER (WHERE variable = '{p}') AS p{i}"
                   for i, p in enumerate(I.PRIORITIES, 1))
_MEAN = ", ".join(f"round_even(avg(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE variable = '{p}'), 4) AS p{i}"
                  for i, p in enumerate(I.PRIORITIES, 1))
_P = [f"p{i}" for i in range(1, 6)]


@query("pivot_first", "WITH " + I.ANNUAL + f" SELECT e, y, {_FIRST} FROM annual_long GROUP BY 1, 2")
def pivot_first(spark, sf):
    """A15, T7."""
    long = I.annual_long(spark, sf)
    return reshape.pivot_first(long, ["e", "y"], "variable", "value", I.PRIORITIES, "ord").toDF("e", "y", *_P)


@query("pivot_mean", "WITH " + I.ANNUAL + f" SELECT e, y, {_MEAN} FROM annual_long GROUP BY 1, 2")
def pivot_mean(spark, sf):
    """A16, on whole cents so that sums are exact in any order."""
    cents = I.annual_long(spark, sf).withColumn("value", F.round(F.col("value") * 100).cast("long"))
    wide = reshape.pivot_mean(cents, ["e", "y"], "variable", "value", I.PRIORITIES)
    return clean.round_numeric(wide.toDF("e", "y", *_P))


def _interpolation_sql(at: str) -> str:
    return "WITH " + I.SPARSE + "," + I.gap_fill("sparse", "e", "y", _P, at) + " SELECT * FROM filled"


@query("interpolate_position", _interpolation_sql(I.ROW_PLACE))
def interpolate_position(spark, sf):
    """One row per entity and year, so the window groups are small by construction."""
    filled = fill_linear(I.annual_sparse(spark, sf), ["e"], "y", _P, bounded=True)
    return clean.round_numeric(filled)


@query("interpolate_time", _interpolation_sql("CAST(y AS DOUBLE)"))
def interpolate_time(spark, sf):
    """W7 with gaps measured in years."""
    filled = fill_linear(I.annual_sparse(spark, sf), ["e"], "y", _P, by="time", bounded=True)
    return clean.round_numeric(filled)


@query("drop_any_null", "WITH " + I.SPARSE + " SELECT e, y, p1, p2 FROM sparse WHERE p1 IS NOT NULL AND p2 IS NOT NULL")
def drop_any_null(spark, sf):
    """P4."""
    return I.annual_sparse(spark, sf).select("e", "y", "p1", "p2").na.drop("any")


@query("nearest_cell", "WITH " + I.NEAREST + " SELECT * FROM cells")
def nearest_cell(spark, sf):
    """J4."""
    return grid.nearest_cell(I.points(spark, sf), I.grid_cells(spark, sf))


@query("nearest_cell_outlier", """
WITH axis AS (SELECT DISTINCT CASE WHEN p_partkey % 1000 = 7 THEN 1e10::DOUBLE ELSE p_retailprice END AS place FROM part),
points AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 950.05::DOUBLE ELSE o_totalprice / 400 END AS x FROM orders),
xs AS (SELECT DISTINCT x FROM points),
near AS (SELECT x, min_by(place, row(abs(place - x), place)) AS cell FROM xs, axis GROUP BY 1)
SELECT o_orderkey, x, cell FROM points JOIN near USING (x)
""")
def nearest_cell_outlier(spark, sf):
    """An axis with a fill value far out, and a third of the points at one place."""
    at = F.when(F.col("p_partkey") % 1000 == 7, 1e10).otherwise(F.col("p_retailprice"))
    x = F.when(F.col("o_orderkey") % 3 == 0, 950.05).otherwise(F.col("o_totalprice") / 400)
    points = I.table(spark, sf, "orders").select("o_orderkey", x.alias("x"))
    return grid.nearest_on_axis(points, "x", I.table(spark, sf, "part").select(at.alias("at")), "at", "cell")


@query("extract_series", "WITH " + I.NEAREST + """
SELECT c.point, c.lat, c.lon, c.cell_lat, c.cell_lon, strftime(t, '%Y-%m') AS month,
       round_even(value, 4) AS value,
       CASE WHEN uncertainty < 1e10 THEN round_even(uncertainty, 4) END AS uncertainty
FROM grid g JOIN cells c ON g.lat = c.cell_lat AND g.lon = c.cell_lon
WHERE value <= 1e10
""")
def extract_series(spark, sf):
    """S3, S11, J5, P20, X10, X11."""
    series = grid.extract_series(I.points(spark, sf), I.grid_cells(spark, sf), "value", "uncertainty")
    return series.withColumn("month", X.month_text("t")).drop("t")


@query("spatial_mean", "WITH " + I.GRID + """
SELECT strftime(t, '%Y-%m') AS month, round_even(avg(CASE WHEN value < 1e10 THEN value END), 4) AS value
FROM grid GROUP BY 1
""")
def spatial(spark, sf):
    """A20."""
    cells = I.grid_cells(spark, sf).withColumn("value", X.blank_fill("value"))
    mean = spatial_mean(cells, "t", "value")
    return mean.select(X.month_text("t").alias("month"), X.round_even("value").alias("value"))


@query("left_join_static", "WITH " + I.PANEL + "," + I.STATIC + """
SELECT p.e, strftime(p.t, '%Y-%m') AS month, p.v, s.v AS v_st, s.stress_score
FROM panel p LEFT JOIN (SELECT CASE WHEN e <> 3 THEN e END AS e, stress_score, e * 2 AS v FROM static) s ON p.e = s.e
""")
def left_join_static(spark, sf):
    """Clashing column gets a suffix, entities without a row stay."""
    static = I.static_scores(spark, sf).withColumn("v", F.col("e") * 2)
    static = materialise(static.withColumn("e", F.when(F.col("e") != 3, F.col("e"))))
    joined = joins.left_join_suffixed(I.monthly_panel(spark, sf), static, ["e"], "_st", require_unique=True)
    return joined.select("e", X.month_text("t").alias("month"), "v", "v_st", "stress_score")


@query("left_join_year", "WITH " + I.PANEL + "," + I.SPARSE + """
SELECT p.e, strftime(p.t, '%Y-%m') AS month, p.v, s.p1, s.p3
FROM panel p LEFT JOIN sparse s ON p.e = s.e AND year(p.t) = s.y
""")
def left_join_year(spark, sf):
    """Yearly facts spread over the months."""
    annual = materialise(I.annual_sparse(spark, sf).select("e", "y", "p1", "p3"))
    panel = I.monthly_panel(spark, sf).select("e", X.month_text("t").alias("month"), "v")
    panel = panel.withColumn("y", X.year_of_text("month"))
    return joins.left_join_suffixed(panel, annual, ["e", "y"], "_an").drop("y")


@query("lookup_map", """
SELECT n_nationkey, n_name, code FROM nation LEFT JOIN (VALUES
  ('ALGERIA', 'DZA'), ('ARGENTINA', 'ARG'), ('BRAZIL', 'BRA'), ('CANADA', 'CAN'), ('EGYPT', 'EGY'),
  ('ETHIOPIA', 'ETH'), ('FRANCE', 'FRA'), ('GERMANY', 'DEU'), ('INDIA', 'IND'), ('INDONESIA', 'IDN'),
  ('IRAN', 'IRN'), ('IRAQ', 'IRQ'), ('JAPAN', 'JPN'), ('JORDAN', 'JOR'), ('KENYA', 'KEN'),
  ('MOROCCO', 'MAR'), ('MOZAMBIQUE', 'MOZ'), ('PERU', 'PER'), ('CHINA', 'CHN'), ('ROMANIA', 'ROU'),
  ('SAUDI ARABIA', 'SAU'), ('VIETNAM', 'VNM'), ('RUSSIA', 'RUS'), ('UNITED KINGDOM', 'GBR'),
  ('UNITED STATES', 'USA')) AS c(name, code) ON n_name = name
""")
def lookup_map(spark, sf):
    """S10, J3."""
    codes = name_codes(spark).withColumn("name", F.upper("name"))
    nation = I.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return joins.map_values(nation, "n_name", codes, "name", "code", "code")


@query("schema_ops", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, coalesce(nullif(l_tax, 0.05), 0) AS l_tax, l_returnflag,
       l_linestatus, 'lineitem' AS source
FROM lineitem
""")
def schema_ops(spark, sf):
    """Column sets from the schema alone."""
    line = I.table(spark, sf, "lineitem")
    dropped = C.without(line, "l_quantity", "not_there", *C.columns_with(line, "supp", "part", "ship"))
    blanked = dropped.withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.05)))
    filled = clean.fill_zero(blanked, C.existing(blanked, ["l_tax", "missing"]))
    return filled.withColumn("source", F.lit("lineitem"))


@query("agg_join_back", """
WITH stats AS (
  SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top, min_by(o_orderstatus, o_orderkey) AS first_status
  FROM orders GROUP BY 1
)
SELECT o_orderkey, o_custkey, n, top, first_status FROM orders JOIN stats USING (o_custkey)
""")
def agg_join_back(spark, sf):
    """Entity statistics on every row, without a whole entity in one task."""
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    stats = entity_stats(orders, ["o_custkey"], {
        "n": F.count(F.lit(1)), "top": F.max("o_totalprice"),
        "first_status": F.min_by("o_orderstatus", "o_orderkey")})
    return stats.select("o_orderkey", "o_custkey", "n", "top", "first_status")
