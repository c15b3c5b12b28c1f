"""Scores, filters, summaries and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import aggregates as A
from ..operators import incremental
from ..operators import profile as P
from ..operators.clean import clean_indicators, round_numeric
from ..session import materialise, scratch_path
from . import inputs as I
from .read_views import filtered, preview
from .registry import query

MONTH = "strftime(t, '%Y-%m') AS month"


def _shown(df):
    return df.withColumn("month", X.month_text("t")).drop("t")


@query("composite_score", "WITH " + I.SCORED + f" SELECT e, {MONTH}, v, stress_score, score FROM scored")
def composite_score(spark, sf):
    """A4, X5, X6."""
    return _shown(I.scored_panel(spark, sf).select("e", "t", "v", "stress_score", "score"))


@query("band", "WITH " + I.SCORED + f"""
SELECT e, {MONTH}, class, CASE WHEN stress_score IS NULL THEN 'Extreme' WHEN stress_score < 1 THEN 'Low'
  WHEN stress_score < 2 THEN 'Moderate' WHEN stress_score < 3.5 THEN 'High' ELSE 'Extreme' END AS static_class
FROM scored
""")
def band(spark, sf):
    """With the last band for missing values on request."""
    panel = I.scored_panel(spark, sf)
    return _shown(panel.select("e", "t", "class", X.band("stress_score", null_label="Extreme").alias("static_class")))


@query("season", "WITH " + I.SCORED + f" SELECT e, {MONTH}, season, m FROM scored")
def season(spark, sf):
    """X2, X3."""
    text = _shown(I.monthly_panel(spark, sf).select("e", "t"))
    return text.withColumn("m", X.month_of_text("month")).withColumn("season", X.season("m"))


@query("filter_panel", "WITH " + I.SCORED + f"""
SELECT e, {MONTH}, score, class FROM scored
WHERE e IN (1, 3, 5, 7, 9) AND t BETWEEN DATE '1996-03-01' AND DATE '1999-08-01' AND class IN ('Moderate', 'High')
ORDER BY e, t LIMIT 500
""")
def filter_panel(spark, sf):
    """The read view's filters and its 500-row preview."""
    panel = I.scored_panel(spark, sf)
    chosen = filtered(panel, {"e": [1, 3, 5, 7, 9], "class": ["Moderate", "High"]}, "t", "1996-03-01", "1999-08-01")
    return _shown(preview(chosen, ["e", "t", "score", "class"], ["e", "t"]))


@query("equality_filter", "WITH " + I.SCORED + f" SELECT {MONTH}, score FROM scored WHERE e = 4 AND season = 'JJA'")
def equality_filter(spark, sf):
    """P17."""
    panel = I.scored_panel(spark, sf)
    return _shown(panel.filter((F.col("e") == 4) & (F.col("season") == "JJA")).select("t", "score"))


@query("headline_metrics", "WITH " + I.SCORED + """
SELECT round_even(avg(score), 9) AS avg_score,
       round_even(avg(CASE WHEN class IN ('High', 'Extreme') THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 6) AS high_percent,
       round_even(avg(v), 4) AS avg_measure, count(DISTINCT e) AS entities
FROM scored
""")
def headline_metrics(spark, sf):
    """A5, A6, A9, A23, P23."""
    one = A.headline(I.scored_panel(spark, sf), "score", "class", "v", "e", ["High", "Extreme"])
    return one.select(X.round_even("avg_score", 9).alias("avg_score"), X.round_even("high_percent", 6).alias("high_percent"),
                      X.round_even("avg_measure").alias("avg_measure"), "entities")


@query("table_extent", """
SELECT count(*) AS rows, 6 AS columns, count(DISTINCT o_custkey) AS entities,
       strftime(min(o_orderdate), '%Y-%m') AS first_time, strftime(max(o_orderdate), '%Y-%m') AS last_time
FROM orders
""")
def table_extent(spark, sf):
    """A5, A6."""
    return A.extent(I.table(spark, sf, "orders"), "o_custkey", "o_orderdate").withColumns({
        c: X.month_text(c) for c in ("first_time", "last_time")})


@query("freq_table", """
SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1
""")
def freq_table(spark, sf):
    """A7."""
    return A.frequency(I.table(spark, sf, "orders"), "o_orderpriority")


@query("crosstab", """
SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1
""")
def crosstab(spark, sf):
    """A8."""
    return A.cross_tab(I.table(spark, sf, "orders"), "o_custkey", "o_orderstatus", ["O", "F", "P"])


@query("share_of_total", """
SELECT o_orderstatus, count(*) AS count, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 4) AS percent
FROM orders GROUP BY 1
""")
def share_of_total(spark, sf):
    """A10."""
    return round_numeric(A.share_of_total(I.table(spark, sf, "orders"), "o_orderstatus"))


@query("topk_groups", "WITH " + I.SCORED + """
SELECT e, round_even(mean, 9) AS mean FROM (SELECT e, avg(score) AS mean FROM scored GROUP BY 1)
ORDER BY mean DESC, e LIMIT 15
""")
def topk_groups(spark, sf):
    """O2."""
    return round_numeric(A.top_groups(I.scored_panel(spark, sf), ["e"], "score", 15), 9)


@query("semi_topk", "WITH " + I.SCORED + f""",
top AS (SELECT e FROM (SELECT e, avg(score) AS mean FROM scored GROUP BY 1) ORDER BY mean DESC, e LIMIT 12)
SELECT e, {MONTH}, score FROM scored WHERE e IN (SELECT e FROM top)
""")
def semi_topk(spark, sf):
    """J6."""
    panel = materialise(I.scored_panel(spark, sf).select("e", "t", "score"))
    return _shown(A.in_top_groups(panel, "e", "score", 12))


@query("season_compare", "WITH " + I.SCORED + """
SELECT e, season, round_even(avg(score), 9) AS score FROM scored GROUP BY 1, 2
""")
def season_compare(spark, sf):
    """A2."""
    return round_numeric(A.group_means(I.scored_panel(spark, sf), ["e", "season"], ["score"]), 9)


@query("yearly_mean", "WITH " + I.SCORED + """
SELECT e, y, round_even(avg(score), 9) AS score FROM scored GROUP BY 1, 2
""")
def yearly_mean(spark, sf):
    """A2."""
    return round_numeric(A.group_means(I.scored_panel(spark, sf), ["e", "y"], ["score"]), 9)


@query("monthly_mean_std", "WITH " + I.PANEL + """
SELECT CAST(month(t) AS INTEGER) AS m, avg(v_cents) AS mean, round_even(stddev_samp(v_cents), 2) AS std
FROM panel GROUP BY 1
""")
def monthly_mean_std(spark, sf):
    """A11, on whole cents so that the mean is exact in any order."""
    profile = A.month_profile(I.monthly_panel(spark, sf).withColumn("m", F.month("t")), "m", "v_cents")
    return profile.withColumn("std", X.round_even("std", 2))


@query("global_series", "WITH " + I.SCORED + f"""
SELECT {MONTH}, round_even(avg(v), 6) AS v, round_even(avg(score), 6) AS score FROM scored GROUP BY t
""")
def global_series(spark, sf):
    """A2."""
    return _shown(round_numeric(A.group_means(I.scored_panel(spark, sf), ["t"], ["v", "score"]), 6))


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round_even(avg({c}), 3) AS mean, round_even(stddev_samp({c}), 3) AS std,
       round_even(min({c}), 3) AS min, round_even(quantile_cont({c}, 0.25), 3) AS p25,
       round_even(quantile_cont({c}, 0.5), 3) AS p50, round_even(quantile_cont({c}, 0.75), 3) AS p75,
       round_even(max({c}), 3) AS max
FROM lineitem""" for c in _DESCRIBED))
def describe(spark, sf):
    """A12, T5."""
    return P.describe(I.table(spark, sf, "lineitem"), _DESCRIBED)


@query("incremental_profile", "WITH " + I.PANEL + """,
gappy AS (SELECT e, CASE WHEN v_cents % 5 <> 0 THEN v END AS v, strftime(t, '%Y-%m') AS month FROM panel)
SELECT 'e' AS "column", count(*) AS rows, count(e) AS count, count(*) - count(e) AS missing, round_even(avg(e), 4) AS mean,
       round_even(stddev_samp(e), 4) AS std, min(e)::DOUBLE AS min, max(e)::DOUBLE AS max, NULL::VARCHAR AS first, NULL::VARCHAR AS last,
       count(DISTINCT e) AS few_distinct FROM gappy
UNION ALL
SELECT 'v', count(*), count(v), count(*) - count(v), round_even(avg(v), 4), round_even(stddev_samp(v), 4), min(v), max(v), NULL, NULL,
       NULL FROM gappy
UNION ALL
SELECT 'month', count(*), count(month), count(*) - count(month), NULL, NULL, NULL, NULL, min(month), max(month), NULL FROM gappy
""")
def incremental_profile(spark, sf):
    """Years added later are the only ones read for the second profile. Few distinct values are told exactly."""
    panel = materialise(I.monthly_panel(spark, sf).select(
        "e", F.when(F.col("v_cents") % 5 != 0, F.col("v")).alias("v"), X.month_text("t").alias("month"), F.year("t").alias("y")))
    path, states = scratch_path(spark, "panel"), scratch_path(spark, "states")
    panel.filter("y < 1997").write.partitionBy("y").parquet(path)
    incremental.refresh_profile(spark, path, states, "y")
    panel.filter("y >= 1997").write.mode("append").partitionBy("y").parquet(path)
    profile, _ = incremental.refresh_profile(spark, path, states, "y")
    few = F.when(F.col("column") == "e", F.col("about_distinct"))
    return profile.select("column", "rows", "count", "missing", X.round_even("mean").alias("mean"), X.round_even("std").alias("std"),
                          "min", "max", "first", "last", few.alias("few_distinct"))


@query("null_profile", "WITH " + I.CLEAN + " SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
    round_even((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS percent FROM clean"""
    for c in ("e", "ind_score", "ind_raw", "plain", "price")) + ") WHERE missing > 0")
def null_profile(spark, sf):
    """A13."""
    return P.null_profile(clean_indicators(I.dirty_indicators(spark, sf), {}, "e"))


def _corr_sql(a: str, b: str) -> str:
    return (f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN isnan(corr({a}, {b})) THEN NULL "
            f"ELSE round_even(corr({a}, {b}), 3) END AS r FROM clean2")


_CORR = ["ind_score", "ind_raw", "plain", "price", "flat"]


@query("corr_matrix", "WITH " + I.CLEAN + ", clean2 AS (SELECT *, 1.0::DOUBLE AS flat FROM clean) "
       + " UNION ALL ".join(_corr_sql(a, b) for a in _CORR for b in _CORR))
def corr_matrix(spark, sf):
    """With gaps and a constant column."""
    cleaned = clean_indicators(I.dirty_indicators(spark, sf), {}, "e").withColumn("flat", F.lit(1.0))
    return P.correlation_matrix(cleaned, _CORR)


@query("histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders),
counted AS (SELECT least(CAST(floor((o_totalprice - lo) / (hi - lo) * 30) AS INTEGER) + 1, 30) AS bin, count(*) AS c
            FROM orders, b GROUP BY 1)
SELECT CAST(r.i AS INTEGER) AS bin, round_even(lo + (r.i - 1) * (hi - lo) / 30, 4) AS left_edge, coalesce(c, 0) AS count,
       round_even(coalesce(c, 0) / (n * ((hi - lo) / 30)), 12) AS density
FROM range(1, 31) r(i) LEFT JOIN counted ON counted.bin = r.i, b
""")
def histogram(spark, sf):
    """A17, T8."""
    bins = P.histogram(I.table(spark, sf, "orders"), "o_totalprice", 30)
    return bins.withColumns({"left_edge": X.round_even("left_edge"), "density": X.round_even("density", 12)})


@query("kde", """
WITH s AS (SELECT count(*) AS n, stddev_samp(o_totalprice) * power(count(*), -0.2) AS h,
                  min(o_totalprice) - 0.5 * (max(o_totalprice) - min(o_totalprice)) AS start,
                  2.0 * (max(o_totalprice) - min(o_totalprice)) / 999 AS step FROM orders)
SELECT CAST(r.i AS INTEGER) AS i, round_even(any_value(start + r.i * step), 4) AS x,
       round_even(sum(exp(-0.5 * power((start + r.i * step - o_totalprice) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 12)
         AS density
FROM orders, s, range(1000) r(i) GROUP BY 1
""")
def kde(spark, sf):
    """A18."""
    curve = P.density(I.table(spark, sf, "orders").select("o_totalprice"), "o_totalprice")
    return curve.withColumns({"x": X.round_even("x"), "density": X.round_even("density", 12)})


@query("box_summary", """
WITH q AS (
  SELECT o_orderpriority, count(*) AS n, quantile_cont(o_totalprice, 0.25) AS q1,
         quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3
  FROM orders GROUP BY 1
)
SELECT o_orderpriority, any_value(n) AS n, round_even(any_value(q1), 4) AS q1, round_even(any_value(median), 4) AS median,
       round_even(any_value(q3), 4) AS q3,
       min(o_totalprice) FILTER (WHERE o_totalprice >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(o_totalprice) FILTER (WHERE o_totalprice <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM orders JOIN q USING (o_orderpriority) GROUP BY 1
""")
def box_summary(spark, sf):
    """A19."""
    box = P.box_summary(I.table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return box.withColumns({c: X.round_even(c) for c in ("q1", "median", "q3")})


@query("category_order", "WITH " + I.SCORED + """
SELECT season, list_position(['DJF', 'MAM', 'JJA', 'SON'], season) AS place, round_even(avg(score), 9) AS score
FROM scored GROUP BY 1, 2
""")
def category_order(spark, sf):
    """O6."""
    means = A.group_means(I.scored_panel(spark, sf), ["season"], ["score"])
    placed = means.withColumn("place", X.order_in("season", X.SEASONS).cast("int")).orderBy("place")
    return placed.withColumn("score", X.round_even("score", 9))


@query("label_text", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Mkt Automobile' WHEN 'BUILDING' THEN 'Mkt Building'
  WHEN 'FURNITURE' THEN 'Mkt Furniture' WHEN 'MACHINERY' THEN 'Mkt Machinery' WHEN 'HOUSEHOLD' THEN 'Mkt Household' END AS label
FROM customer
""")
def label_text(spark, sf):
    """X12."""
    customer = I.table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("mkt_"), "c_mktsegment").alias("s"))
    return customer.select("c_custkey", X.label_text("s").alias("label"))


@query("marker_size", "WITH " + I.SCORED + """,
means AS (SELECT e, avg(score) AS score, avg(e * 1.5::DOUBLE) AS lat, avg(e * -2.0::DOUBLE) AS lon FROM scored GROUP BY 1)
SELECT e, round_even(score, 9) AS score, round_even(greatest(5.0::DOUBLE, score * 3), 9) AS radius,
       CASE WHEN score < 1 THEN 'green' WHEN score < 2 THEN 'orange' WHEN score < 3.5 THEN 'red' ELSE 'darkred' END AS colour
FROM means
""")
def marker_size(spark, sf):
    """X13, A2."""
    placed = I.scored_panel(spark, sf).withColumns({"lat": F.col("e") * 1.5, "lon": F.col("e") * -2.0})
    means = A.marker_table(placed, ["e"], "score", "lat", "lon")
    return means.select("e", X.round_even("score", 9).alias("score"),
                        X.round_even(X.marker_size("score"), 9).alias("radius"), X.marker_colour("score").alias("colour"))


@query("distinct_sorted", "SELECT DISTINCT p_type FROM part")
def distinct_sorted(spark, sf):
    """O5."""
    return A.distinct_sorted(I.table(spark, sf, "part"), "p_type")


@query("sorted_output", "WITH " + I.PANEL + f"""
SELECT e, {MONTH}, v, round_even((v + e) / 2, 4) AS middle FROM panel ORDER BY e, t
""")
def sorted_output(spark, sf):
    """O1, X10, X15."""
    panel = I.monthly_panel(spark, sf)
    shown = panel.select("e", X.month_text("t").alias("month"), "v", X.round_even(X.midpoint("v", "e")).alias("middle"))
    return shown.orderBy("e", "month")


CLUSTERED = I.SCORED + """,
clustered AS (SELECT *, CAST(e % 4 AS INTEGER) AS cluster FROM scored)"""
ZONES = ["Low Risk Zone", "Moderate Risk Zone", "High Risk Zone", "Critical Zone"]  # fixed: zone names, ascending


def _clustered(spark, sf):
    return materialise(I.scored_panel(spark, sf).withColumn("cluster", (F.col("e") % 4).cast("int")))


@query("radar_profile", "WITH " + CLUSTERED + """,
means AS (SELECT cluster, avg(stress_score) AS stress_score, avg(score) AS score, avg(v / 1e6) AS v FROM clustered GROUP BY 1),
ends AS (SELECT *, least(stress_score, score, v) AS lo, greatest(stress_score, score, v) AS hi FROM means)
SELECT cluster, round_even((stress_score - lo) / (hi - lo + 1e-8::DOUBLE), 6) AS stress_score,
       round_even((score - lo) / (hi - lo + 1e-8::DOUBLE), 6) AS score, round_even((v - lo) / (hi - lo + 1e-8::DOUBLE), 6) AS v
FROM ends
""")
def radar_profile(spark, sf):
    """A22."""
    scaled = _clustered(spark, sf).withColumn("v", F.col("v") / 1e6)
    return round_numeric(A.cluster_profile(scaled, "cluster", ["stress_score", "score", "v"]), 6)


@query("name_clusters", "WITH " + CLUSTERED + f""",
ranked AS (SELECT cluster, row_number() OVER (ORDER BY avg(score), cluster) AS r FROM clustered GROUP BY 1)
SELECT c.e, strftime(c.t, '%Y-%m') AS month, c.cluster, {ZONES}[r] AS zone
FROM clustered c JOIN ranked USING (cluster)
""")
def name_clusters(spark, sf):
    """J7."""
    named = A.name_by_rank(_clustered(spark, sf).select("e", "t", "cluster", "score"), "cluster", "score", ZONES, "zone")
    return _shown(named.drop("score"))


@query("cluster_members", """
SELECT CAST(n_regionkey % 3 AS INTEGER) AS cluster, string_agg(n_name, ', ' ORDER BY n_name) AS members FROM nation GROUP BY 1
""")
def cluster_members(spark, sf):
    """A24."""
    nation = I.table(spark, sf, "nation").withColumn("cluster", (F.col("n_regionkey") % 3).cast("int"))
    return A.member_text(nation, "cluster", "n_name", [0, 1, 2])


@query("cluster_member_rows", """
SELECT DISTINCT o_orderpriority AS grp, o_custkey AS member FROM orders
""")
def cluster_member_rows(spark, sf):
    """A24 for groups of any size."""
    orders = I.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("grp"), F.col("o_custkey").alias("member"))
    return A.members(orders, "grp", "member")
