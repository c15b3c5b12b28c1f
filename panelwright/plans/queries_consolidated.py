"""The whole consolidation flow over the given tables, brought to the raw sources' schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators.aggregates import frequency, top_groups
from ..operators.clean import round_numeric
from ..session import scratch_path
from ..sources import lookups as L
from ..sources import tables
from ..sources.tables import ORDINAL
from . import inputs as I
from .consolidate import annual_indicators, build_sources, consolidate, monthly_anomalies, static_indicators
from .registry import ORACLES, query

KEYWORDS = [("1-urg", "u_val"), ("2-HIGH", "h_val"), ("medium", "m_val"), ("low", "l_val")]


def _static_source(spark, sf):
    dirty = I.dirty_indicators(spark, sf)
    return dirty.select(
        F.concat(F.lit("N"), "e").alias("name_0"), F.concat(F.lit("C"), "e").alias("gid_0"),
        F.col("ind_score").alias("bws_score"), F.col("ind_raw").alias("drr_raw"),
        (F.col("plain") * 40).alias("gtd_score"), (F.col("price") / 50000).alias("iav_score"))


def _annual_source(spark, sf):
    long = I.annual_long(spark, sf)
    here = (F.col("e") * 7 + F.col("y") * 5 + F.length("variable")) % 3 != 1
    return long.select(
        "variable", F.concat(F.lit("N"), "e").alias("country"), F.col("y").cast("string").alias("year"),
        F.when(here, F.col("value").cast("string")).otherwise("..").alias("value"), F.col("ord").alias(ORDINAL))


def _codes(spark, sf):
    nation = I.table(spark, sf, "nation")
    name = F.when(F.col("n_nationkey") == 3, "unlisted").otherwise(F.concat(F.lit("N"), "n_nationkey"))
    return nation.select(name.alias("name"),
                         F.concat(F.lit("C"), "n_nationkey").alias("code"))


def _points(spark, sf):
    key = F.col("n_nationkey")
    return I.table(spark, sf, "nation").select(
        F.concat(F.lit("N"), key).alias("country"), F.concat(F.lit("C"), key).alias("country_code"),
        (key * F.lit(1.9) + F.lit(1.0)).alias("lat"), (key * F.lit(1.5)).alias("lon"))


def consolidated(spark, sf):
    grid = I.grid_cells(spark, sf).withColumnsRenamed({"t": "time", "value": "lwe_thickness"})
    static, annual, monthly = build_sources(
        lambda: static_indicators(_static_source(spark, sf)),
        lambda: annual_indicators(_annual_source(spark, sf), _codes(spark, sf), KEYWORDS),
        lambda: monthly_anomalies(grid, _points(spark, sf)),
    )
    return consolidate(static, annual, monthly, require_unique=True)


_MEDIANS = ", ".join(f"coalesce({c}, median({c}) OVER (PARTITION BY e)) AS {c}" for c in ("bws", "drr", "gtd"))
_MEANS = ", ".join(
    f"round_even(avg(coalesce({c}, (SELECT median({c}) FROM st2))), 4) AS {name}"
    for c, name in (("bws", "water_stress_score"), ("drr", "drought_risk_raw"), ("gtd", "groundwater_decline_score")))
_VARIABLES = ["h_val", "l_val", "m_val", "u_val"]
_FIRSTS = ", ".join(f"min_by(value, ord) FILTER (WHERE cv = '{v}') AS {v}" for v in _VARIABLES)

CONSOLIDATED = I.DIRTY + f""",
st1 AS (
  SELECT e, price / 50000 AS iav, CASE WHEN s < 9999 THEN least(greatest(s, 0.0::DOUBLE), 5.0::DOUBLE) END AS bws,
         CASE WHEN ind_raw < 9999 THEN ind_raw END AS drr,
         CASE WHEN plain * 40 < 9999 THEN least(greatest(plain * 40, 0.0::DOUBLE), 5.0::DOUBLE) END AS gtd
  FROM (SELECT *, TRY_CAST(ind_score AS DOUBLE) AS s FROM dirty)
),
st2 AS (SELECT e, iav, {_MEDIANS} FROM st1),
st3 AS (SELECT e, round_even(avg(iav), 4) AS interannual_variability, {_MEANS} FROM st2 GROUP BY 1),
""" + I.ANNUAL + f""",
an1 AS (
  SELECT e, y, ord, value, CASE WHEN contains(lower(variable), '1-urg') THEN 'u_val'
         WHEN contains(lower(variable), '2-high') THEN 'h_val' WHEN contains(lower(variable), 'medium') THEN 'm_val'
         WHEN contains(lower(variable), 'low') THEN 'l_val' END AS cv
  FROM annual_long WHERE (e * 7 + y * 5 + length(variable)) % 3 <> 1 AND e <> 3
),
an2 AS (SELECT e, y, {_FIRSTS} FROM an1 WHERE cv IS NOT NULL GROUP BY 1, 2),
""" + I.gap_fill("an2", "e", "y", _VARIABLES, I.ROW_PLACE, 6) + "," + I.GRID + """,
pts AS (SELECT n_nationkey AS e, n_nationkey * 1.9::DOUBLE + 1.0::DOUBLE AS lat, n_nationkey * 1.5::DOUBLE AS lon FROM nation),
clat AS (SELECT e, min_by(a.lat, row(abs(a.lat - p.lat), a.lat)) AS cell_lat
         FROM pts p, (SELECT DISTINCT lat FROM grid) a GROUP BY 1),
clon AS (SELECT e, min_by(a.lon, row(abs(a.lon - p.lon), a.lon)) AS cell_lon
         FROM pts p, (SELECT DISTINCT lon FROM grid) a GROUP BY 1),
mo1 AS (
  SELECT pts.e, pts.lat, pts.lon, g.t, round_even(g.value, 4) AS v,
         CASE WHEN g.uncertainty < 1e10 THEN round_even(g.uncertainty, 4) END AS u
  FROM grid g JOIN clat ON g.lat = cell_lat JOIN clon ON clat.e = clon.e AND g.lon = cell_lon JOIN pts ON pts.e = clat.e
  WHERE g.value <= 1e10
),
mo2 AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY t) AS x FROM mo1),
mo3 AS (
  SELECT e, t, lat, lon, v, u, round_even(avg(v) OVER (w ROWS 2 PRECEDING), 4) AS a3,
         round_even(avg(v) OVER (w ROWS 5 PRECEDING), 4) AS a6, round_even(avg(v) OVER (w ROWS 11 PRECEDING), 4) AS a12,
         round_even(v - lag(v) OVER w, 4) AS step, round_even(v - first_value(v) OVER w, 4) AS cum,
         round_even((v - avg(v) OVER g) / (stddev_samp(v) OVER g + 1e-8::DOUBLE), 4) AS z,
         round_even(v * 0.4::DOUBLE, 4) AS gw,
         CASE WHEN count(*) OVER g < 6 THEN 0.0::DOUBLE ELSE round_even(12 * regr_slope(v, x) OVER g, 4) END AS trend
  FROM mo2 WINDOW w AS (PARTITION BY e ORDER BY t), g AS (PARTITION BY e)
),
ends AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM mo3),
joined AS (
  SELECT m.*, s.* EXCLUDE (e), f.* EXCLUDE (e, y),
         round_even(coalesce(water_stress_score, 0.0::DOUBLE) * (0.25::DOUBLE / 0.75::DOUBLE)
           + coalesce(least(greatest(5.0::DOUBLE * (1.0::DOUBLE - (v - lo) / (hi - lo + 1e-8::DOUBLE)), 0.0::DOUBLE),
                            5.0::DOUBLE), 0.0::DOUBLE) * (0.3::DOUBLE / 0.75::DOUBLE)
           + coalesce(groundwater_decline_score, 0.0::DOUBLE) * (0.2::DOUBLE / 0.75::DOUBLE), 4) AS score
  FROM mo3 m LEFT JOIN st3 s ON m.e = s.e LEFT JOIN filled f ON m.e = f.e AND year(m.t) = f.y, ends
)"""

_CLASS = ("CASE WHEN score < 1.0 THEN 'Low' WHEN score < 2.0 THEN 'Moderate' WHEN score < 3.5 THEN 'High' "
          "ELSE 'Extreme' END")


@query("consolidated_panel", "WITH " + CONSOLIDATED + f"""
SELECT 'N' || e AS country, 'C' || e AS country_code, lat, lon, strftime(t, '%Y-%m') AS date,
       CAST(year(t) AS INTEGER) AS year, v AS tws_anomaly_cm, u AS uncertainty_cm, a3 AS tws_3month_avg,
       a6 AS tws_6month_avg, a12 AS tws_12month_avg, step AS tws_rate_of_change, cum AS tws_cumulative_change,
       z AS tws_zscore, gw AS groundwater_anomaly_cm, trend AS tws_trend_cm_yr, interannual_variability,
       water_stress_score, drought_risk_raw, groundwater_decline_score, h_val, l_val, m_val, u_val,
       score AS drought_composite_score, {_CLASS} AS drought_risk_class, 'NASA_GRACE' AS source,
       CASE WHEN month(t) IN (12, 1, 2) THEN 'DJF' WHEN month(t) IN (3, 4, 5) THEN 'MAM'
            WHEN month(t) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season
FROM joined
""")
def consolidated_panel(spark, sf):
    """Every stage in one flow."""
    return consolidated(spark, sf).withColumns({v: X.round_even(v, 6) for v in _VARIABLES})


@query("consolidated_top", "WITH " + CONSOLIDATED + """
SELECT 'N' || e AS country, round_even(mean, 9) AS mean FROM (SELECT e, avg(score) AS mean FROM joined GROUP BY 1)
ORDER BY mean DESC, country LIMIT 15
""")
def consolidated_top(spark, sf):
    """O2 over the consolidated panel."""
    return round_numeric(top_groups(consolidated(spark, sf), ["country"], "drought_composite_score", 15), 9)


@query("consolidated_classes", "WITH " + CONSOLIDATED + f"""
SELECT {_CLASS} AS drought_risk_class, count(*) AS count FROM joined GROUP BY 1
""")
def consolidated_classes(spark, sf):
    """A7 over the consolidated panel."""
    return frequency(consolidated(spark, sf), "drought_risk_class")


def _from_files(spark, sf):
    """The three sources written as CSV, Latin-1 CSV and grid, and read back as raw inputs."""
    static = tables.export_text(_static_source(spark, sf), scratch_path(spark, "static"))
    blank = F.lit(None).cast("string")
    facts = _annual_source(spark, sf).orderBy(ORDINAL)  # the order of rows in the files is part of the input
    columns = [F.col(c) if c in facts.columns else blank.alias(c) for c in L.ANNUAL_COLUMNS]
    annual = tables.export_text(facts.select(*columns), scratch_path(spark, "annual"), tables.LATIN1)
    cells = I.grid_cells(spark, sf).withColumnsRenamed({"t": "time", "value": "lwe_thickness"})
    grid = tables.write_table(cells, scratch_path(spark, "grid"))
    return (
        tables.type_numbers(tables.read_text_table(spark, "static", static)),
        tables.read_text_table(spark, "annual", annual, tables.LATIN1, by_position=L.ANNUAL_COLUMNS, ordinal=True),
        tables.read_grid(spark, "grid", grid))


@query("raw_source_flow", ORACLES["consolidated_panel"])
def raw_source_flow(spark, sf):
    """The whole flow from files."""
    static, annual, grid = _from_files(spark, sf)
    words = spark.createDataFrame(
        [(i, word, name) for i, (word, name) in enumerate(KEYWORDS)], "priority int, keyword string, clean_name string")
    parts = build_sources(
        lambda: static_indicators(static),
        lambda: annual_indicators(annual, _codes(spark, sf), words),
        lambda: monthly_anomalies(grid, _points(spark, sf)))
    panel = consolidate(*parts, require_unique=True)
    return panel.withColumns({v: X.round_even(v, 6) for v in _VARIABLES})


@query("missing_input", "SELECT 'absent not found' AS message, count(*) AS rows FROM supplier")
def missing_input(spark, sf):
    """A table that is there is read, one that is not is reported by its name."""
    found = tables.read_table(spark, "supplier", f"{sf}/supplier.parquet")
    try:
        tables.read_table(spark, "absent", f"{sf}/absent.parquet")
        message = ""
    except FileNotFoundError as problem:
        message = str(problem).split(" at:")[0]
    return found.agg(F.lit(message).alias("message"), F.count(F.lit(1)).alias("rows"))
