"""Time-series features per entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import positions
from ..operators import series as S
from ..operators.aggregates import class_counts
from ..operators.clean import round_numeric
from . import inputs as I
from .registry import query

# The panel has one row per nation and month, so its window groups are small by
# construction and all features of a query share one exchange.
E, T, V = ["e"], "t", "v"
MONTH = "strftime(t, '%Y-%m') AS month"


def _shown(df):
    return df.withColumn("month", X.month_text("t")).drop("t")


@query("rolling_3_6_12", "WITH " + I.PANEL + f"""
SELECT e, {MONTH}, v, round_even(avg(v) OVER (w ROWS 2 PRECEDING), 4) AS v_avg_3,
       round_even(avg(v) OVER (w ROWS 5 PRECEDING), 4) AS v_avg_6,
       round_even(avg(v) OVER (w ROWS 11 PRECEDING), 4) AS v_avg_12
FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)
""")
def rolling(spark, sf):
    """W1."""
    panel = I.monthly_panel(spark, sf).drop("v_cents")
    frames = {f"v_avg_{k}": S.trailing_mean(V, k) for k in S.ROLLING_WINDOWS}
    return _shown(round_numeric(S.row_frames(panel, E, T, frames, before=12, bounded=True)))


@query("rolling_std", "WITH " + I.PANEL + f"""
SELECT e, {MONTH}, round_even(stddev_samp(v) OVER (w ROWS 2 PRECEDING), 4) AS v_std_3,
       round_even(stddev_samp(v) OVER (w ROWS 5 PRECEDING), 4) AS v_std_6,
       round_even(stddev_samp(v) OVER (w ROWS 11 PRECEDING), 4) AS v_std_12
FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)
""")
def rolling_std(spark, sf):
    """W2."""
    panel = I.monthly_panel(spark, sf).drop("v_cents")
    frames = {f"v_std_{k}": S.trailing_std(V, k) for k in S.ROLLING_WINDOWS}
    return _shown(round_numeric(S.row_frames(panel, E, T, frames, before=12, bounded=True)).drop("v"))


@query("diff_cum_z", "WITH " + I.PANEL + f"""
SELECT e, {MONTH}, round_even(v - lag(v) OVER w, 4) AS step, round_even(v - first_value(v) OVER w, 4) AS since_first,
       round_even((v - avg(v) OVER g) / (stddev_samp(v) OVER g + 1e-8::DOUBLE), 4) AS z, round_even(v * 0.4::DOUBLE, 4) AS scaled
FROM panel WINDOW w AS (PARTITION BY e ORDER BY t), g AS (PARTITION BY e)
""")
def diff_cum_z(spark, sf):
    """W3, W4, W5, X7."""
    full = S.series_features(I.monthly_panel(spark, sf), E, T, V, "v", bounded=True)
    return _shown(full.select(
        "e", "t", F.col("v_rate_of_change").alias("step"), F.col("v_cumulative_change").alias("since_first"),
        F.col("v_zscore").alias("z"), X.round_even(F.col("v") * F.lit(0.4)).alias("scaled")))


@query("trend_slope", "WITH " + I.PANEL + f""",
placed AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY t) - 1 AS x FROM panel)
SELECT e, {MONTH}, CASE WHEN count(*) OVER g < 6 OR count(v) OVER g < 3 THEN 0.0::DOUBLE
                   ELSE round_even(12 * regr_slope(v, x) OVER g, 4) END AS trend
FROM placed WINDOW g AS (PARTITION BY e)
""")
def trend_slope(spark, sf):
    """W6, T6b."""
    panel = I.monthly_panel(spark, sf)
    return _shown(S.with_trend(panel, E, T, V, "trend", bounded=True).select("e", "t", "trend"))


@query("fitted_trend", "WITH " + I.PANEL + f""",
placed AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY t) AS x FROM panel)
SELECT e, {MONTH}, CASE WHEN count(*) OVER g > 10
       THEN round_even(regr_intercept(v, x) OVER g + x * regr_slope(v, x) OVER g, 4) END AS fitted
FROM placed WINDOW g AS (PARTITION BY e)
""")
def fitted_trend(spark, sf):
    """W11."""
    line = S.with_fitted_line(I.monthly_panel(spark, sf), E, T, V, "fitted", bounded=True)
    return _shown(line.select("e", "t", X.round_even("fitted").alias("fitted")))


@query("lag_lead_features", "WITH " + I.PANEL + f""",
made AS (
  SELECT e, {MONTH}, v, lag(v, 1) OVER w AS v_lag1, lag(v, 3) OVER w AS v_lag3, lag(v, 6) OVER w AS v_lag6,
         lag(v, 12) OVER w AS v_lag12,
         round_even(avg(v) OVER (w ROWS 2 PRECEDING), 4) AS v_rolling_mean_3,
         round_even(avg(v) OVER (w ROWS 5 PRECEDING), 4) AS v_rolling_mean_6,
         round_even(avg(v) OVER (w ROWS 11 PRECEDING), 4) AS v_rolling_mean_12,
         round_even(stddev_samp(v) OVER (w ROWS 2 PRECEDING), 4) AS v_rolling_std_3,
         round_even(stddev_samp(v) OVER (w ROWS 5 PRECEDING), 4) AS v_rolling_std_6,
         round_even(stddev_samp(v) OVER (w ROWS 11 PRECEDING), 4) AS v_rolling_std_12,
         lead(v, 3) OVER w AS v_future
  FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)
)
SELECT * FROM made WHERE v_future IS NOT NULL
""")
def lag_lead_features(spark, sf):
    """W9, W10, P3."""
    panel = I.monthly_panel(spark, sf).drop("v_cents")
    return _shown(round_numeric(S.lag_features(panel, E, T, V, bounded=True)))


@query("cyclic_month", "WITH " + I.PANEL + f"""
SELECT e, {MONTH}, round_even(sin(2 * pi() * month(t) / 12), 6) AS month_sin,
       round_even(cos(2 * pi() * month(t) / 12), 6) AS month_cos
FROM panel
""")
def cyclic_month(spark, sf):
    """The month is read back from its text form."""
    shown = _shown(I.monthly_panel(spark, sf).select("e", "t"))
    m = F.month(X.parse_month("month"))
    return shown.withColumns({
        "month_sin": X.round_even(X.month_sin(m), 6), "month_cos": X.round_even(X.month_cos(m), 6)})


_ORDER_SERIES = "SELECT o_orderpriority AS p, o_orderkey AS k, o_totalprice AS v FROM orders"


@query("order_series_frames", f"""
SELECT p, k, v, lag(v, 3) OVER w AS v_lag3, lead(v, 2) OVER w AS v_lead2, v - lag(v) OVER w AS step,
       round_even(avg(v) OVER (w ROWS 5 PRECEDING), 4) AS v_avg_6,
       round_even(stddev_samp(v) OVER (w ROWS 11 PRECEDING), 4) AS v_std_12
FROM ({_ORDER_SERIES}) WINDOW w AS (PARTITION BY p ORDER BY k)
""")
def order_series_frames(spark, sf):
    """W1-W3, W9, W10 on a few very long series, cut into blocks with copied edges."""
    series = I.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    frames = {"v_lag3": S.lag_of("v", 3), "v_lead2": S.lead_of("v", 2), "step": S.step_change("v"),
              "v_avg_6": S.trailing_mean("v", 6), "v_std_12": S.trailing_std("v", 12)}
    out = S.row_frames(series, ["p"], "k", frames, before=12, after=2, block_rows=1000)
    return out.withColumns({c: X.round_even(c) for c in ("v_avg_6", "v_std_12")})


@query("order_series_stats", f"""
SELECT p, k, round_even(v - first_value(v) OVER (g ORDER BY k), 4) AS v_cumulative_change,
       round_even((v - avg(v) OVER g) / (stddev_samp(v) OVER g + 1e-8::DOUBLE), 4) AS v_zscore,
       round_even(12 * regr_slope(v, x) OVER g, 4) AS v_trend_per_year
FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY k) AS x FROM ({_ORDER_SERIES}))
WINDOW g AS (PARTITION BY p)
""")
def order_series_stats(spark, sf):
    """W4-W6 on a few very long series: aggregated and joined back, never windowed whole."""
    series = I.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    out = S.series_features(series, ["p"], "k", "v", "v", block_rows=1000)
    return out.select("p", "k", "v_cumulative_change", "v_zscore", "v_trend_per_year")


@query("order_series_fill", """
WITH gaps AS (
  SELECT o_orderpriority AS p, o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS v,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS x
  FROM orders
),
sides AS (
  SELECT *, last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER back AS xb,
         last_value(v IGNORE NULLS) OVER back AS vb,
         first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER ahead AS xa,
         first_value(v IGNORE NULLS) OVER ahead AS va
  FROM gaps
  WINDOW back AS (PARTITION BY p ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY p ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)
SELECT p, k, round_even(CASE WHEN v IS NOT NULL THEN v WHEN vb IS NULL THEN va WHEN va IS NULL THEN vb
                        ELSE vb + (va - vb) * (x - xb) / (xa - xb) END, 6) AS v
FROM sides
""")
def order_series_fill(spark, sf):
    """W7 on a few very long series with known values carried between blocks."""
    gaps = I.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).alias("v"))
    filled = S.fill_linear(gaps, ["p"], "k", ["v"], block_rows=1000)
    return filled.withColumn("v", X.round_even("v", 6))


@query("contiguous_folds", "WITH " + I.PANEL + f"""
SELECT e, {MONTH}, CAST(ntile(5) OVER (ORDER BY e, t) - 1 AS INTEGER) AS fold FROM panel
""")
def contiguous_folds(spark, sf):
    """Contiguous folds over the whole table's order."""
    panel = I.monthly_panel(spark, sf).select("e", "t")
    return _shown(positions.contiguous_folds(panel, ["e", "t"], 5))


@query("stratified_folds", "WITH " + I.SCORED + """,
sizes AS (SELECT class, count(*) AS n FROM scored GROUP BY 1)
SELECT class, n AS class_rows, 3 AS folds, CAST(n // 3 AS BIGINT) AS smallest, CAST((n + 2) // 3 AS BIGINT) AS largest
FROM sizes WHERE n >= 3
""")
def stratified_folds(spark, sf):
    """Every class is spread evenly over three shuffled folds."""
    panel = I.scored_panel(spark, sf).select("e", "t", "class")
    folds = positions.stratified_folds(panel, "class", ["e", "t"], 3)
    sizes = folds.groupBy("class", "fold").agg(F.count(F.lit(1)).alias("n"))
    per_class = sizes.groupBy("class").agg(
        F.sum("n").alias("class_rows"), F.count(F.lit(1)).cast("int").alias("folds"),
        F.min("n").alias("smallest"), F.max("n").alias("largest"))
    return per_class.filter("class_rows >= 3")


@query("split_by_year", "WITH " + I.SCORED + """
SELECT CASE WHEN y < 2000 THEN 'train' ELSE 'test' END AS split, class, count(*) AS rows
FROM scored GROUP BY 1, 2
""")
def split_by_year(spark, sf):
    """M4, A21."""
    panel = I.scored_panel(spark, sf)
    side = F.when(F.col("y") < 2000, "train").otherwise("test")
    return class_counts(panel.withColumn("split", side), "split", "class")
