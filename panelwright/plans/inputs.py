"""Derived inputs of the registered queries, each as a DataFrame and as a SQL table expression.

Only the columns a query needs are read; no input is cut down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import band, clip, inverted_scale, round_even, season, weighted_score
from ..operators.joins import lookup_join
from ..operators.quantiles import table_quantiles
from ..operators.reshape import pivot_first
from ..session import materialise

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_of(column: str):
    return F.trunc(F.col(column).cast("date"), "month")


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and month: order value in cents (exact sum) and in units."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", month_of("o_orderdate").alias("t"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("e"))
    return (
        lookup_join(orders, customer, "o_custkey", "inner")
        .groupBy("e", "t").agg(F.sum("cents").alias("v_cents"))
        .withColumn("v", F.col("v_cents") / F.lit(100.0))
    )


PANEL = """
panel AS (
  SELECT c_nationkey AS e, CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS v_cents,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS v
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2
)"""


def static_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation: a 0..5 score from its suppliers' balances."""
    return (
        table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("e"))
        .agg(F.avg("s_acctbal").alias("a"))
        .select("e", clip(round_even(F.col("a") / F.lit(2000.0)), 0.0, 5.0).alias("stress_score"))
    )


STATIC = """
static AS (
  SELECT s_nationkey AS e,
         least(greatest(round_even(avg(s_acctbal) / 2000.0::DOUBLE, 4), 0.0::DOUBLE), 5.0::DOUBLE) AS stress_score
  FROM supplier GROUP BY 1
)"""

PANEL_WEIGHTS = {"stress_score": 0.25, "decline_score": 0.25, "v_norm": 0.3}


def scored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with static score, composite score, class, year, month and season.

    The panel is computed once; the percentile bounds are two numbers taken from it.
    """
    panel = materialise(monthly_panel(spark, sf_dir))
    low, high = table_quantiles(panel, ["v"], [0.01, 0.99])["v"]
    joined = lookup_join(panel, materialise(static_scores(spark, sf_dir)), "e", "left")
    normed = joined.withColumn("v_norm", inverted_scale("v", F.lit(low), F.lit(high)))
    return normed.select(
        "e", "t", "v", "stress_score",
        weighted_score(PANEL_WEIGHTS, normed.columns).alias("score"),
        F.year("t").alias("y"), F.month("t").alias("m"),
        season(F.month("t")).alias("season"),
    ).withColumn("class", band("score"))


SCORED = PANEL + "," + STATIC + """,
bounds AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM panel),
normed AS (
  SELECT p.e, p.t, p.v, s.stress_score,
         least(greatest(5.0::DOUBLE * (1.0::DOUBLE - (p.v - b.lo) / (b.hi - b.lo + 1e-8::DOUBLE)),
               0.0::DOUBLE), 5.0::DOUBLE) AS v_norm
  FROM panel p LEFT JOIN static s ON p.e = s.e, bounds b
),
scored0 AS (
  SELECT e, t, v, stress_score,
         round_even(coalesce(stress_score, 0.0::DOUBLE) * (0.25::DOUBLE / 0.55::DOUBLE)
                  + coalesce(v_norm, 0.0::DOUBLE) * (0.3::DOUBLE / 0.55::DOUBLE), 4) AS score,
         CAST(year(t) AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m
  FROM normed
),
scored AS (
  SELECT *, CASE WHEN m IN (12, 1, 2) THEN 'DJF' WHEN m IN (3, 4, 5) THEN 'MAM'
                 WHEN m IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season,
         CASE WHEN score < 1.0 THEN 'Low' WHEN score < 2.0 THEN 'Moderate'
              WHEN score < 3.5 THEN 'High' ELSE 'Extreme' END AS class
  FROM scored0
)"""


def annual_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long facts: nation, year, variable (order priority), value, and a unique order key."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("variable"),
        F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("ord"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("e"))
    return lookup_join(orders, customer, "o_custkey", "inner").drop("o_custkey")


ANNUAL = """
annual_long AS (
  SELECT c_nationkey AS e, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS variable,
         o_totalprice AS value, o_orderkey AS ord
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def annual_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annual table pivoted wide, a third of its cells blanked; one variable of one nation is blank throughout."""
    first = annual_long(spark, sf_dir).groupBy("e", "y", "variable").agg(
        F.min_by("value", "ord").alias("value"), F.min("ord").alias("ord"))
    here = ((F.col("e") * 7 + F.col("y") * 5 + F.length("variable")) % 3 != 1) & (
        (F.col("e") != 3) | (F.col("variable") != "5-LOW"))
    gappy = first.withColumn("value", F.when(here, F.col("value")))
    return pivot_first(gappy, ["e", "y"], "variable", "value", PRIORITIES, "ord").toDF(
        "e", "y", *[f"p{i}" for i in range(1, 6)])


_CELLS = ",\n         ".join(
    f"min_by(value, ord) FILTER (WHERE variable = '{p}') AS p{i}" for i, p in enumerate(PRIORITIES, 1))

SPARSE = ANNUAL + """,
sparse_long AS (
  SELECT e, y, variable, min(ord) AS ord,
         CASE WHEN (e * 7 + y * 5 + length(variable)) % 3 <> 1 AND (e <> 3 OR variable <> '5-LOW')
              THEN min_by(value, ord) END AS value
  FROM annual_long GROUP BY 1, 2, 3
),
sparse AS (
  SELECT e, y, """ + _CELLS + """
  FROM sparse_long WHERE value IS NOT NULL GROUP BY 1, 2
)"""


def dirty_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-entity indicator rows with text scores, sentinels, bad text and gaps."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_discount", "l_quantity", "l_tax", "l_extendedprice")
    key = F.col("l_orderkey")
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("e"))
    marked = line.select(
        "l_suppkey",
        F.when(key % 17 == 0, "9999").when(key % 19 == 0, "n/a")
        .otherwise((F.col("l_discount") * 70 - 0.5).cast("string")).alias("ind_score"),
        F.when(key % 17 == 0, 9999.0).when(key % 23 != 0, F.col("l_quantity")).alias("ind_raw"),
        F.when(key % 13 == 0, 9999.0).otherwise(F.col("l_tax")).alias("plain"),
        F.col("l_extendedprice").alias("price"),
    )
    return lookup_join(marked, supplier, "l_suppkey", "inner").drop("l_suppkey")


DIRTY = """
dirty AS (
  SELECT CASE WHEN l_orderkey % 17 = 0 THEN '9999' WHEN l_orderkey % 19 = 0 THEN 'n/a'
              ELSE CAST(l_discount * 70 - 0.5 AS VARCHAR) END AS ind_score,
         CASE WHEN l_orderkey % 17 = 0 THEN 9999.0::DOUBLE
              WHEN l_orderkey % 23 <> 0 THEN l_quantity END AS ind_raw,
         CASE WHEN l_orderkey % 13 = 0 THEN 9999.0::DOUBLE ELSE l_tax END AS plain,
         l_extendedprice AS price, s_nationkey AS e
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
)"""

CLEAN = DIRTY + """,
numbers AS (
  SELECT e, price, plain, ind_raw, TRY_CAST(ind_score AS DOUBLE) AS s FROM dirty
),
clean AS (
  SELECT e, price, plain,
         CASE WHEN ind_raw < 9999 THEN ind_raw END AS ind_raw,
         CASE WHEN s < 9999 THEN least(greatest(s, 0.0::DOUBLE), 5.0::DOUBLE) END AS ind_score
  FROM numbers
)"""


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly grid in long form, with fill values in both measures."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_tax", month_of("l_shipdate").alias("t"))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    lat, lon = F.col("p_size").cast("double"), (F.col("l_partkey") % 40).cast("double")
    cells = (
        lookup_join(line, part, "l_partkey", "inner")
        .groupBy(lat.alias("lat"), lon.alias("lon"), "t")
        .agg(F.avg("p_retailprice").alias("price"), F.min("l_tax").alias("tax"))
    )
    place = F.col("lat") + F.col("lon")
    return cells.select(
        "lat", "lon", "t",
        F.when(place % 13 == 0, 1e20).when(place % 17 == 0, 1e10).otherwise(F.col("price")).alias("value"),
        F.when(place % 7 == 0, 1e10).otherwise(F.col("tax") * 100).alias("uncertainty"),
    )


GRID = """
grid AS (
  SELECT lat, lon, t,
         CASE WHEN (lat + lon) % 13 = 0 THEN 1e20::DOUBLE WHEN (lat + lon) % 17 = 0 THEN 1e10::DOUBLE
              ELSE price END AS value,
         CASE WHEN (lat + lon) % 7 = 0 THEN 1e10::DOUBLE ELSE tax * 100 END AS uncertainty
  FROM (SELECT CAST(p_size AS DOUBLE) AS lat, CAST(p_partkey % 40 AS DOUBLE) AS lon,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS t,
               avg(p_retailprice) AS price, min(l_tax) AS tax
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)
)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on and off the grid's axes."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("point"),
        ((key * F.lit(0.37)) % F.lit(50.0)).alias("lat"),
        ((key * F.lit(0.73)) % F.lit(40.0)).alias("lon"),
    )


POINTS = """
points AS (
  SELECT s_suppkey AS point, (s_suppkey * 0.37::DOUBLE) % 50.0::DOUBLE AS lat,
         (s_suppkey * 0.73::DOUBLE) % 40.0::DOUBLE AS lon
  FROM supplier
)"""

NEAREST = GRID + "," + POINTS + """,
lats AS (SELECT DISTINCT lat FROM grid), lons AS (SELECT DISTINCT lon FROM grid),
cell_lats AS (
  SELECT point, min_by(a.lat, row(abs(a.lat - p.lat), a.lat)) AS cell_lat FROM points p, lats a GROUP BY 1
),
cell_lons AS (
  SELECT point, min_by(a.lon, row(abs(a.lon - p.lon), a.lon)) AS cell_lon FROM points p, lons a GROUP BY 1
),
cells AS (
  SELECT p.point, p.lat, p.lon, cell_lat, cell_lon
  FROM points p JOIN cell_lats USING (point) JOIN cell_lons USING (point)
)"""

ROW_PLACE = "CAST(row_number() OVER (PARTITION BY e ORDER BY y) AS DOUBLE)"


def gap_fill(source: str, entity: str, order: str, columns: list[str], at: str, digits: int = 4) -> str:
    """SQL table expressions ending in ``filled``: linear gap fill of ``source``."""
    sides = ", ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN x END IGNORE NULLS) OVER back AS xb_{c}, "
        f"last_value({c} IGNORE NULLS) OVER back AS vb_{c}, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN x END IGNORE NULLS) OVER ahead AS xa_{c}, "
        f"first_value({c} IGNORE NULLS) OVER ahead AS va_{c}" for c in columns)
    out = ", ".join(
        f"round_even(CASE WHEN {c} IS NOT NULL THEN {c} WHEN vb_{c} IS NULL THEN va_{c} "
        f"WHEN va_{c} IS NULL THEN vb_{c} "
        f"ELSE vb_{c} + (va_{c} - vb_{c}) * (x - xb_{c}) / (xa_{c} - xb_{c}) END, {digits}) AS {c}" for c in columns)
    return f"""
placed AS (SELECT *, {at} AS x FROM {source}),
sides AS (SELECT *, {sides} FROM placed
  WINDOW back AS (PARTITION BY {entity} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY {entity} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT {entity}, {order}, {out} FROM sides)"""
