"""Data profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..functions.scalars import missing_if_nan, round_even
from ..session import materialise
from .joins import spread_join
from .quantiles import exact_quantiles, table_quantiles

#: Of the density: cell width and reach in bandwidths, and moments of a cell. With |b| <= 1/4 the terms left out sum to less
#: than max(a^18 exp(-a*a/2)) / 4^18 / 18! * e < 1e-17, and kernels left out are below exp(-9.5^2/2) < 3e-20.
CELL, NEAR, TERMS = 0.5, 9.75, 18


def describe(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3) -> DataFrame:
    """Count, mean, std, min, quartiles and max, one row per numeric column.

    All moments come from one pass; the quartiles are exact (T5).
    """
    columns = list(columns or numeric_columns(df))
    data = df.select(*[missing_if_nan(F.col(c).cast("double")).alias(c) for c in columns])
    quartiles = table_quantiles(data, columns, [0.25, 0.5, 0.75])
    rows = []
    for i, c in enumerate(columns):
        p25, p50, p75 = (F.lit(x).cast("double") for x in quartiles[c])
        figures = {"mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c),
                   "p25": p25, "p50": p50, "p75": p75, "max": F.max(c)}
        rows.append(F.struct(F.lit(c).alias("column"), F.count(c).alias("count"),
                             *[round_even(v, digits).alias(n) for n, v in figures.items()]).alias(f"_s{i}"))
    return data.agg(*rows).select(F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(columns))])))


def null_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Columns with missing values, their count and percentage, worst first."""
    cells = df.agg(*[
        F.struct(F.lit(c).alias("column"),
                 F.sum(F.col(c).isNull().cast("long")).alias("missing"),
                 F.count(F.lit(1)).alias("_rows")).alias(f"_s{i}")
        for i, c in enumerate(df.columns)
    ]).select(F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(df.columns))])))
    return (
        cells.filter("missing > 0")
        .select("column", "missing",
                round_even(F.col("missing") * F.lit(100.0) / F.col("_rows"), digits).alias("percent"))
        .orderBy(F.desc("percent"), "column")
    )


def _correlation(a: str, b: str) -> Column:
    """Pairwise-complete Pearson; missing for a constant column, never an error.

    Constants are told by their range: merged partial deviations of a constant
    need not be exactly zero.
    """
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


#: A pair in which a column keeps less than this share of its mean square is looked at value by value.
FLAT = 1e-6


def _masked_products(data: DataFrame, columns: list[str]) -> dict[str, np.ndarray]:
    """Over all pairs of columns: rows in which both are known (``n``), and sums over these rows of the first (``x``), its
    square (``xx``), and the product of both (``xy``), columns being centred and scaled.

    Each row becomes one vector of masks, values and squares, whose Gram matrix holds all of these at once. Spark's
    covariance sums it in arrays, a triangle of it per task, whatever the number of columns; columns^2 numbers reach the
    driver.
    """
    d = len(columns)
    fitted = data.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    moved = []
    for i, c in enumerate(columns):
        centre, spread = fitted[f"_{i}"]["m"] or 0.0, fitted[f"_{i}"]["s"] or 0.0
        scale = spread if spread > 1e-12 * abs(centre) else 1.0
        moved.append((F.col(c) - F.lit(centre)) / F.lit(scale))
    placed = data.select(*[v.alias(f"_v{i}") for i, v in enumerate(moved)])
    values = [F.col(f"_v{i}") for i in range(d)]
    cells = [F.when(v.isNull(), 0.0).otherwise(1.0) for v in values] + [F.coalesce(v, F.lit(0.0)) for v in values]
    z = materialise(placed.select(array_to_vector(F.array(*cells, *[F.coalesce(v * v, F.lit(0.0)) for v in values])).alias("z")))
    row = z.agg(F.count(F.lit(1)).alias("n"), Summarizer.metrics("mean", "variance").summary(F.col("z")).alias("s")).first()
    n, mean, variance = row["n"], row["s"]["mean"].toArray(), row["s"]["variance"].toArray()
    related = Correlation.corr(z, "z").first()[0].toArray()
    covariance = np.nan_to_num(related) * np.sqrt(np.outer(variance, variance))
    gram = covariance * (n - 1) + n * np.outer(mean, mean)
    return {"n": np.rint(gram[:d, :d]), "x": gram[d:2 * d, :d], "xx": gram[2 * d:, :d], "xy": gram[d:2 * d, d:2 * d]}


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 3, lower: bool = False) -> DataFrame:
    """A14 in long form: one row per ordered pair, or only the strict lower triangle.

    All pairs come from one matrix of sums (``_masked_products``). Where a column hardly varies among a pair's rows,
    the pair's values are looked at once more, which tells constants by their range; all such pairs share one job.
    """
    columns = list(columns)
    d = len(columns)
    data = materialise(df.select(*[missing_if_nan(F.col(c).cast("double")).alias(c) for c in columns]))
    found = np.full((d, d), None, dtype=object)
    if len(data.take(2)) == 2:
        sums = _masked_products(data, columns)
        n, x = np.maximum(sums["n"], 1.0), sums["x"]
        own = n * sums["xx"] - x * x
        with np.errstate(all="ignore"):
            r = (n * sums["xy"] - x * x.T) / np.sqrt(own * own.T)
        doubtful = (own <= FLAT * n * np.maximum(sums["xx"], 1.0)) | ~np.isfinite(r) & (sums["n"] > 1)
        doubtful |= doubtful.T
        for i, j in zip(*np.nonzero((sums["n"] > 1) & ~doubtful)):
            found[i, j] = float(np.clip(r[i, j], -1.0, 1.0))
        again = [(int(i), int(j)) for i, j in zip(*np.nonzero((sums["n"] > 1) & doubtful)) if j <= i]
        flat = [i for i in range(d) if doubtful[i, i]]
        ends = data.agg(F.count(F.lit(1)), *[(F.min(columns[i]) < F.max(columns[i])).alias(f"_{i}") for i in flat]).first()
        constant = {i for i in flat if not ends[f"_{i}"]}
        again = [(i, j) for i, j in again if not {i, j} & constant]
        if again:
            each = data.select(F.array(*columns).alias("_v"), F.explode(F.lit([list(p) for p in again])).alias("_p"))
            each = each.select(F.col("_p")[0].alias("_i"), F.col("_p")[1].alias("_j"),
                               F.get("_v", F.col("_p")[0]).alias("_x"), F.get("_v", F.col("_p")[1]).alias("_y"))
            both = each.filter("_x is not null and _y is not null").groupBy("_i", "_j").agg(_correlation("_x", "_y").alias("r"))
            for row in both.collect():
                found[row["_i"], row["_j"]] = found[row["_j"], row["_i"]] = row["r"]
    cells = [(columns[i], columns[j], found[i, j]) for i in range(d) for j in range(i if lower else d)]
    table = df.sparkSession.createDataFrame(cells, "a string, b string, r double")
    return table.withColumn("r", round_even("r", digits))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bins`` equal bins from minimum to maximum, last one closed, empty ones kept."""
    data = df.select(missing_if_nan(F.col(value).cast("double")).alias("_v")).filter("_v is not null")
    ends = data.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = ends["lo"], ends["hi"]
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return all_bins.select("bin", F.lit(None).cast("double").alias("left_edge"),
                               F.lit(0).cast("long").alias("count"), F.lit(0.0).alias("density"))
    if lo == hi:  # one value: a unit-wide range around it
        lo, hi = lo - 0.5, hi + 0.5
    place = F.floor((F.col("_v") - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)) + 1
    counts = data.groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("_n"))
    width = (hi - lo) / bins
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("left_edge"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("count"),
        (F.coalesce("_n", F.lit(0)) / F.lit(ends["n"] * width)).alias("density"),
    )


def density(df: DataFrame, value: str, points: int = 1000) -> DataFrame:
    """Gaussian density on ``points`` places over the range widened by half on each side.

    Bandwidth h: sample deviation times n^(-1/5). A fast Gauss transform: values fall into cells of half a bandwidth,
    and a cell is known by ``TERMS`` moments. With a and b the distances of a place and of a value from the cell's centre
    in bandwidths, a kernel is exp(-a*a/2) times the sum over p of a^p/p! times b^p exp(-b*b/2). Cut off at
    ``TERMS``, and beyond ``NEAR`` bandwidths, each kernel is right to 1e-15 of its peak. Moments are combined on
    the map side, so one row per cell and task is shuffled; a cell, never a value, is spread over places.
    """
    data = df.select(missing_if_nan(F.col(value).cast("double")).alias("_v")).filter("_v is not null")
    s = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("_v").alias("std"),
                 F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    if s["n"] < 2 or not s["std"]:
        raise ValueError("a density needs at least two different values")
    h = s["std"] * s["n"] ** -0.2
    lo, start = s["lo"], s["lo"] - 0.5 * (s["hi"] - s["lo"])
    step = 2.0 * (s["hi"] - s["lo"]) / (points - 1)
    cell = F.floor((F.col("_v") - F.lit(lo)) / F.lit(CELL * h))
    centre = F.lit(lo) + (F.col("_cell") + F.lit(0.5)) * F.lit(CELL * h)
    placed = data.select("_v", cell.alias("_cell"))
    placed = placed.select("_cell", ((F.col("_v") - centre) / F.lit(h)).alias("_b"))
    moment, moments = F.exp(F.col("_b") * F.col("_b") * F.lit(-0.5)), []
    for p in range(TERMS):
        moments.append(F.sum(moment).alias(f"_m{p}"))
        moment = moment * F.col("_b")
    cells = placed.groupBy("_cell").agg(*moments)
    reach = NEAR * h
    first = F.greatest(F.lit(0), F.ceil((centre - F.lit(reach + start)) / F.lit(step)))
    last = F.least(F.lit(points - 1), F.floor((centre + F.lit(reach - start)) / F.lit(step)))
    reached = cells.withColumns({"_first": first.cast("int"), "_last": last.cast("int")}).filter("_first <= _last")
    reached = reached.withColumn("i", F.explode(F.sequence("_first", "_last")))
    reached = reached.withColumn("_a", (F.lit(start) + F.col("i") * F.lit(step) - centre) / F.lit(h))
    series = F.lit(0.0)
    for p in reversed(range(TERMS)):
        series = F.col(f"_m{p}") + series * F.col("_a") / F.lit(float(p + 1))
    sums = reached.groupBy("i").agg(F.sum(F.exp(F.col("_a") * F.col("_a") * F.lit(-0.5)) * series).alias("_s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    scale = 1.0 / (s["n"] * h * math.sqrt(2 * math.pi))
    return grid.join(sums, "i", "left").select(
        "i",
        (F.lit(start) + F.col("i") * F.lit(step)).alias("x"),
        (F.greatest(F.coalesce("_s", F.lit(0.0)), F.lit(0.0)) * F.lit(scale)).alias("density"),
    )


def box_summary(df: DataFrame, category: str, value: str) -> DataFrame:
    """Quartiles and whisker ends (furthest values within 1.5 IQR) per category."""
    quartiles = exact_quantiles(df, [value], [0.25, 0.5, 0.75], [category])
    fences = materialise(quartiles.select(
        category, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
    ))
    joined = spread_join(df.select(category, F.col(value).cast("double").alias("_v")), fences, [category])
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(category).agg(
        *[F.max(c).alias(c) for c in ("n", "q1", "median", "q3")],
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
    )
