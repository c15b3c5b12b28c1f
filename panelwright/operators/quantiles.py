"""Exact interpolated quantiles of any size of data (A3, A4, and the base of A12, A19, W8, M2)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import missing_if_nan
from ..session import materialise
from .joins import lookup_join, spread_join
from .positions import running_totals

#: Size of a group's sketch. The answer is exact whatever it is; a larger one costs every task, a smaller one widens brackets.
ACCURACY = 10_000
TASK_ROWS = 2_000_000


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int = ACCURACY
) -> DataFrame:
    """Linear-interpolation quantiles (T5) per group and column.

    Result: ``by``..., ``column``, ``n`` (values present), ``q`` (in ``probs`` order).
    Rows with a missing group key are left out (T13).

    The built-in exact percentile keeps every distinct value of a group in one
    buffer. Here three map-side combined passes bound what a task holds:

    1. a mergeable sketch brackets each wanted rank within ``slack * n`` rows
       (small groups: by their minimum and maximum);
    2. the values below each bracket are counted;
    3. only the values inside brackets, ``2 * slack * n`` per quantile, are
       grouped and ranked, which gives the exact answer. If even these could be
       too many for a task, they are ranked slice by slice.

    Should a bracket miss its rank, the search is repeated with wider ones, up
    to the full range.
    """
    slack = 4.0 / accuracy
    while True:
        found = materialise(_search(df, columns, probs, by, accuracy, slack))
        if slack == 1.0 or found.filter(F.exists("q", lambda x: x.isNull())).isEmpty():
            return found
        slack = min(1.0, slack * 100)


def table_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> dict[str, list[float | None]]:
    """The same over whole columns; the few numbers come back as plain values."""
    slack = 4.0 / accuracy
    while True:
        rows = _search(df, columns, probs, (), accuracy, slack).collect()  # one row per column
        if slack == 1.0 or not any(x is None for r in rows for x in r["q"]):
            found = {r["column"]: list(r["q"]) for r in rows}
            return {c: found.get(c, [None] * len(probs)) for c in columns}
        slack = min(1.0, slack * 100)


def _search(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int, slack: float
) -> DataFrame:
    by, columns, probs = list(by), list(columns), list(probs)
    share = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    ids = range(len(columns))
    data = df.select(*by, *[missing_if_nan(F.col(c).cast("double")).alias(f"_v{i}")
                            for i, c in enumerate(columns)])
    sketches = [_bracket(f"_v{i}", share, accuracy).alias(f"_b{i}") for i in ids]
    if by:
        data = data.na.drop(subset=by)
        brackets = materialise(data.groupBy(*by).agg(*sketches))
        largest = brackets.agg(F.max(F.greatest(F.lit(0), *[F.col(f"_b{i}.n") for i in ids]))).first()[0] or 0
        data = spread_join(data, brackets, by)
        bracket = [F.col(f"_b{i}") for i in ids]
    else:
        row = data.agg(*sketches).first()  # a few numbers per column
        largest = max(row[i]["n"] for i in ids)
        bracket = [F.struct(*[_numbers(row[i][part]).alias(part) for part in ("low", "high")]) for i in ids]

    ranks = range(len(probs))
    # the aggregate holds numbers only, so it hashes; bounds in its buffer would have it sort all rows
    counts = data.groupBy(*by).agg(
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in ids],
        *[F.count_if(F.col(f"_v{i}") < bracket[i]["low"][k]).alias(f"_l{i}_{k}") for i in ids for k in ranks])
    below = lookup_join(counts, brackets, by, "inner") if by else counts
    facts = below.select(*by, F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("_c"), F.col(f"_n{i}").alias("n"), bracket[i]["low"].alias("low"), bracket[i]["high"].alias("high"),
            F.array(*[F.col(f"_l{i}_{k}") for k in ranks]).alias("below")) for i in ids])))

    def inside(v: Column, low: Column, high: Column) -> Column:
        hit = v.between(low[0], high[0])
        for k in ranks[1:]:
            hit = hit | v.between(low[k], high[k])
        return hit

    hits = [inside(F.col(f"_v{i}"), bracket[i]["low"], bracket[i]["high"]) for i in ids]
    cells = F.array_compact(F.array(*[
        F.when(hits[i], F.struct(F.lit(i).alias("_c"), F.col(f"_v{i}").alias("_v"))) for i in ids]))
    # most rows have no value inside a bracket, and get no array
    kept = data.filter(reduce(lambda a, b: a | b, hits)).select(*by, F.inline(cells)).groupBy(*by, "_c", "_v").agg(F.count(F.lit(1)).alias("_rows"))
    # for whole tables the facts are one row per column
    ranked = kept.join(facts if by else F.broadcast(facts), [*by, "_c"])
    inside_rows = max(accuracy // 2, 3 * slack * largest * len(probs))
    ranked = running_totals(ranked, [*by, "_c"], ["_v"], {
        f"_upto{k}": F.when(F.col("_v") >= F.col("low")[k], F.col("_rows")).otherwise(0) for k in ranks
    }, inside_rows <= TASK_ROWS)
    ranked = ranked.withColumns({f"_upto{k}": F.col("below")[k] + F.col(f"_upto{k}") for k in ranks})
    picks = []
    for k, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        for name, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (
                F.col("_v").between(F.col("low")[k], F.col("high")[k])
                & (F.col(f"_upto{k}") - F.col("_rows") <= rank) & (rank < F.col(f"_upto{k}"))
            )
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{name}{k}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_f{k}"))
    found = ranked.groupBy(*by, "_c").agg(F.max("n").alias("n"), *picks)
    names = F.array(*[F.lit(c) for c in columns])
    result = found.select(
        *by,
        F.element_at(names, F.col("_c") + 1).alias("column"),
        "n",
        F.array(*[F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * F.col(f"_f{k}")
                  for k in ranks]).alias("q"),
    )
    return result


def _bracket(column: str, share: Sequence[float], accuracy: int) -> Column:
    """Bounds around each wanted rank; the whole range where that is few values."""
    m = len(share) // 2
    bounds = F.percentile_approx(column, list(share), accuracy)
    few = F.count(column) <= accuracy // 2
    return F.struct(
        F.count(column).alias("n"),
        F.when(few, F.array_repeat(F.min(column), m)).otherwise(F.slice(bounds, 1, m)).alias("low"),
        F.when(few, F.array_repeat(F.max(column), m)).otherwise(F.slice(bounds, m + 1, m)).alias("high"),
    )


def _numbers(values: Sequence[float] | None) -> Column:
    if values is None:
        return F.lit(None).cast("array<double>")
    return F.array(*[F.lit(x).cast("double") for x in values])


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """A3, wide: one row per group, one median column per input column."""
    long = exact_quantiles(df, columns, [0.5], by)
    picks = [F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns]
    return long.groupBy(*by).agg(*picks)


def scalar_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """A3 over whole columns."""
    return {c: q[0] for c, q in table_quantiles(df, columns, [0.5]).items()}
