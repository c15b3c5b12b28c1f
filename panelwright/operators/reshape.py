"""Long to wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_first(
    df: DataFrame, index: Sequence[str], column: str, value: str, names: Sequence[str], order: str
) -> DataFrame:
    """Per cell the first present value by ``order`` (T7), one column per name.

    One grouped pass with map-side combine; no second shuffle for the pivot.
    Index rows with a missing key part vanish.
    """
    cell = lambda n: (F.col(column) == n) & F.col(value).isNotNull()
    kept = df.na.drop(subset=list(index)).filter(F.col(column).isin(*names))
    return kept.groupBy(*index).agg(
        *[F.min_by(F.when(cell(n), F.col(value)), F.when(cell(n), F.col(order))).alias(n) for n in names]
    ).na.drop("all", subset=list(names))


def pivot_mean(df: DataFrame, index: Sequence[str], column: str, value: str, names: Sequence[str]) -> DataFrame:
    """Per cell the mean."""
    kept = df.na.drop(subset=list(index)).filter(F.col(column).isin(*names))
    return kept.groupBy(*index).agg(
        *[F.avg(F.when(F.col(column) == n, F.col(value))).alias(n) for n in names]
    ).na.drop("all", subset=list(names))
