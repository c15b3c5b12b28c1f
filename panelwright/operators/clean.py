"""Cleaning and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import numeric_columns
from ..functions.scalars import (
    SENTINEL, blank_equal, blank_fill, blank_from, clip, finite, is_valid_measure, missing_if_nan, round_even, to_number,
)
from .joins import lookup_join
from .quantiles import medians, scalar_medians
from ..session import materialise


def clean_indicators(
    df: DataFrame,
    renames: dict[str, str],
    key: str,
    indicator_cols: Sequence[str] | None = None,
    score_cols: Sequence[str] | None = None,
    low: float = 0.0,
    high: float = 5.0,
) -> DataFrame:
    """Rename, drop rows without a key, coerce, blank sentinels, clip scores.

    By default the columns are chosen by name after renaming: ``_score`` and
    ``_raw`` are coerced and blanked, ``_score`` is also clipped (T15). Pass the
    lists to cover further columns. Columns that are doubles already are not parsed again.
    """
    named = df.withColumnsRenamed(renames).na.drop(subset=[key])
    if indicator_cols is None:
        indicator_cols = [c for c in named.columns if "_score" in c or "_raw" in c]
    if score_cols is None:
        score_cols = [c for c in named.columns if "_score" in c]
    picked = []
    for c in named.columns:
        typed = isinstance(named.schema[c].dataType, T.DoubleType)
        value = blank_from(finite(c) if typed else to_number(c), SENTINEL) if c in indicator_cols else F.col(c)
        picked.append((clip(value, low, high) if c in score_cols else value).alias(c))
    return named.select(*picked)


def blank_sentinel_everywhere(df: DataFrame, value: float = SENTINEL) -> DataFrame:
    """Exact sentinel to missing in every numeric column."""
    numeric = set(numeric_columns(df))
    return df.select(*[blank_equal(c, value).alias(c) if c in numeric else F.col(c) for c in df.columns])


def round_numeric(df: DataFrame, digits: int = 4) -> DataFrame:
    """P13 over all fractional columns; whole numbers stay as they are."""
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)}
    return df.select(*[round_even(c, digits).alias(c) if c in fractional else F.col(c) for c in df.columns])


def drop_fill_values(df: DataFrame, value: str, side: str | None = None) -> DataFrame:
    """P20: drop rows with an unusable main value, blank an unusable side value."""
    kept = df.filter(is_valid_measure(value))
    return kept.withColumn(side, blank_fill(side)) if side and side in df.columns else kept


def fill_two_pass(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Missing takes the group's median, then the median of the filled column.

    The second pass over the data is made only for columns that still have gaps:
    those with a group that has no value at all, or with a missing value in a row
    without a group. Counts per group show which.
    """
    columns = list(columns)
    within = materialise(medians(df, columns, [group]).withColumnsRenamed({c: f"_m_{c}" for c in columns}))
    joined = lookup_join(df, within, [group], "left")
    first = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in columns})
    counts = df.groupBy(F.col(group).alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(missing_if_nan(F.col(c).cast("double"))).alias(f"_n_{c}") for c in columns])
    empty = counts.agg(*[F.bool_or(F.when(F.col("_group").isNull(), F.col(f"_n_{c}") < F.col("_rows")).otherwise(
        F.col(f"_n_{c}") == 0)).alias(c) for c in columns]).first()
    gaps = [c for c in columns if empty[c]]
    overall = scalar_medians(first, gaps) if gaps else {}
    filled = {c: F.coalesce(F.col(c), F.lit(overall[c])) for c in gaps if overall[c] is not None}
    return (first.withColumns(filled) if filled else first).select(*df.columns)


def fill_medians(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """M2: missing features take the column median of ``fit_on`` (default: the same rows)."""
    middle = scalar_medians(df if fit_on is None else fit_on, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(middle[c])) for c in columns if middle[c] is not None})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P14."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})
