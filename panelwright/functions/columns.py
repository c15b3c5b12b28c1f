"""Column choice from the schema alone (P8-P11, P21, M1): no job is run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """P9."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def columns_with(df: DataFrame, *parts: str) -> list[str]:
    """Names holding one of ``parts`` (case counts)."""
    return [c for c in df.columns if any(p in c for p in parts)]


def topic_columns(
    df: DataFrame, topics: Sequence[str], at_least: int = 3, fallback: int | None = None
) -> list[str]:
    """Numeric columns about the topics; all numeric ones, or the first ``fallback``, if too few match."""
    numeric = numeric_columns(df)
    hits = [c for c in numeric if any(t in c.lower() for t in topics)]
    return hits if len(hits) >= at_least else numeric[:fallback]


def existing(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """The candidates that exist, in candidate order."""
    return [c for c in candidates if c in df.columns]


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*names)


def feature_columns(df: DataFrame, wanted: Sequence[str], never: Iterable[str]) -> list[str]:
    """M1: wanted columns that exist, else every numeric column but ``never``."""
    return existing(df, wanted) or numeric_columns(df, never)
