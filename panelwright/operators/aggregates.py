"""Grouped summaries (A1, A2, A5-A11, A20, A21, A23, A24) and their ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import existing, numeric_columns
from ..functions.scalars import flag_in, round_even
from .joins import keep_members, lookup_join
from ..session import materialise

NOT_INDICATORS = ["pfaf_id", "aq30_id", "aqid", "area_km2"]  # fixed: id columns that are never averaged


def mean_of_numeric(
    df: DataFrame, keys: Sequence[str], exclude: Sequence[str] = NOT_INDICATORS, digits: int = 4
) -> DataFrame:
    """A1: mean of every numeric column per key; groups with a missing key part vanish."""
    values = numeric_columns(df, [*exclude, *keys])
    return (
        df.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(*[round_even(F.avg(c), digits).alias(c) for c in values])
    )


def group_means(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A2."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def month_profile(df: DataFrame, month: str, value: str) -> DataFrame:
    """Mean and sample deviation per calendar month."""
    return df.groupBy(month).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, most frequent first, missing left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """A10: counts per category with their percentage of all rows.

    The counts are made once; the total is a scalar over that small result.
    """
    counts = materialise(frequency(df, column))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    shares = counts.withColumn("percent", F.col("count") * F.lit(100.0) / total)
    return shares.orderBy(F.desc("count"), column)  # a stored table has no order


def cross_tab(df: DataFrame, entity: str, category: str, classes: Sequence[str]) -> DataFrame:
    """Counts per entity and class, classes as columns in the given order, zeros filled."""
    return (
        df.filter(F.col(entity).isNotNull() & F.col(category).isNotNull())
        .groupBy(entity)
        .agg(*[F.count(F.when(F.col(category) == c, 1)).alias(c) for c in classes])
    )


def percent_where(predicate: Column) -> Column:
    """Share of rows that meet a predicate, in percent."""
    return F.avg(predicate.cast("double")) * F.lit(100.0)


def headline(df: DataFrame, score: str, category: str, measure: str, entity: str, high: Sequence[str]) -> DataFrame:
    """The four headline figures in one pass."""
    return df.agg(
        F.avg(score).alias("avg_score"),
        (F.avg(flag_in(category, high)) * F.lit(100.0)).alias("high_percent"),
        F.avg(measure).alias("avg_measure"),
        F.count_distinct(entity).alias("entities"),
    )


def extent(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Rows, columns, entities, first and last time."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count_distinct(entity).alias("entities"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def top_groups(df: DataFrame, keys: Sequence[str], value: str, k: int, name: str = "mean") -> DataFrame:
    """O2: the ``k`` groups with the highest mean; the key decides ties."""
    return (
        df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.avg(value).alias(name))
        .orderBy(F.desc_nulls_last(name), *keys).limit(k)
    )


def in_top_groups(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """Rows of the ``k`` groups with the highest mean."""
    top = materialise(top_groups(df, [key], value, k).select(key))
    return keep_members(df, top, key)


def spatial_mean(grid: DataFrame, time: str, value: str) -> DataFrame:
    """Unweighted mean over all cells of a time step, missing cells skipped."""
    return grid.groupBy(time).agg(F.avg(value).alias(value))


def class_counts(df: DataFrame, split: str, label: str) -> DataFrame:
    """A21."""
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("rows"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """O5."""
    return df.select(column).distinct().orderBy(column)


def cluster_profile(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Feature means per cluster, each profile scaled over its own features."""
    means = df.groupBy(cluster).agg(*[F.avg(f).alias(f) for f in features])
    low, high = F.least(*[F.col(f) for f in features]), F.greatest(*[F.col(f) for f in features])
    return means.select(
        cluster, *[((F.col(f) - low) / (high - low + F.lit(1e-8))).alias(f) for f in features]
    )


def name_by_rank(df: DataFrame, group: str, value: str, names: Sequence[str], into: str) -> DataFrame:
    """Groups get the listed names in ascending order of their mean value.

    There may be as many groups as names, so the ranked table is a handful of
    rows; more groups are an error.
    """
    means = df.groupBy(group).agg(F.avg(value).alias("_mean"))
    ranked = means.orderBy(F.asc_nulls_last("_mean"), group).limit(len(names) + 1).collect()
    if len(ranked) > len(names):
        raise ValueError(f"more groups than the {len(names)} names")
    named = df.sparkSession.createDataFrame(
        [(r[group], name) for r, name in zip(ranked, names)],
        df.select(group, F.lit("").alias(into)).schema,
    )
    return lookup_join(df, F.broadcast(named), group, "left")  # at most len(names) rows


def members(df: DataFrame, group: str, member: str) -> DataFrame:
    """One row per group and member, for groups of any size."""
    return df.select(group, member).na.drop().distinct()


def member_text(df: DataFrame, group: str, member: str, groups: Sequence) -> DataFrame:
    """Comma-joined members of the listed groups, for a report.

    A text of members only makes sense while it can be read, so the caller names
    the groups; ``members`` has every group at one row per member.
    """
    listed = members(df.filter(F.col(group).isin(list(groups))), group, member)
    return listed.groupBy(group).agg(F.array_join(F.sort_array(F.collect_list(member)), ", ").alias("members"))


def marker_table(df: DataFrame, keys: Sequence[str], value: str, lat: str, lon: str) -> DataFrame:
    """X13 input: mean value and place per entity, entities without a place left out."""
    means = group_means(df, keys, [value, *existing(df, [lat, lon])])
    return means.na.drop(subset=[lat, lon])
