"""Exact row numbers over a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

ROW_IN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id


def with_positions(df: DataFrame, order: Sequence[str], name: str = "pos") -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... over ``order``, whose columns must identify a row.

    Rows are range partitioned by sampled bounds, so a hot entity spreads over
    many tasks, and sorted. Each row is stored with its partition and its place
    in it; its number is then the count of rows in earlier partitions plus that
    place. Only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION)).alias("_place"),
        )
    )
    starts, total = [], 0
    for row in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        starts.append((row["_part"], total))
        total += row["n"]
    # one row per partition: bounded by the partition count, not by the data
    offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _start long"))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], values: dict[str, Column], small_groups: bool
) -> DataFrame:
    """Add inclusive running sums over ``order`` inside each group.

    ``(group, order)`` must identify a row. Unless groups are known to be small, a
    group is range partitioned: sums run inside its slices, and each slice starts
    from the total of the slices before it.
    """
    group = list(group)
    if small_groups:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(v).over(w).alias(n) for n, v in values.items()])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialise(
        df.repartitionByRange(parts, *group, *order).select(
            "*", F.spark_partition_id().alias("_slice"), *[v.alias(n) for n, v in values.items()]))
    slices = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*group, "_slice").agg(*[F.sum(n).alias(n) for n in values])
    starts = materialise(totals.select(
        *group, "_slice", *[F.coalesce(F.sum(n).over(slices), F.lit(0)).alias(f"{n}_start") for n in values]))
    w = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = sliced.select(*df.columns, "_slice", *[F.sum(n).over(w).alias(n) for n in values])
    return inside.join(starts, [*group, "_slice"]).select(
        *df.columns, *[(F.col(n) + F.col(f"{n}_start")).alias(n) for n in values])


def contiguous_folds(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """``k`` contiguous folds over ``order``; the first ones take the surplus rows."""
    numbered = with_positions(df, order, "_pos")
    n = numbered.count()
    size, surplus = divmod(n, k)
    edge = surplus * (size + 1)
    pos = F.col("_pos")
    fold = F.when(pos < edge, F.floor(pos / F.lit(size + 1)))
    fold = fold.otherwise(F.lit(surplus) + F.floor((pos - F.lit(edge)) / F.lit(max(size, 1))))
    return numbered.withColumn(name, fold.cast("int")).drop("_pos")


def stratified_folds(
    df: DataFrame, label: str, key: Sequence[str], k: int, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """``k`` shuffled folds in which every class is spread evenly.

    Within a class rows are ordered by a seeded hash and dealt out in turn, so
    fold sizes per class differ by at most one, whatever the class sizes.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *key))
    numbered = with_positions(hashed, [label, "_hash", *key], "_pos")
    return numbered.withColumn(name, F.pmod(F.col("_pos"), F.lit(k)).cast("int")).drop("_pos", "_hash")


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """M4 fallback: mark ``test_share`` of every class as test rows, spread evenly over a seeded order.

    Rows are numbered class by class; a row is taken whenever the share reaches
    the next whole number, so a class differs from its share by less than one row.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *key))
    numbered = with_positions(hashed, [label, "_hash", *key], "_pos")
    share, pos = F.lit(float(test_share)), F.col("_pos")
    taken = F.floor((pos + 1) * share) > F.floor(pos * share)
    return numbered.withColumn("is_test", taken).drop("_pos", "_hash")
