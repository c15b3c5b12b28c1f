"""Joins of a large fact side to lookup, static and yearly relations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

WAYS = 16


def lookup_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Join a large side to a usually small one that is a file or materialised.

    The size of such a lookup is known, so it is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold``. Beyond that the join shuffles, and
    adaptive execution splits the partitions of a hot key
    (``spark.sql.adaptive.skewJoin.enabled``) unless an aggregate on that key
    follows without an exchange; for that see ``spread_join``.
    """
    return fact.join(lookup, [on] if isinstance(on, str) else list(on), how)


def spread_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", ways: int = WAYS) -> DataFrame:
    """The same ahead of an aggregate on the join key: a key's rows go to ``ways`` tasks.

    Fact rows are dealt to ways, lookup rows are repeated for each. As the result
    is not partitioned by the key alone, the aggregate works inside each way first.
    """
    dealt = fact.withColumn("_way", (F.monotonically_increasing_id() % ways).cast("int"))
    repeated = lookup.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return lookup_join(dealt, repeated, [*on, "_way"], how).drop("_way")


def duplicate_keys(lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return lookup.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def left_join_suffixed(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    suffix: str,
    require_unique: bool = False,
) -> DataFrame:
    """Left join in which a clashing lookup column gets ``suffix``.

    ``require_unique`` refuses a lookup that would multiply fact rows (T11).
    """
    keys = list(on)
    if require_unique:
        surplus = duplicate_keys(lookup.na.drop(subset=keys), keys).limit(3).collect()
        if surplus:
            raise ValueError(f"join key {keys} is not unique, e.g. {surplus}")
    clash = {c: c + suffix for c in lookup.columns if c in fact.columns and c not in keys}
    return lookup_join(fact, lookup.withColumnsRenamed(clash), keys, "left")


def map_values(df: DataFrame, column: str, pairs: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """Dictionary lookup; no entry gives missing."""
    entries = pairs.select(F.col(key).alias(column), F.col(value).alias(into))
    return lookup_join(df, entries, column, "left")


def keep_members(df: DataFrame, members: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in another query's result."""
    return lookup_join(df, members, on, "left_semi")


def prune_to(stored: DataFrame, members: DataFrame, on: str) -> DataFrame:
    """Rows of a table stored by ``on`` whose value another query has found.

    The found values are stored, so their size is known: while it allows a broadcast, the scan of ``stored`` reads only
    their partitions (dynamic pruning needs a filter on that side, which the mark provides); beyond it the join shuffles.
    """
    found = materialise(members.select(on).filter(F.col(on).isNotNull()).distinct().withColumn("_in", F.lit(1)))
    return lookup_join(stored, found.filter(F.col("_in") > 0).select(on), on, "left_semi")


def bucket_join(fact: DataFrame, lookup: DataFrame, buckets: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """Left join of two tables stored with the same buckets, on the bucket columns and ``rest``, without an exchange.

    Spark takes buckets for a join only if its keys are the bucket columns alone, so the lookup becomes one row per
    bucket key, with a map from the rest of the key to its values. ``(buckets, rest)`` must identify a lookup row, and
    a key must have few rows, as years of an entity are.
    """
    values = [c for c in lookup.columns if c not in (*buckets, *rest)]
    entry = F.struct(F.struct(*rest).alias("_key"), F.struct(*values).alias("_value"))
    known = lookup.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rest]))
    packed = known.groupBy(*buckets).agg(F.map_from_entries(F.collect_list(entry)).alias("_of"))
    joined = fact.join(packed.hint("merge"), list(buckets), "left")
    found = joined.withColumn("_found", F.try_element_at("_of", F.struct(*rest)))
    return found.select(*fact.columns, *[F.col(f"_found.{c}").alias(c) for c in values])
