"""Document fingerprints: the ``k`` least hashes of a text's word shingles, as sorted arrays of longs.

Words are what white space separates after lower-casing; a shingle is ``size`` consecutive words, or the whole sequence
if there are fewer words, but some. The sketch of a union is the ``k`` least hashes of the sketches' union, so sketches
merge across parts. All functions are column expressions or plain DataFrame operations.

Defined cases: null and empty texts, and texts of white space, have the empty sketch; two empty sketches are alike (1),
an empty and another one are not (0); equal texts have equal sketches; texts are taken whole; repeated rows are
fingerprinted row by row; other columns stay as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, SIZE = 128, 5


def with_sketch(df: DataFrame, text_col: str, out_col: str, k: int = K, size: int = SIZE) -> DataFrame:
    """``df`` with the sketch of a text column beside its columns."""
    words = f"_words_{uuid.uuid4().hex}"
    parts = F.array_remove(F.split(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"\s+", -1), "")
    n = F.size(words)
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))),
                           lambda i: F.xxhash64(F.slice(F.col(words), i, F.lit(size))))
    sketch = F.when(n > 0, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).otherwise(
        F.array().cast("array<bigint>"))
    return df.withColumn(words, parts).withColumn(out_col, sketch).drop(words)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both (0 to 1)."""
    both = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the place of the k-th hash."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second has as well (0 to 1)."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as lower-case hex, 16 digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_rows(df: DataFrame, group_cols: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its rows.

    Each task keeps the ``k`` least hashes of a group before anything is shuffled, so a large group stays small.
    """
    least = Window.partitionBy(*group_cols).orderBy("_h")
    hashes = df.select(*group_cols, F.explode(sketch_col).alias("_h")).distinct()
    top = hashes.withColumn("_place", F.row_number().over(least)).where(F.col("_place") <= k)
    return top.groupBy(*group_cols).agg(F.sort_array(F.collect_list("_h")).alias(sketch_col))


def buckets_by_descending_id(docs: DataFrame, id_col: str, rows: int = 2000, most: int = 16384):
    """A column with the number of an id's bucket, buckets being consecutive ranges of descending ids of about
    ``rows`` rows, and the largest id of each bucket that has any. Null ids count as the least."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(key.alias("id"))
    n = min(most, ids.count() // rows)
    bounds = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        bounds = sorted(set(ids.agg(F.percentile_approx("id", at, 10 * n)).first()[0]), reverse=True)
    bucket = F.lit(0)
    if bounds:  # count the bounds above the id by halving steps
        steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
        table = F.array(*map(F.lit, bounds)) if len(bounds) < 8 else F.lit(bounds)
        bucket = F.aggregate(F.lit(steps), F.lit(0), lambda low, step: F.when(
            (low + step <= len(bounds)) & (F.get(table, low + step - 1) > key), low + step).otherwise(low))
    heads = ids.withColumnRenamed("id", id_col).groupBy(bucket.alias("b")).agg(F.max(id_col).alias("id")).collect()
    return bucket, sorted((r["b"], r["id"]) for r in heads)  # at most ``most`` rows


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = SIZE) -> DataFrame:
    """Every text beside itself edited: its last third replaced by the start of the next text, by descending id.

    Returns ``(id, n_chars, edited_sha256, sketch, edited_sketch, next_sketch)``. Texts are shuffled once, into ranges of
    ids; each range also gets the first text of the range after it. Rows of one id are ordered by
    the hash of the text.
    """
    bucket, heads = buckets_by_descending_id(docs, id_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(bucket.alias("b"), F.lit(False).alias("lent"), key.alias("k"), F.col(id_col).alias("id"), text.alias("t"))
    follower = {heads[(i + 1) % len(heads)][1]: b for i, (b, _) in enumerate(heads)}
    wanted = docs.where(key.isin(list(follower)) if follower else F.lit(False))
    to = F.create_map(*[F.lit(x) for pair in follower.items() for x in pair])[F.col("k")] if follower else F.lit(0)
    lent = wanted.groupBy(key.alias("k")).agg(F.min_by(text, F.xxhash64(text)).alias("t")).select(
        to.alias("b"), F.lit(True).alias("lent"), "k", F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), "t")
    order = Window.partitionBy("b").orderBy("lent", F.desc("k"), "o")
    both = rows.unionByName(lent).withColumn("o", F.xxhash64("t")).withColumn("next", F.lead("t").over(order))
    n = F.length("t")
    cut = F.floor(n / 3).cast("int")
    made = both.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("t"), F.lit(1), n - cut),
                           F.substring(F.coalesce(F.col("next"), F.lit("")), F.lit(1), cut))).drop("next")
    made = with_sketch(with_sketch(made, "t", "sketch", k, size).drop("t"), "edited", "edited_sketch", k, size)
    made = made.withColumn("edited_sha256", F.sha2(F.col("edited"), 256)).drop("edited")
    made = made.withColumn("next_sketch", F.lead("sketch").over(order)).where(~F.col("lent"))
    return made.select("id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "next_sketch")
