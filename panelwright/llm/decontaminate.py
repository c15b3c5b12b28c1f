"""Benchmark decontamination: word windows of test items searched in training text.

Words are maximal runs of ASCII letters and digits and of all characters beyond ASCII, after lower-casing
A-Z. A window is ``size`` consecutive words of an item; an item with fewer words, but not none, is one
window. A document word is hit if it lies inside an occurrence of any window.

The items' distinct windows form a hash set, which is broadcast when its measured size is within
``broadcast_bytes`` and is joined by a shuffle beyond it. Hash hits are verified word by word.

Defined cases: null or empty text has no words and no hits; items without words have no window; a null
item id is listed as ``null``; equal windows of several items count for each of them; repeated rows give
one result row each; an empty benchmark leaves every document clean; other columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters between words, and characters of words as they stand in the text.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WITHIN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    """Lower-cased words of a text; an empty array for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN + "+", -1)
    return F.array_remove(parts, "")


def item_windows(benchmark: DataFrame, size: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(h, k, gram, item)``: hash, length and words of a window, and the item it is from."""
    words = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text_col)).alias("w"))
    words = words.where(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(size)))
    at = words.select("item", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("p"))
    gram = F.slice("w", F.col("p"), F.col("k"))
    return at.select(F.xxhash64(gram).alias("h"), "k", F.array_join(gram, " ").alias("gram"), "item").distinct()


def places(n: Column, k: int) -> Column:
    """``(p, k)`` for every window of ``k`` words in a text of ``n``."""
    starts = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda p: F.struct(p.alias("p"), F.lit(k).alias("k")))


def find_hits(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents ``(id, th, n_words)``, verified hits ``(id, th, pos, k, gram)`` and windows ``(h, k, gram, item)``.

    ``th`` is the hash of the text: results depend on the text alone, so ``(id, th)`` may repeat.
    Positions count words from 0.
    """
    windows = materialise(item_windows(benchmark, size, item_col, item_text_col))
    measured = windows.groupBy("k").agg(F.count("*").alias("n"), F.sum(F.length("gram") * 4 + 64).alias("b")).collect()
    lengths, total = sorted(r["k"] for r in measured), sum(r["b"] for r in measured)  # at most ``size`` rows
    grams = windows.select("h", "k", "gram").distinct()
    text = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"),
                       words_of(F.col(text_col)).alias("w"))
    n = F.size("w")
    # one array entry per window, and position -1 once per document, which carries its word count
    spans = F.array(F.struct(F.lit(-1).alias("p"), F.lit(0).alias("k")))
    if lengths:
        spans = F.concat(spans, F.flatten(F.array(*[places(n, k) for k in lengths])))
    if len(lengths) == 1:  # the usual case: plain positions, without an array of pairs
        only = lengths[0]
        rows = text.select("id", "th", "w", F.explode(F.sequence(F.lit(-1), F.greatest(n - only, F.lit(-1)))).alias("p"))
        rows = rows.withColumn("k", F.when(F.col("p") >= 0, F.lit(only)).otherwise(F.lit(0)))
    else:
        rows = text.select("id", "th", "w", F.explode(spans).alias("s")).select("id", "th", "w", "s.p", "s.k")
    h = F.when(F.col("p") >= 0, F.xxhash64(F.slice("w", F.col("p") + 1, F.col("k"))))
    joined_words = F.array_join(F.slice("w", F.col("p") + 1, F.col("k")), " ")
    if total <= broadcast_bytes:
        known = F.broadcast(grams.select("h", F.col("k").alias("k2"), "gram"))
        found = rows.withColumn("h", h).join(known, "h", "left")
        found = found.where((F.col("p") < 0) | ((F.col("k") == F.col("k2")) & (F.col("gram") == joined_words)))
        found = materialise(found.select("id", "th", F.col("p").alias("pos"), "k", "gram",
                                         F.when(F.col("p") < 0, n).alias("n_words")))
        sizes = found.where("pos < 0").select("id", "th", "n_words")
        return sizes, found.where("pos >= 0").select("id", "th", "pos", "k", "gram"), windows
    sizes = text.select("id", "th", n.alias("n_words"))
    keys = rows.where("p >= 0").select("id", "th", "p", "k", h.alias("h"))
    near = materialise(keys.join(grams, ["h", "k"]).distinct())
    wanted = near.groupBy("id", "th").agg(F.collect_set(F.struct("p", "k", "gram")).alias("c"))
    checked = (text.withColumnRenamed("id", "i2").withColumnRenamed("th", "t2")
               .join(wanted, F.col("i2").eqNullSafe(F.col("id")) & (F.col("t2") == F.col("th")))
               .select("id", "th", "w", F.explode("c").alias("c")).select("id", "th", "w", "c.*")
               .where(F.col("gram") == joined_words))
    return sizes, materialise(checked.select("id", "th", F.col("p").alias("pos"), "k", "gram").distinct()), windows


def merged_spans(spans: Column) -> Column:
    """Disjoint ``(a, b)`` word ranges, ends excluded, that cover an array of ``(pos, pos + k)`` structs."""
    kind = "array<struct<a:int,b:int>>"

    def add(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"))
        alone = F.concat(acc, F.array(F.struct(s["a"].alias("a"), s["b"].alias("b"))))
        return F.when(last.isNull() | (s["a"] > last["b"]), alone).otherwise(
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).cast(kind)

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), add)


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: ``(id, th, n_words, n_hit, spans, items)``.

    ``spans`` are the hit word ranges, ``items`` the sorted distinct item ids as strings.
    """
    sizes, hits, windows = find_hits(
        docs, benchmark, size, id_col, text_col, item_col, item_text_col, broadcast_bytes)
    covered = hits.groupBy("id", "th").agg(merged_spans(F.collect_set(
        F.struct(F.col("pos").alias("a"), (F.col("pos") + F.col("k")).alias("b")))).alias("spans"))
    named = (hits.select("id", "th", "gram").distinct().join(windows.select("gram", "item").distinct(), "gram")
             .groupBy("id", "th").agg(F.sort_array(F.collect_set("item")).alias("items")))
    same = lambda other: F.col("id").eqNullSafe(F.col(f"{other}_id")) & (F.col("th") == F.col(f"{other}_th"))
    part = lambda df, c: df.select(F.col("id").alias(f"{c}_id"), F.col("th").alias(f"{c}_th"), c)
    out = sizes.join(part(covered, "spans"), same("spans"), "left").join(part(named, "items"), same("items"), "left")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda n, s: n + s["b"] - s["a"]), F.lit(0))
    return out.select("id", "th", "n_words", n_hit.alias("n_hit"), "spans",
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = 10, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit word spans cut out of their texts.

    Columns stay as they are. Cutting removes each hit word and what separates it from the word before.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    _, hits, _ = find_hits(docs, benchmark, size, id_col, text_col, item_col, item_text_col, broadcast_bytes)
    covered = hits.groupBy("id", "th").agg(merged_spans(F.collect_set(
        F.struct(F.col("pos").alias("a"), (F.col("pos") + F.col("k")).alias("b")))).alias("spans"))
    marks = covered.select(F.struct("id", "th", "spans").alias("_found"))
    text = F.coalesce(docs[text_col], F.lit(""))
    same = docs[id_col].eqNullSafe(F.col("_found.id")) & (F.xxhash64(text) == F.col("_found.th"))
    if remove == "documents":
        return docs.join(marks, same, "left_anti")
    joined = docs.join(marks, same, "left")
    pieces = F.regexp_extract_all(docs[text_col], F.lit(f"({BETWEEN}*{WITHIN}+)"), F.lit(1))
    kept = F.filter(pieces, lambda _, i: ~F.exists(F.col("_found.spans"), lambda s: (i >= s["a"]) & (i < s["b"])))
    tail = F.regexp_extract(docs[text_col], f"({BETWEEN}*)\\z", 1)
    cut = F.when(F.col("_found").isNotNull(), F.concat(F.array_join(kept, ""), tail)).otherwise(docs[text_col])
    return joined.select(*[cut.alias(c) if c == text_col else docs[c] for c in docs.columns])
