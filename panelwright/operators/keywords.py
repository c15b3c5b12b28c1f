"""First-match classification by a large keyword table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text."""
    places = F.sequence(F.lit(1), F.length(text) - F.lit(size - 1))
    runs = F.transform(places, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def first_keyword_of_table(
    df: DataFrame, text: str, keywords: DataFrame, into: str, keyword: str = "keyword", name: str = "clean_name",
    priority: str = "priority", longest: bool = False,
) -> DataFrame:
    """Beside each row the name of the keyword with the least priority that its lower-cased text contains.

    The keyword table may have any size. A keyword can only be inside a text that has all of its three-character runs
    (a shorter keyword is a run itself), so each keyword is filed under the one that the fewest texts have, which
    keeps it away from common runs; texts meet keywords on that run and are then searched. Each different text is
    looked at once. With ``longest`` the longest keyword wins (T16), of equals the one with the least priority. A missing
    text or keyword matches nothing; an empty keyword is in every text; equal keywords count with the least priority.
    """
    texts = materialise(df.select(F.lower(F.col(text)).alias("_text")).filter("_text is not null").distinct())
    rank = F.struct(*([-F.length("_word")] if longest else []), F.col(priority), F.col(name))
    words = materialise(
        keywords.withColumn("_word", F.lower(F.col(keyword))).filter("_word is not null")
        .groupBy("_word").agg(F.min(rank).alias("_rank"), F.min_by(name, rank).alias("_name"))
        .withColumn("_size", F.least(F.length("_word"), F.lit(GRAM))))
    sizes = [r["_size"] for r in words.select("_size").distinct().collect()]  # at most four
    parts = [F.array(F.lit("")) if size == 0 else _grams(F.col("_text"), size) for size in sorted(sizes)]
    if not parts:
        return df.withColumn(into, F.lit(None).cast(keywords.schema[name].dataType))
    grams = texts.select("_text", F.explode(F.concat(*parts)).alias("_gram"))
    common = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    own = F.when(F.col("_size") == 0, F.array(F.lit("")))
    for size in range(1, GRAM + 1):
        own = own.when(F.col("_size") == size, _grams(F.col("_word"), size))
    spelt = words.select("*", F.explode(own).alias("_gram")).join(common, "_gram", "left")
    filed = materialise(
        spelt.groupBy("_word").agg(
            F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"),
            F.min(F.coalesce("_n", F.lit(0))).alias("_n"), F.first("_rank").alias("_rank"), F.first("_name").alias("_name"))
        .filter("_n > 0"))
    hits = grams.join(filed, "_gram").filter(F.col("_text").contains(F.col("_word")))
    best = hits.groupBy("_text").agg(F.min_by("_name", "_rank").alias(into))
    return df.withColumn("_text", F.lower(F.col(text))).join(materialise(best), "_text", "left").drop("_text")
