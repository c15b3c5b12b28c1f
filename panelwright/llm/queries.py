"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, bottomk, bpe_counts, decontaminate, forest, infill, langid, licenses, pieces, quotes, surrogates, toxicity, word_bpe,
)
from .registry import ORACLES, QUERIES, query, table  # noqa: F401

SQL_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op1_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
i AS (SELECT DISTINCT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, {SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram
      FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS p FROM i)),
ks AS (SELECT DISTINCT k FROM g),
x AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram
      FROM (SELECT d.doc_id, d.w, ks.k, unnest(generate_series(1, len(d.w) - ks.k + 1)) AS p FROM d, ks)),
hits AS (SELECT DISTINCT x.doc_id, x.k, x.p, g.item_id FROM x JOIN g ON x.gram = g.gram AND x.k = g.k),
pos AS (SELECT doc_id, count(*) AS n_hit FROM
        (SELECT DISTINCT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
        (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit,
       coalesce(its.n_items, 0) AS n_items, sha256(coalesce(its.items, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon, ["doc_id"])
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_matches", "matches")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bottomk.edited_pairs(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", bottomk.as_text(F.col("sketch")).alias("fingerprint"),
        bottomk.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        bottomk.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        bottomk.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


@query("op5_minhash_forest")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.classes(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


@query("op3_pii_surrogates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, key="op3")


@query("op4_quotation_linking")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_fill_in_middle", """
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
             sha256('1:' || doc_id) AS h FROM documents),
n AS (SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(list_slice(w, 1, a), '') AS p, array_to_string(list_slice(w, a + 1, b), '') AS m,
        array_to_string(list_slice(w, b + 1, n), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents"), seed=1, plain_percent=10, spm_percent=20)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
    groups = F.when(F.col("groups") != "", F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    # the texts of groups are hashed before anything is stored
    counted = alignment.with_counts(found.withColumn("groups_sha256", groups).drop("groups"))
    return counted.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          "groups_sha256", "n_group_links")


@query("op13_word_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    both = word_bpe.decode(word_bpe.encode(table(spark, sf_dir, "documents"), path), path, keep=True)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                       digest(F.col("text")).alias("decoded_sha256"))
