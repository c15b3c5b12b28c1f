"""The training-data pipeline over ``documents``: stages applied one after another, each result stored as Parquet.

Every stage takes all its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import decontaminate, forest, pieces, surrogates, toxicity
from panelwright.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a lexicon, learned from ``labels``, scores below 0.7."""
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, lexicon, limit=0.7)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the least id."""
    return forest.deduplicate(docs, size=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents")


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; ``n_chars`` follows the text."""
    changed = surrogates.pseudonymise(docs, key="corpus")
    n_chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return changed.withColumn("n_chars", n_chars).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece identifiers of all documents."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("private data", private_data_stage),
    ("sentencepiece", pieces_stage),
]

#: SQL cannot express learned scores, hashed signatures or merges; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
