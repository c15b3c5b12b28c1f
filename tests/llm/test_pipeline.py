"""Each stage against a brute-force version on its own input, and the whole by steps."""

import re

import public_tokenizers as P
import pytest
import sentencepiece

import corpus_pipeline
from panelwright.llm import queries as Q
from tests.llm import awkward
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_forest import brute as classes
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.01"


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names if k.startswith("op")} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near duplicates", "benchmark decontamination", "private data", "sentencepiece"]


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_equals_sql(spark, name):
    assert compare(Q.QUERIES[name](spark, SMALL), connect(SMALL), Q.ORACLES[name]) == []


def test_native_operators_run_no_python(spark):
    for name in ("op1_benchmark_decontamination", "op3_pii_surrogates", "op10_fingerprints"):
        plan = Q.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan), name


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark, tmp_path):
    """Every stage's decisions, on what the stage before has kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SMALL).write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
        if i < 4:
            assert kept[-1].dtypes == docs.dtypes
    start, mild, unique, clean, private, encoded = kept
    left = {i for i, _ in rows(mild)}
    wrong = [i for i, _ in rows(start) if i in labels and (i in left) == bool(labels[i])]
    assert len(wrong) <= 0.05 * len(labels)
    before = rows(mild)
    want = {d for d, _, c in classes(before, 5, 80) if d == c}
    assert sorted(rows(unique)) == sorted(r for r in before if r[0] in want)
    before = rows(unique)
    hits = contaminated([t for _, t in before], items, 10)
    assert sorted(rows(clean)) == sorted(r for r, h in zip(before, hits) if not h[1])
    old, new = dict(rows(clean)), dict(rows(private))
    assert old.keys() == new.keys() and all(r["n_chars"] == len(r["text"]) for r in private.collect())
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {i: library.encode(t) for i, t in new.items()}


def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path):
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    docs = awkward.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert stage(spark, awkward.nothing(spark), str(tmp_path)).isEmpty()
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() == docs.count()
