import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import langid, toxicity
from panelwright.llm import queries as Q
from tests.llm import awkward

SMALL = "/root/testdata/sf0.01"


def test_folding():
    fold = toxicity.folder()
    assert fold("1D10T ІDІОТ ｉｄｉｏｔ 𝐢𝐝𝐢𝐨𝐭 $tup1d é") == ["idiot", "idiot", "idiot", "idiot", "stupid", "é"]


def test_matching_with_exceptions():
    lexicon = toxicity.Lexicon({"bad": 2.0, "foul ": 1.0}, ["bad luck", "badminton"])
    find = lexicon.matcher()
    words = "badly badminton bad luck fouls foul bad".split()
    assert [e for _, e in find(words)] == ["bad", "foul ", "bad"]
    assert toxicity.Lexicon().matcher()(words) == []


@pytest.fixture(scope="module")
def labelled(spark):
    """Toxic texts hold a planted word or a word that starts with a planted stem; harmless ones a lookalike phrase."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        words = awkward.prose(rng, rng.randint(5, 60)).split()
        toxic = i % 4 == 0
        if toxic:
            word = rng.choice(["zarrk", "vexq" + awkward.prose(rng, 1)])
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 5))
    labels += [(1, None, 1), (None, 1, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"), labels)


def test_toxicity_is_learned_and_held_out(spark, labelled):
    docs, labels, truth = labelled
    lexicon = toxicity.learn(docs, labels)
    assert {"zarrk ", "vexq"} <= set(lexicon.weights)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, lexicon, ["doc_id"]).collect()}
    assert all((got[i] >= 0.7) == bool(t) for i, t, q in truth if i is not None and q == 5)
    kept = toxicity.reject(docs, lexicon)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i] < 0.7}


def test_toxicity_of_odd_rows(spark, labelled):
    docs = awkward.documents(spark)
    lexicon = toxicity.learn(docs, labelled[1].where("toxic = 0"))
    scores = toxicity.score(docs, lexicon, ["doc_id"]).collect()
    assert not lexicon.weights and len(scores) == docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert toxicity.reject(docs, lexicon).columns == docs.columns and toxicity.reject(docs, lexicon).count() == docs.count()
    assert toxicity.learn(awkward.nothing(spark), labelled[1].limit(0)).score[0] == 0.0
    assert toxicity.score(awkward.nothing(spark), lexicon, ["doc_id"]).isEmpty()


def test_toxicity_query_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = Q.op2(spark, SMALL).join(labels, "doc_id").where("held_out").collect()
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)


def test_tables_give_what_the_convolution_gives():
    """The folded tables against embedding, filters, maximum and softmax worked out plainly."""
    rng = np.random.default_rng(1)
    n = len(langid.WIDTHS) * langid.FILTERS
    net = langid.Network(["a", "b"], rng.normal(size=(256, langid.DIMS)).astype(np.float32),
                         [rng.normal(size=(w * langid.DIMS, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS],
                         rng.normal(size=n).astype(np.float32), rng.normal(size=(n, 2)).astype(np.float32),
                         np.zeros(2, np.float32))
    windows = rng.integers(0, 256, (5, langid.LENGTH), dtype=np.uint8)
    top = []
    for width, w in zip(langid.WIDTHS, net.filters):
        e = net.embed[windows]
        cols = np.concatenate([e[:, j:langid.LENGTH - width + 1 + j] for j in range(width)], axis=2)
        top.append((cols @ w).max(axis=1))
    z = np.maximum(np.concatenate(top, axis=1) + net.bias, 0) @ net.dense
    want = z - np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) - z.max(axis=1, keepdims=True)
    assert np.allclose(net.predictor()(windows), want, atol=1e-3)


def test_windows_cover_whole_texts():
    texts = [b"", b"x" * 5, b"y" * langid.LENGTH, b"z" * (2 * langid.LENGTH + 1)]
    windows, owner, filled = langid.cut(texts)
    assert owner.tolist() == [1, 2, 3, 3, 3] and filled.sum() == sum(map(len, texts))
    assert b"".join(w.tobytes() for w in windows).replace(b"\0", b"") == b"".join(texts)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = Q.op6(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "EPOCHS", 1)
    docs = awkward.documents(spark)
    net = langid.learn(docs)
    got = langid.predict(docs, net).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is not None:
            letters = any(map(str.isalpha, texts[r["doc_id"]] or ""))
            assert (r["lang_pred"] == "en") == letters and (r["score"] > 0) == letters
    assert langid.learn(awkward.nothing(spark)) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(awkward.nothing(spark), net).isEmpty()


def test_held_out_rule(spark):
    import zlib

    ids = list(range(200))
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", langid.held_out("doc_id").alias("h"))
    assert {r["doc_id"]: r["h"] for r in rows.collect()} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in ids}
    assert spark.range(1).select(toxicity.held_out("id").isNotNull().alias("x")).first()["x"] and F
