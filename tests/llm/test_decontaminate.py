import random
import re

import pytest

from panelwright.llm import decontaminate as D
from tests.llm import awkward

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(texts, items, size):
    grams = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        k = min(size, len(w))
        for p in range(len(w) - k + 1) if k else ():
            grams.setdefault(tuple(w[p:p + k]), set()).add("null" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for k in {len(g) for g in grams}:
            for p in range(len(w) - k + 1):
                if (g := tuple(w[p:p + k])) in grams:
                    hit |= set(range(p, p + k))
                    found |= grams[g]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    items = [(i, awkward.prose(rng, rng.choice([2, 5, 6, 9, 30]))) for i in range(8)]
    items += [(8, items[0][1]), (None, "Ünïcödé ÄÖ"), (9, None), (10, ""), (11, "...")]
    texts = awkward.texts()
    for _, t in items[:8]:
        w = t.split()
        texts.append(f"{awkward.prose(rng, 5)} {t.upper()}! {awkward.prose(rng, 5)}")
        texts.append(" ".join(w[1:6]) + ", " + awkward.prose(rng, 3))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, w string")
    return docs, texts, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 0])
def test_equals_brute_force(case, limit):
    docs, texts, bench, items = case
    got = {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in
           D.contamination(docs, bench, size=6, broadcast_bytes=limit).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, items, 6)


def test_documents_and_spans(case):
    docs, texts, bench, items = case
    want = brute(texts, items, 6)
    kept = D.decontaminate(docs, bench, "documents", size=6)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == [i for i, w in enumerate(want) if not w[1]]
    cut = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, bench, "spans", size=6).collect()}
    assert len(cut) == len(texts)
    for i, (n, hit, _) in enumerate(want):
        assert cut[i] == texts[i] if not hit else len(WORD.findall(lower(cut[i]))) == n - hit
    assert cut[len(awkward.texts())].endswith("! " + texts[len(awkward.texts())].split("! ")[1])


def test_odd_rows_and_empty_tables(spark, case):
    docs = awkward.documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(docs, none).where("n_hit > 0").isEmpty()
    assert D.contamination(docs, none).count() == docs.count()
    assert D.contamination(awkward.nothing(spark), case[2]).isEmpty()
    kept = D.decontaminate(docs, case[2], "spans", size=6)
    assert kept.count() == docs.count() and kept.columns == docs.columns
    with pytest.raises(ValueError):
        D.decontaminate(docs, none, "letters")
