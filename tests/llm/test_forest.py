import random
from pathlib import Path

import numpy as np
import pytest

from panelwright.llm import forest as X
from panelwright.llm.components import components
from panelwright.session import run_folder
from tests.llm import awkward


def shingles(text, size):
    w = (text or "").encode().lower().split()
    k = min(size, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(rows, size, percent):
    """Least reachable id by comparing all with all."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def variants(seed=5):
    rng = random.Random(seed)
    rows = []
    for g in range(14):
        base = awkward.prose(rng, rng.randint(4, 150)).split()
        for _ in range(rng.choice([1, 2, 3, 30])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 15))):
                w[rng.randrange(len(w))] = awkward.prose(rng, 1)
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, size):
    rows = variants() + [(1000 + i, t) for i, t in enumerate(awkward.texts()) if not t or len(t) < 5000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["id"], r["n"], r["component"]) for r in X.classes(docs, size=size).collect())
    assert got == sorted(brute(rows, size, 80))


def template_rows(seed=4, n=400, planted=40):
    """Texts from one template, most pairs 0.7 to 0.79 alike in single words, and pairs of them that are just linked."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for j in rng.sample(range(150), 11):
            w[j] = f"x{i}_{j}"
        rows.append(" ".join(w))
    for i in rng.sample(range(n), planted):
        w = rows[i].split()
        for j in rng.sample(range(150), 16):
            w[j] = f"y{i}_{j}"
        rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_links_in_a_dense_region(spark, monkeypatch):
    rows = template_rows()
    want = sorted(brute(rows, 1, 80))
    assert 10 < sum(d != c for d, _, c in want) < 100
    monkeypatch.setattr(X, "REACH", 1)  # as if a region had many more nodes
    got = sorted((r["id"], r["n"], r["component"]) for r in X.classes(spark.createDataFrame(rows, "doc_id long, text string"), size=1).collect())
    assert got == want


@pytest.mark.parametrize("product", [0, 100, 1 << 40])
def test_common_elements_listed_and_multiplied(monkeypatch, product):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(X, "PRODUCT", product)
    monkeypatch.setattr(X, "AT_ONCE", 2000)
    for wide in (60, 4000):
        one, two = ([np.unique(rng.integers(0, wide, rng.integers(1, 50))) for _ in range(k)] for k in (8, 11))
        assert X.common(one, two).tolist() == [[len(np.intersect1d(a, b)) for b in two] for a in one]


def test_a_large_group_is_asked_in_blocks(spark, monkeypatch):
    """A member's and an asker's set met in a join on the group alone, in one task: a row for every linked pair."""
    rng = np.random.default_rng(5)
    core = rng.integers(0, 1 << 62, 120)
    share = [0.02] * 90 + list(np.linspace(0.02, 0.2, 40))
    sets = [np.unique(np.where(rng.random(120) < f, rng.integers(0, 1 << 62, 120), core)) for f in share]
    name = [i.to_bytes(2, "big") for i in range(130)]
    rooted = spark.createDataFrame([(n, b"r") for n in name[:90]], "node binary, root binary")
    asks = spark.createDataFrame([(n, b"r") for n in name[90:]], "node binary, root binary")
    table = spark.createDataFrame([(n, s.tolist()) for n, s in zip(name, sets)], "node binary, shingles array<bigint>")
    linked = lambda a, b: 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
    want = {n for n, s in zip(name[90:], sets[90:]) if any(linked(s, m) for m in sets[:90])}
    assert 5 < len(want) < 40
    monkeypatch.setattr(X, "BLOCK", 120 * 30)
    found = [(bytes(r["a"]), bytes(r["b"])) for r in X.open_links(asks, rooted, table, 80).collect()]
    assert {a for a, _ in found} == want and len(found) <= 4 * len(want)
    assert all(linked(sets[name.index(a)], sets[name.index(b)]) and name.index(b) < 90 for a, b in found)


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = awkward.documents(spark)
    kept = X.deduplicate(docs, size=5)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    sets = [frozenset(shingles(t, 5)) for _, t in rows]
    full = [s for s in sets if s]
    assert len(full) == len(set(full)) and len(rows) == len(set(rows))
    want = {frozenset(shingles(r["text"], 5)) for r in docs.collect()}
    for s in want - set(full):
        assert not s or any(5 * len(s & t) >= 4 * len(s | t) for t in full)
    assert X.deduplicate(awkward.nothing(spark)).isEmpty()


def test_deduplicate_keeps_different_texts_of_one_id(spark):
    rng = random.Random(8)
    one, two, three, four = (awkward.prose(rng, 40) for _ in range(4))
    rows = [(None, one), (None, two), (None, two + " end"), (None, None), (None, ""), (None, None), (7, three), (7, four), (7, four),
            (8, three), (9, " "), (9, "\n"), (9, "\n")]
    kept = X.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = [(None, one), (None, None), (None, ""), (7, three), (7, four), (9, " "), (9, "\n")]
    last = [x for x in got if x not in want]  # of two near copies without id either may stay
    assert len(got) == len(set(got)) == 8 and set(want) < set(got) and last[0] in [(None, two), (None, two + " end")]
    # both rows without an id that have no near duplicate
    assert {(None, "no id here"), (None, None)} <= {
        (r["doc_id"], r["text"]) for r in X.deduplicate(awkward.documents(spark)).collect()}


def test_signatures_and_sets_are_not_kept(spark):
    folder = Path(run_folder(spark))
    before = set(folder.glob("*/table"))
    rows = [(i, f"{x} common words of all texts that differ {i % 7}") for i, x in enumerate("abcdefgh" * 5)]
    docs = spark.createDataFrame(rows + [(40, None), (41, "")], "doc_id long, text string")
    got = {r["id"]: r["component"] for r in X.classes(docs, 2).collect()}
    assert got == {r[0]: r[2] for r in brute([*rows, (40, None), (41, "")], 2, 80)}
    names = [set(spark.read.parquet(str(p)).columns) for p in set(folder.glob("*/table")) - before]
    assert names and not any({"signature", "key", "shingles"} & n for n in names)


def test_words_are_hashed_alike_in_blocks(monkeypatch):
    text = awkward.prose(random.Random(1), 3000) + " " + "y" * 5000
    whole = X.sets_of([text, "", "a b"], 2)
    monkeypatch.setattr(X, "AT_ONCE", 700)
    assert all(np.array_equal(a, b) for a, b in zip(whole, X.sets_of([text, "", "a b"], 2)))
    assert len(whole[0]) == len(shingles(text, 2))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
