import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelwright.llm import alignment
from panelwright.llm.word_bpe import byte_characters
from tests.llm import awkward
from tests.llm.test_tokens import strings

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def tokens(libraries, text):
    """(id, bytes) of both sides by the libraries, and whether they hold the text's bytes."""
    a, b = libraries
    if not text:
        return [], []
    byte = {c: i for i, c in enumerate(byte_characters())}
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        right.append((i, bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])


def by_hand(libraries, text):
    """Links with shared bytes, groups, and links of shared groups, by looking at every pair of tokens."""
    left, right = tokens(libraries, text)
    span = lambda side: [(e - len(t), e) for (_, t), e in zip(side, np.cumsum([len(t) for _, t in side]).tolist())]
    sa, sb = span(left), span(right)
    overlap = [(i, j, min(e, f) - max(s, r)) for i, (s, e) in enumerate(sa) for j, (r, f) in enumerate(sb) if s < f and r < e]
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, start = [], 0
    for end in ends:
        groups.append(([i for i, (s, e) in enumerate(sa) if start <= s and e <= end],
                       [j for j, (s, e) in enumerate(sb) if start <= s and e <= end]))
        start = end
    shared = [(i, j, 1) for x, y in groups for i in x for j in y]
    return left, right, overlap, groups, shared


def expected(libraries, rows):
    """The query's result for ``(id, text)`` rows."""
    found = [(k, *by_hand(libraries, t)) for k, t in rows]
    count = Counter((a[i][0], b[j][0]) for _, a, b, overlap, _, _ in found for i, j, _ in overlap)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for k, a, b, overlap, groups, shared in found:
        pairs = [(a[i][0], b[j][0]) for i, j, _ in overlap]
        text = ";".join(",".join(str(a[i][0]) for i in x) + "|" + ",".join(str(b[j][0]) for j in y) for x, y in groups)
        out.append((k, len(a), len(b), len(groups), len(overlap), sum(count[p] == best[p[1]] for p in pairs),
                    sum(count[p] for p in pairs), text, len(shared)))
    return Counter(out)


def counted(docs):
    found = alignment.align(docs, *FILES)
    priced = alignment.with_counts(found)
    return Counter((r["id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"],
                    r["n_group_links"]) for r in priced.collect())


def table(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def some(seed):
    rng = random.Random(seed)
    return [awkward.prose(rng, 30) for _ in range(20)] + strings(250, seed) + [
        None, "", "<|endoftext|> <s> </s> <unk>", "a▁b", "漢字かな交じり文 😀😀👩‍👩‍👧", "x" * 700, " " * 90, "x ", " x", "  ", "\x00", "é" * 40]


def test_both_libraries_of_a_byte_level_vocabulary(libraries):
    """Every code point in context, and strings of merges that compete."""
    spec, held = alignment.ByteLevel.read(FILES[0])
    encoder = alignment.ByteLevel(spec, held)
    assert encoder.fast is not None
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}a{c}{c} {c}1" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    rng = random.Random(9)
    texts += ["".join(rng.choice(["a", "aa", "the", "in", "ing", " t", "he", "re", "er", "1", "00", "==", "--"]) for _ in range(60))
              for _ in range(3000)] + strings(3000, 8) + ["ab" * 2000, " " * 3000 + "x"]
    library = [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    for text, got, want in zip(texts, encoder.encode(texts), library):
        assert got == want, ascii(text)


def test_equals_looking_at_every_pair(spark, libraries, monkeypatch):
    texts = some(1)
    texts += texts[:5]
    docs = table(spark, texts).repartition(5)
    want = expected(libraries, [tuple(r) for r in docs.collect()])
    assert counted(docs) == want
    assert sum(k[1] for k in want) > 1000 and any(k[1] == 0 and k[0] == texts.index("a▁b") for k in want)


def test_bounds_change_nothing(libraries, monkeypatch):
    """Either library of the byte-level side, and products made in small runs, give the same matrices."""
    (spec, held_a), (model, held_b) = alignment.ByteLevel.read(FILES[0]), alignment.PieceModel.read(FILES[1])
    texts = [t or "" for t in some(2)]
    sides = lambda: (alignment.Side(alignment.ByteLevel(spec, held_a), held_a), alignment.Side(alignment.PieceModel(model), held_b))
    whole = alignment.Aligned(*sides(), texts)
    every = {kind: [np.concatenate(x) for x in zip(*whole.links(kind))] for kind in ("overlap", "group")}
    monkeypatch.setattr(alignment, "LONG", 3)
    monkeypatch.setattr(alignment, "ENTRIES", 5)
    again = alignment.Aligned(*sides(), texts)
    assert whole.ids_a.tolist() == again.ids_a.tolist() and whole.ids_b.tolist() == again.ids_b.tolist()
    for kind, want in every.items():
        got = [np.concatenate(x) for x in zip(*again.links(kind))]
        assert all((x == y).all() for x, y in zip(got, want)), kind
    left, right = whole.matrices("group")
    assert left.product_bounds(right).sum() == len(every["group"][0])


def test_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n, k, m = rng.integers(1, 9, 3)
        x, y = (rng.random((n, k)) < 0.4).astype(int), (rng.random((k, m)) < 0.4).astype(int)
        rows = lambda d: alignment.Rows(np.concatenate([[0], np.cumsum(d.sum(1))]), np.nonzero(d)[1], d.shape[1])
        got = np.zeros((n, m), dtype=int)
        for i, j, v in rows(x).times(rows(y)):
            got[i, j] += v
        assert (got == x @ y).all()
        flipped = rows(x).transposed()
        assert (flipped.starts == rows(x.T).starts).all() and (flipped.columns == rows(x.T).columns).all()


def test_links_row_by_row(spark, libraries):
    docs = table(spark, some(4)[:40] + ["a▁b", None])
    rows = [tuple(r) for r in docs.collect()]
    for kind, place in (("overlap", 2), ("group", 4)):
        want = Counter()
        for k, text in rows:
            found = by_hand(libraries, text)
            want.update((k, i, found[0][i][0], j, found[1][j][0], n) for i, j, n in found[place])
        assert Counter(tuple(r) for r in alignment.links(docs, *FILES, kind=kind).collect()) == want, kind


def test_awkward_rows(spark, libraries):
    docs = awkward.documents(spark)
    found = alignment.align(docs, *FILES)
    assert Counter(r["id"] for r in found.collect()) == Counter(r["doc_id"] for r in docs.collect())
    short = docs.where(F.length("text") < 5000)
    assert counted(short) == expected(libraries, [(r["doc_id"], r["text"]) for r in short.collect()])
    nothing = alignment.align(awkward.nothing(spark), *FILES)
    assert nothing.isEmpty() and alignment.with_counts(nothing).isEmpty()
    assert alignment.links(awkward.nothing(spark), *FILES).isEmpty()
    with pytest.raises(ValueError):
        alignment.align(docs, P.path("word_bpe_49k.json"), FILES[1])


def test_long_texts_equal_the_libraries(spark, libraries):
    """Numbers and groups of long texts, with groups by merging the ends of both sides."""
    docs = awkward.documents(spark)
    for r in alignment.align(docs.where(F.length("text") >= 5000), *FILES).collect():
        text = next(d["text"] for d in docs.collect() if d["doc_id"] == r["id"])
        a, b = tokens(libraries, text)
        ends_a, ends_b = (set(np.cumsum([len(t) for _, t in side]).tolist()) for side in (a, b))
        assert (r["n_a"], r["n_b"], r["n_groups"]) == (len(a), len(b), len(ends_a & ends_b))
        # every end of a token inside the other side's tokens makes one more link
        assert r["n_links"] == len(ends_a | ends_b)
        assert [i for g in r["groups"].split(";") for i in map(int, g.split("|")[0].split(","))] == [i for i, _ in a]


def test_hash_of_groups_in_the_query(spark, sf, libraries):
    from panelwright.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op12_token_alignment"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in [d for d in docs if len(d["text"] or "") < 1500][:20]:
        left, right, overlap, groups, _ = by_hand(libraries, d["text"])
        text = ";".join(",".join(str(left[i][0]) for i in x) + "|" + ",".join(str(right[j][0]) for j in y) for x, y in groups)
        r = got[d["doc_id"]]
        assert r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if text else "")
        assert r["n_links"] == len(overlap) and r["n_groups"] == len(groups)
