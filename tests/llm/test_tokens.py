import os
import random
import subprocess
import sys
import unicodedata

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelwright.llm import arrow, bpe_counts, pieces, word_bpe
from tests.llm import awkward

LETTERS = [*" \n\t\x1c\x85 aabcdeT'sré漢字😀１²٣0123.,!?_-\x00\x7f́ǅ▁", "<|endoftext|>", "<|endof", "'ll", "the ",
           " ing", "aaaa", "      ", "<s>", "<0x0A>"]


def strings(n, seed):
    rng = random.Random(seed)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return out + ["a" * 300, " " * 70, "  x", "ab" * 500, "\n\n\n", "x ", " x", "▁", "", "<|endoftext|>" * 3]


def test_counts_equal_the_library():
    path = P.path("byte_bpe_50k.json")
    count = bpe_counts.text_counter(*bpe_counts.read_vocabulary(path), {})
    library = Tokenizer.from_file(path)
    for text in strings(4000, 1):
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_counting_forgets_without_changing(monkeypatch):
    path = P.path("byte_bpe_50k.json")
    vocabulary = bpe_counts.read_vocabulary(path)
    texts = strings(300, 2)
    whole = list(map(bpe_counts.text_counter(*vocabulary, {}), texts))
    monkeypatch.setattr(bpe_counts, "MEMORY", 5)
    assert list(map(bpe_counts.text_counter(*vocabulary, {}), texts)) == whole


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe_counts.read_vocabulary(P.path("word_bpe_49k.json"))


def test_counts_of_a_table(spark):
    docs = awkward.documents(spark)
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids))
                  for r in docs.collect())
    got = bpe_counts.count_tokens(docs, path).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert bpe_counts.count_tokens(awkward.nothing(spark), path).isEmpty()


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.of(P.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(model, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rng = random.Random(4)
    texts = strings(4000, 3) + ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 60))) for _ in range(1000)]
    want = library.encode(texts)
    assert pieces.Encoder(model).encode(texts) == want
    decoder = pieces.Decoder(model)
    assert [decoder.decode(w) for w in want] == library.decode(want) == [t.replace("▁", " ") for t in texts]
    monkeypatch.setattr(pieces, "MEMORY", 20)
    monkeypatch.setattr(pieces, "BLOCK", 300)
    forgetful = pieces.Encoder(model)
    assert [x for i in range(0, len(texts), 50) for x in forgetful.encode(texts[i:i + 50])] == want


def test_every_neighbour_rule_by_merging(model):
    """Whether two pieces stay two, against merging their characters."""
    rng = random.Random(5)
    encoder, n = pieces.Encoder(model), len(model.symbols)
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(3000)]
    import numpy as np

    got = encoder.may_follow(*(np.array(x) for x in zip(*pairs)))
    for (a, b), ok in zip(pairs, got.tolist()):
        a, b = model.symbols[a], model.symbols[b]
        assert ok == (pieces.merge_all(list(a + b), model.score) == [a, b]), (a, b)


GROWN = """
import random, sys
import public_tokenizers as P
from panelwright.llm import arrow, pieces

def kb(what):
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith(what))

arrow.give_back()
encoder, rng = pieces.Encoder(pieces.Pieces.of(P.path("piece_bpe_32k.model"))), random.Random(5)
word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 8))) + rng.choice(["", "", ",", "."])
start = kb("VmRSS")
for _ in range(4):
    encoder.packed([" ".join(word() for _ in range(500)) for _ in range(pieces.AT_ONCE // 3300)])
print((kb("VmHWM") - start) >> 10)
"""


def test_pieces_stay_small_over_many_new_words():
    """MB that a worker process grows by: its memory of words, and what a run of texts needs meanwhile."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", GROWN], cwd=root, capture_output=True, text=True, timeout=300, check=True)
    assert int(done.stdout) < 200


def test_runs_have_all_texts():
    for sizes in ([], [0], [0, 0], [5, 0, 3, 9, 30, 0, 1], [30], [0, 30, 0]):
        runs = list(arrow.runs_of(iter(sizes), 10))
        assert [i for r in runs for i in range(r.start, r.stop)] == list(range(len(sizes)))
        assert all(sum(sizes[r]) <= 10 or sum(map(bool, sizes[r])) == 1 for r in runs)


def test_pieces_of_a_table(spark):
    docs = awkward.documents(spark)
    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = pieces.encode(docs, path)
    rows = encoded.collect()
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in rows)
    assert sorted(map(str, (r["ids"] for r in rows))) == sorted(str(library.encode(r["text"] or "")) for r in docs.collect())
    back = pieces.decode(encoded, path)
    assert sorted(r["text"] for r in back.collect()) == sorted((r["text"] or "") for r in docs.collect())
    odd = spark.createDataFrame([(1, None), (2, [-1]), (3, [10 ** 6]), (4, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in pieces.decode(odd, path).orderBy("doc_id").collect()] == [None, None, None, ""]
    assert pieces.encode(awkward.nothing(spark), path).isEmpty()


# --- word ends -----------------------------------------------------------------------------------------------------

WORD_ODD = ["Σ ΑΣ ΣΑΣ", "İstanbul I'LL don'T", "e\u0301 \u1e9b\u0323 Å Å ＡＢ ﬁ", "ß ẞ ŉ ǰ", "１²٣ 123", "\x1c\x85\xa0\u2028x",
            "<|startoftext|>a<|endoftext|>", "<|StartOfText|>", "<|endoftext|>e\u0301", "e<|endoftext|>\u0301", "'s's'S ''ve",
            "ⅷ Ⅷ ①", "한국 각", "ก็ नमस्ते", "aⒶ", "-'s_-", "\x00\x7f"]


@pytest.fixture(scope="module")
def word_vocabulary():
    return word_bpe.Vocabulary.of(P.path("word_bpe_49k.json"))


def unpacked(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype="<i4").tolist()


def test_word_ids_equal_the_library(word_vocabulary, monkeypatch):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = strings(4000, 6) + WORD_ODD + ["".join(p) for p in zip(WORD_ODD, WORD_ODD[1:])]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = word_bpe.Encoder(word_vocabulary)
    for text, ids in zip(texts, want):
        assert unpacked(encoder, text) == ids, repr(text)
    monkeypatch.setattr(word_bpe, "MEMORY", 5)
    forgetful = word_bpe.Encoder(word_vocabulary)
    assert [unpacked(forgetful, t) for t in texts] == want


def test_parts_in_use_are_not_encoded_again(word_vocabulary, monkeypatch):
    monkeypatch.setattr(word_bpe, "MEMORY", 40)
    encoder, seen = word_bpe.Encoder(word_vocabulary), []
    true = encoder._part
    monkeypatch.setattr(encoder, "_part", lambda p: seen.append(p) or true(p))
    for i in range(60):  # more parts than are remembered; one of them in every text
        encoder.encode("often " + " ".join(f"n{i}x{j}" for j in range(3)))
    assert seen.count("often") == 1 and len(encoder.known) + len(encoder.before) <= 40 + 20


def test_every_code_point_equals_the_library(word_vocabulary):
    """Every character that is cut here, between letters, behind letters that take marks, and decomposed; of those that
    the library cuts, some."""
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    encoder = word_bpe.Encoder(word_vocabulary)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    points = [c for c in points if word_bpe.SETTLED(c) or ord(c) % 97 == 0]
    parted = [d for c in points if (d := unicodedata.normalize("NFD", c)) != c]
    for form, some in (("a{0}{0}a x{0}y", points), ("e{0}\u0323\u0301 \u1100{0}", points), ("x{0} {0}\u0301", parted)):
        texts = ["".join(form.format(c) + "|" for c in some[i:i + 64]) for i in range(0, len(some), 64)]
        for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert unpacked(encoder, text) == found.ids, ascii(text)


def test_words_of_a_table(spark):
    docs = awkward.documents(spark)
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    encoded = word_bpe.encode(docs, path)
    want = sorted(str((r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted(str((r["doc_id"], r["ids"])) for r in encoded.collect()) == want
    back = word_bpe.decode(encoded, path, keep=True)
    assert back.columns == ["doc_id", "ids", "text"]
    assert all(r["text"] == library.decode(r["ids"], skip_special_tokens=False) for r in back.collect())
    odd = spark.createDataFrame([(1, None), (2, [-1]), (3, [10 ** 6]), (4, []), (5, [None]), (6, [49407, 0])],
                                "doc_id long, ids array<int>")
    assert [r["text"] for r in word_bpe.decode(odd, path).orderBy("doc_id").collect()] == [
        None, None, None, "", None, library.decode([49407, 0], skip_special_tokens=False)]
    assert word_bpe.encode(awkward.nothing(spark), path).isEmpty()
    with pytest.raises(ValueError):
        word_bpe.Vocabulary.of(P.path("byte_bpe_50k.json"))
