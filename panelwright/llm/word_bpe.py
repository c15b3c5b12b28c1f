"""Encoding and decoding with byte-pair vocabularies that mark word ends.

A text is cut at the added tokens, which stand for themselves. The rest is normalised (canonical composition, white space
to one space, lower case character by character) and searched for words; what is no word falls away. A word's bytes are
symbols in a doubly linked list, the last one with the end mark. A heap holds the adjacent pairs by rank and
place; the least pair is popped, left aside if one of its sides has changed since (a stale entry), and merged
otherwise, until no entry is left. The symbols that remain are the tokens. Decoding joins vocabulary strings, by a
space where the file names no decoder, as the library does.

Python's and the library's Unicode tables are of different years. Texts are cut here if all their characters are from
``SETTLED`` blocks, on which both agree (a test asks for every code point); the library's own normaliser and splitter cut
the others.

Words repeat, so a worker process remembers the identifiers of words, and of what stands between white space, packed
four bytes each: a text's identifiers are one join of such strings. A memory holds ``MEMORY`` entries at most and
none of more than ``LONG`` characters, which bounds it without changing a result: that of words is emptied when full, that of
parts has two halves, of which the older goes when the newer is full; what is met again moves to the newer. Decoding gathers all strings of a batch at once.

Defined cases: null and empty texts, and texts without a word, have no tokens and decode to the empty text; null
identifiers decode to null, and so does a row with an identifier that the vocabulary lacks; a text of any length
is one piece of work, in time n log n of its longest word; repeated rows and ids are encoded row by row; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_texts

MEMORY, LONG = 250_000, 64
CONTROLS = re.compile("[\x1c-\x1f]").search
#: Steps of the files that can be read here; anything else is refused.
NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]

#: Latin, Greek and Cyrillic, punctuation, currency and letter-like signs, kana, Han and Hangul, wide forms, pictographs.
SETTLED = re.compile("[\x00-\u052f\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u3000-\u303f\u3041-\u3096\u3099-\u30ff\u4e00-\u9fef"
                     "\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001f9ff]*").fullmatch


def byte_characters() -> list[str]:
    """The character that stands for each byte in a vocabulary file: itself if printable Latin-1, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """``merges`` maps ``left << 32 | right`` to the pair's rank, all symbols being identifiers of the vocabulary."""

    merges: dict[int, int]
    made: list[int]  # by rank
    inner: list[int]  # identifier of each byte inside a word
    final: list[int]  # and of each byte at a word's end
    words: str  # pattern of the words
    added: dict[str, int]
    strings: list[str | None]  # by identifier
    joint: str  # what decoding puts between two strings
    spec: str  # the file

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """Read a tokenizer file; ValueError if it works in another way."""
        with open(path, encoding="utf-8") as file:
            whole = file.read()
        spec = json.loads(whole)
        model, end = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        before = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        split = before[0] if len(before) == 2 else {}
        added = spec.get("added_tokens") or []
        fits = (
            model.get("type") == "BPE" and not (model.get("dropout") or model.get("continuing_subword_prefix")
                                                or model.get("ignore_merges") or spec.get("decoder"))
            and (spec.get("normalizer") or {}).get("normalizers") == NORMALISERS
            and split.get("type") == "Split" and "Regex" in split.get("pattern", {}) and split.get("invert") is True
            and split.get("behavior") == "Removed" and before[1].get("type") == "ByteLevel"
            and not before[1].get("use_regex") and not before[1].get("add_prefix_space")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in added))
        number, chars = model["vocab"], byte_characters()
        if not fits or any(c not in number or c + end not in number for c in chars):
            raise ValueError("only byte-level BPE with word ends, lower-casing and no decoder is supported")
        merges: dict[int, int] = {}
        results = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            merges[number[left] << 32 | number[right]] = rank
            results.append(number[left + right])
        special = {t["content"]: t["id"] for t in added if t["content"]}
        names = {i: s for s, i in (number | special).items()}
        return cls(merges, results, [number[c] for c in chars], [number[c + end] for c in chars], split["pattern"]["Regex"], special,
                   [names.get(i) for i in range(max(names) + 1)], " ", whole)

    def merged(self, word: bytes) -> list[int]:
        """Identifiers of one word: the adjacent pair of least rank, the leftmost of equals, merged until none is left."""
        at = list(map(self.inner.__getitem__, word))
        at[-1] = self.final[word[-1]]
        n, find, made = len(at), self.merges.get, self.made
        if n == 1:
            return at
        # the rank of each symbol's pair with the next one, -1 if it has none
        ranks = [find(a << 32 | b, -1) for a, b in zip(at, at[1:])]
        ranks.append(-1)
        behind, ahead = list(range(-1, n - 1)), list(range(1, n + 1))
        # an entry: rank * n + place of the left symbol
        queue = [r * n + i for i, r in enumerate(ranks) if r >= 0]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, r = entry % n, entry // n
            if ranks[i] != r:
                continue  # stale: a side was merged with another neighbour since
            j = ahead[i]
            at[i] = new = made[r]
            at[j] = ranks[j] = ranks[i] = -1
            k = ahead[i] = ahead[j]
            if k < n:
                behind[k] = i
                ranks[i] = r = find(new << 32 | at[k], -1)
                if r >= 0:
                    heappush(queue, r * n + i)
            p = behind[i]
            if p >= 0:
                ranks[p] = r = find(at[p] << 32 | new, -1)
                if r >= 0:
                    heappush(queue, r * n + p)
        return [s for s in at if s >= 0]


def lower(text: str) -> str:
    """Lower case character by character, so without the rule for a sigma at the end of a word."""
    return text.lower() if "Σ" not in text else "σ".join(part.lower() for part in text.split("Σ"))


def normal(text: str) -> str:
    """Of a text without white space: no word holds any, so which one parts two words does not matter."""
    return lower(text if text.isascii() else unicodedata.normalize("NFC", text))


class Library:
    """The library's normaliser and splitter."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(spec)
        self.normal, self.split = made.normalizer.normalize_str, made.pre_tokenizer.pre_tokenize_str
        self.byte = {c: b for b, c in enumerate(byte_characters())}

    def words(self, text: str) -> list[str]:
        return [bytes(map(self.byte.__getitem__, w)).decode() for w, _ in self.split(self.normal(text))]


class Encoder:
    """From texts to packed identifiers; remembers the words it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.library: Library | None = None
        self.words = regex.compile(vocabulary.words).findall
        marks = sorted(vocabulary.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.spaces = regex.compile(r"\s+").split
        self.known: dict[str, bytes] = {}  # by parts between white space, as they stand in texts
        self.before: dict[str, bytes] = {}  # what was known before it was last emptied
        self.known_words: dict[str, bytes] = {}

    def _words(self, part: str) -> list[str]:
        if part.isascii() or SETTLED(part):
            return self.words(normal(part))
        if self.library is None:
            self.library = Library(self.v.spec)
        return self.library.words(part)

    def _part(self, part: str) -> bytes:
        """Identifiers of a part of a text without white space."""
        words = self.words(part.lower()) if part.isascii() else self._words(part)
        found = []
        for w in words:
            # a word of ASCII is its own part; others may change when they are normalised again
            memory = self.known if w.isascii() else self.known_words
            ids = memory.get(w)
            if ids is None and memory is self.known:
                ids = self.before.get(w)
            if ids is None:
                ids = array("i", self.v.merged(w.encode())).tobytes()
                if len(w) <= LONG:
                    if memory is self.known_words and len(memory) >= MEMORY:
                        memory.clear()
                    memory[w] = ids
            found.append(ids)
        return found[0] if len(found) == 1 else b"".join(found)

    def _plain(self, text: str) -> bytes:
        # some controls part words in Python alone
        parts = self.spaces(text) if CONTROLS(text) else text.split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            pass
        fresh = {p for p in parts if p not in known}
        if len(known) + len(fresh) > MEMORY // 2:
            self.before, self.known = known, {}
            known, fresh = self.known, set(parts)
        before = self.before.get
        for p in fresh:
            ids = before(p)
            known[p] = self._part(p) if ids is None else ids
        found = b"".join(map(known.__getitem__, parts))
        for p in fresh:
            if len(p) > LONG:
                known.pop(p, None)
        return found

    def encode(self, text: str) -> bytes:
        """Identifiers of a text, four bytes each."""
        if self.marks is None or not any(t in text for t in self.v.added):
            return self._plain(text)
        found = []
        for i, part in enumerate(self.marks.split(text)):
            found.append(np.array([self.v.added[part]], dtype="<i4").tobytes() if i % 2 else self._plain(part))
        return b"".join(found)


def encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)`` of every row. The file is read by the driver alone."""
    # as large as the vocabulary; a worker process keeps its copy, and the memory in it, from task to task
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": Vocabulary.of(tokenizer_file)})

    def make() -> Callable[[list[str]], list]:
        at_hand = shared.value
        if "encoder" not in at_hand:
            at_hand["encoder"] = Encoder(at_hand["vocabulary"])
        encoder = at_hand["encoder"]

        def work(texts: list[str]) -> list:
            rows = list(map(encoder.encode, texts))
            ends = np.concatenate([[0], np.cumsum([len(r) >> 2 for r in rows])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))]

        return work

    return map_texts(docs, [id_col], text_col, "ids array<int>", make)


def decode_lists(ids: pa.ListArray, strings: pa.Array, joint: str) -> pa.Array:
    """Texts of lists of identifiers, gathered and joined a batch at a time."""
    flat = ids.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(strings)))
    found = strings.take(pc.if_else(known, flat, None))
    # offsets from zero, as a slice or a null with content may start elsewhere
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
    lists = pa.LargeListArray.from_arrays(pa.array(ends.astype(np.int64)), found.cast(pa.large_string()))
    texts = pc.binary_join(lists, pa.scalar(joint, pa.large_string()))  # null where any string is
    return pc.if_else(pc.is_valid(ids), texts, None).cast(pa.string())


def decode(
    encoded: DataFrame, tokenizer_file: str, id_col: str = "doc_id", ids_col: str = "ids", keep: bool = False,
) -> DataFrame:
    """``(id_col, text)`` of every row, with ``keep`` ``(id_col, ids_col, text)``."""
    vocabulary = Vocabulary.of(tokenizer_file)
    shared = encoded.sparkSession.sparkContext.broadcast((vocabulary.strings, vocabulary.joint))
    kept = [id_col, ids_col] if keep else [id_col]
    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, joint = shared.value
        strings = pa.array(names, pa.string())
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            for start, stop in pieces_of(ids):
                part = batch.slice(start, stop - start)
                texts = decode_lists(part.column(part.num_columns - 1), strings, joint)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], texts], schema=None, names=schema.names)

    hidden = f"_ids_{uuid.uuid4().hex}"
    last = F.col(f"`{ids_col}`").cast("array<int>").alias(hidden)
    return encoded.select(*[F.col(f"`{c}`") for c in kept], last).mapInArrow(run, schema)


#: Identifiers decoded at once, or one longer list.
AT_ONCE = 1_000_000


def pieces_of(ids: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows with at most ``AT_ONCE`` identifiers, or one longer row."""
    begin = total = 0
    for i, n in enumerate(pc.fill_null(pc.list_value_length(ids), 0).to_pylist()):
        if total and total + n > AT_ONCE:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(ids):
        yield begin, len(ids)
