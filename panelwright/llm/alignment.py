"""Alignment of the tokens of two tokenizers through sparse matrices.

A text is encoded twice, by a byte-level vocabulary (A) and by a piece model (B), over the same bytes: a space and the text.
Over all bytes of a batch of texts stand two incidence matrices in compressed rows (``Rows``), tokens by bytes.

- Overlap links: the row product A.B^T. Gustavson's way: row i of the product is the sum of those rows of B^T that row i
  of A names, so a link (i, j) comes out with the number of bytes that both tokens hold.
- Groups end where a token of A and a token of B both end. With incidence matrices of tokens by groups the same product
  gives the links of tokens that share a group. Their number needs only the sizes of rows; the links themselves are
  made a bounded number of entries at a time.

Corpus-wide counts of linked id pairs: every text brings its distinct pairs with their number, these are summed by pair,
and the counts go back to blocks of texts rather than to texts: a block, of bounded size, asks once for each pair it
holds, so a pair that every text has is asked for once a block, and the join moves no text.

The tokens come from the vocabularies' public libraries.

Defined cases: texts that are null or empty, and texts whose joined token bytes differ from space and text (U+2581 comes
back as a space), have no tokens: all numbers are 0 and the text of the groups is ''. Repeated rows and ids are
counted row by row; empty tables give no rows; other columns are ignored, whatever their names. Texts of any length are
worked on whole by one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .arrow import runs_of
from .bpe_counts import PATTERN
from .word_bpe import byte_characters

SPACE = "▁"
#: A word of this many characters is long; so is a run of white space.
LONG = 1000
BLANKS = re.compile(r"\s{%d}" % LONG).search
#: Texts aligned at once, in characters; entries of a product made at once; characters of a block of texts.
AT_ONCE, ENTRIES, BLOCK = 500_000, 1_000_000, 4_000_000


@dataclass
class Rows:
    """A sparse matrix in compressed rows: row i has the columns ``columns[starts[i]:starts[i + 1]]``, each once."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    @classmethod
    def runs(cls, lengths: np.ndarray) -> Rows:
        """Tokens by bytes: every token holds the next ``lengths[i]`` bytes."""
        starts = _starts(lengths)
        return cls(starts, np.arange(starts[-1]), int(starts[-1]))

    @classmethod
    def single(cls, column: np.ndarray, width: int) -> Rows:
        """Tokens by groups: every token is in one group."""
        return cls(np.arange(len(column) + 1), column, width)

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        owner = np.repeat(np.arange(len(self.starts) - 1), self.sizes)
        return Rows(_starts(np.bincount(self.columns, minlength=self.width)), owner[order], len(self.starts) - 1)

    def product_bounds(self, other: Rows) -> np.ndarray:
        """Entries that each row of the product gathers, before equal columns are summed."""
        gathered = np.concatenate([[0], np.cumsum(other.sizes[self.columns])])
        return gathered[self.starts[1:]] - gathered[self.starts[:-1]]

    def times(self, other: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, column and value of the entries of the product with ``other``, row by row, in runs of whole rows with at
        most ``ENTRIES`` gathered entries, or one row with more."""
        bounds = np.concatenate([[0], np.cumsum(self.product_bounds(other))])
        begin, n = 0, len(self.starts) - 1
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + ENTRIES, side="right")) - 1)
            named = self.columns[self.starts[begin]:self.starts[end]]
            row = np.repeat(np.arange(begin, end), self.sizes[begin:end])
            size = other.sizes[named]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            key = np.repeat(row, size) * other.width + other.columns[np.repeat(other.starts[named], size) + place]
            if (key[1:] < key[:-1]).any():
                key.sort(kind="stable")
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
            value = np.diff(np.append(first, len(key)))
            row, column = np.divmod(key[first], max(other.width, 1))
            yield row, column, value
            begin = end


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class ByteLevel:
    """Identifiers of texts with a space before them by a byte-level vocabulary; added tokens in a text are plain text.

    Two libraries read the vocabulary. The fast one merges any two neighbours whose bytes are a token, which is the
    same as the file's merges if each of these makes a new token, in the order of identifiers; it is slow on one very
    long word, so texts with such a word, and files of another order, are left to the other.
    """

    def __init__(self, spec: str, held: list[bytes]):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        model = json.loads(spec)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(left + right, -1) for left, right in pairs]
        ordered = made == list(range(256, 256 + len(made))) and len(held) == 256 + len(made)
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks={h: i for i, h in enumerate(held)}, special_tokens={}) if ordered else None

    @staticmethod
    def read(path: str) -> tuple[str, list[bytes]]:
        """The file and the bytes of each identifier; ValueError if it is of another kind."""
        with open(path, encoding="utf-8") as file:
            text = file.read()
        spec = json.loads(text)
        before = spec.get("pre_tokenizer") or {}
        if (spec["model"].get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
                or spec.get("normalizer") or spec["model"].get("end_of_word_suffix")):
            raise ValueError("only byte-level BPE without normalizer, prefix space and word ends is supported")
        byte = {c: b for b, c in enumerate(byte_characters())}
        number = spec["model"]["vocab"]
        held = [b""] * (max(number.values()) + 1)
        for token, i in number.items():
            held[i] = bytes(map(byte.__getitem__, token))
        return text, held

    def encode(self, texts: list[str]) -> list[list[int]]:
        return list(map(self._encode, texts))

    def _encode(self, text: str) -> list[int]:
        if self.fast is None or BLANKS(text) or max(map(len, text.split()), default=0) >= LONG:
            return self.library.encode(" " + text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(" " + text)


class PieceModel:
    """Identifiers of texts by a piece model, which puts a space before each."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)

    @staticmethod
    def read(path: str) -> tuple[bytes, list[bytes]]:
        """The file and the bytes of each identifier."""
        import sentencepiece

        with open(path, "rb") as file:
            model = file.read()
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [(i, lib.id_to_piece(i)) for i in range(lib.get_piece_size())]
        return model, [bytes([int(name[3:5], 16)]) if lib.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in names]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Side:
    """One tokenizer at work: identifiers of texts, and the bytes they hold."""

    def __init__(self, encoder: ByteLevel | PieceModel, held: list[bytes]):
        self.encoder = encoder
        self.held = pa.array(held, pa.large_binary())
        self.length = np.array([len(h) for h in held], dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts one after another, and how many each text has."""
        n, full = np.zeros(len(texts), dtype=np.int64), [i for i, t in enumerate(texts) if t]
        found = self.encoder.encode([texts[i] for i in full])
        n[full] = list(map(len, found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(n.sum())), n

    def joined(self, ids: np.ndarray) -> memoryview:
        if not len(ids):
            return memoryview(b"")
        return memoryview(self.held.take(pa.array(ids)).buffers()[2]).cast("B")


class Aligned:
    """Tokens of both sides of a batch of texts, those without an alignment left out."""

    def __init__(self, a: Side, b: Side, texts: list[str]):
        want = [(" " + t).encode() if t else b"" for t in texts]
        good = np.ones(len(texts), dtype=bool)
        sides = []
        for side in (a, b):
            ids, n = side.encode(texts)
            length = side.length[ids]
            ends = _starts(length)[_starts(n)]
            held = side.joined(ids)
            for i, expected in enumerate(want):
                if held[ends[i]:ends[i + 1]] != expected:
                    good[i] = False
            if (length == 0).any():  # a token without bytes has no place
                good &= np.bincount(np.repeat(np.arange(len(texts)), n)[length == 0], minlength=len(texts)) == 0
            sides.append((ids, n, length))
        (self.ids_a, self.n_a, length_a), (self.ids_b, self.n_b, length_b) = (
            (ids[keep], np.where(good, n, 0), length[keep])
            for ids, n, length in sides for keep in [np.repeat(good, n)])
        self.texts = len(texts)
        self.starts_a, self.starts_b = _starts(self.n_a), _starts(self.n_b)
        self.bytes_a, self.bytes_b = Rows.runs(length_a), Rows.runs(length_b)
        # bytes behind which both sides end, and so the group of each byte's token
        both = np.zeros(self.bytes_a.width + 1, dtype=np.int8)
        both[self.bytes_a.starts[1:]] += 1
        both[self.bytes_b.starts[1:]] += 1
        number = np.cumsum(both == 2) if len(length_a) else np.zeros(1, dtype=np.int64)
        self.groups = int(number[-1])
        self.group_a, self.group_b = number[self.bytes_a.starts[:-1]], number[self.bytes_b.starts[:-1]]
        text_ends = self.bytes_a.starts[self.starts_a]
        self.n_groups = np.diff(number[text_ends])

    def matrices(self, kind: str) -> tuple[Rows, Rows]:
        """Left and right factor of the product that gives the links of a kind."""
        if kind == "overlap":
            return self.bytes_a, self.bytes_b.transposed()
        if kind == "group":
            return Rows.single(self.group_a, self.groups), Rows.single(self.group_b, self.groups).transposed()
        raise ValueError(f"no links of kind {kind!r}")

    def links(self, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Token of A, token of B (places in the batch) and value of all links."""
        left, right = self.matrices(kind)
        return left.times(right)

    def per_text(self, of_a_tokens: np.ndarray) -> np.ndarray:
        """Sums of a number of each token of A."""
        return np.diff(_starts(of_a_tokens)[self.starts_a])

    def pairs(self) -> tuple[np.ndarray, ...]:
        """Links of each text; text, id of A, id of B and number of links of every distinct pair in a text."""
        owner = np.repeat(np.arange(self.texts), self.n_a)
        wide_a, wide_b = int(self.ids_a.max(initial=0)) + 1, int(self.ids_b.max(initial=0)) + 1
        n_links, keys = np.zeros(len(self.ids_a), dtype=np.int64), []
        for i, j, _ in self.links("overlap"):
            n_links += np.bincount(i, minlength=len(n_links))
            keys.append((owner[i] * wide_a + self.ids_a[i]) * wide_b + self.ids_b[j])
        key, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64), return_counts=True)
        rest, b = np.divmod(key, wide_b)
        text, a = np.divmod(rest, wide_a)
        return self.per_text(n_links), text, a, b, n


class Writer:
    """Groups of a batch as texts ``a1,a2|b1;a3|b2,b3``: ids of A, then of B, group by group."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        lists = [(n_a, ""), (n_a, ";"), (n_a, ","), (n_b, "|"), (n_b, ",")]
        self.strings = pa.array([f"{mark}{i}" for n, mark in lists for i in range(n)], pa.large_string())

    def write(self, x: Aligned) -> pa.Array:
        first_a = np.diff(x.group_a, prepend=-1) != 0
        first_b = np.diff(x.group_b, prepend=-1) != 0
        of_text = np.zeros(len(x.ids_a), dtype=bool)
        of_text[x.starts_a[:-1][x.n_a > 0]] = True
        # where each token stands: behind all tokens of the other side in earlier groups, and A before B within one
        in_a, in_b = np.bincount(x.group_a, minlength=x.groups), np.bincount(x.group_b, minlength=x.groups)
        at_a = np.arange(len(x.ids_a)) + _starts(in_b)[x.group_a]
        at_b = np.arange(len(x.ids_b)) + _starts(in_a)[x.group_b + 1]
        which = np.empty(len(at_a) + len(at_b), dtype=np.int64)
        which[at_a] = x.ids_a + np.where(of_text, 0, np.where(first_a, self.n_a, 2 * self.n_a))
        which[at_b] = x.ids_b + 3 * self.n_a + np.where(first_b, 0, self.n_b)
        lists = pa.LargeListArray.from_arrays(pa.array(x.starts_a + x.starts_b), self.strings.take(pa.array(which)))
        return pc.binary_join(lists, pa.scalar("", pa.large_string())).cast(pa.string())


def _sides(spark, byte_file: str, piece_file: str):
    """Both tokenizers and a writer, made once in a worker process. The files are read by the driver alone."""
    shared = spark.sparkContext.broadcast({"a": ByteLevel.read(byte_file), "b": PieceModel.read(piece_file)})

    def make() -> tuple[Side, Side, Writer]:
        at_hand = shared.value
        if "made" not in at_hand:
            (spec, held_a), (model, held_b) = at_hand["a"], at_hand["b"]
            at_hand["made"] = (Side(ByteLevel(spec, held_a), held_a), Side(PieceModel(model), held_b), Writer(len(held_a), len(held_b)))
        return at_hand["made"]

    return make


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def align(
    docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_group_links``, ``groups`` (a text), the
    distinct linked id pairs with their number of links (``pair_a``, ``pair_b``, ``pair_n``), and ``block``, the
    number of a run of texts of bounded size."""
    texts = _texts(docs, id_col, text_col)
    make = _sides(docs.sparkSession, byte_file, piece_file)
    schema = T.StructType([texts.schema["id"], *T.StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups string, pair_a array<int>, "
        "pair_b array<int>, pair_n array<int>, block long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, writer = make()
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            whole = [t or "" for t in batch.column(1).to_pylist()]
            for part in runs_of(map(len, whole), AT_ONCE):
                chars = sum(map(len, whole[part]))
                if size and size + chars > BLOCK:
                    block, size = block + 1, 0
                size += chars
                x = Aligned(a, b, whole[part])
                n_links, text, pair_a, pair_b, pair_n = x.pairs()
                left, right = x.matrices("group")
                bounds = pa.array(_starts(np.bincount(text, minlength=x.texts)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v.astype(np.int32))) for v in (pair_a, pair_b, pair_n)]
                numbers = [x.n_a, x.n_b, x.n_groups, n_links, x.per_text(left.product_bounds(right))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, x.texts), *map(pa.array, numbers), writer.write(x), *lists,
                     pa.array(np.full(x.texts, block))], names=schema.names)

    return texts.mapInArrow(run, schema)


def links(
    docs: DataFrame, byte_file: str, piece_file: str, kind: str = "overlap", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per link of a kind (``overlap`` or ``group``): ``id``, place and id of both tokens, ``n`` (bytes shared;
    1 for a shared group)."""
    texts = _texts(docs, id_col, text_col)
    make = _sides(docs.sparkSession, byte_file, piece_file)
    schema = T.StructType([texts.schema["id"], *T.StructType.fromDDL("at_a int, id_a int, at_b int, id_b int, n int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, _ = make()
        for batch in batches:
            whole = [t or "" for t in batch.column(1).to_pylist()]
            for part in runs_of(map(len, whole), AT_ONCE):
                x = Aligned(a, b, whole[part])
                owner = np.repeat(np.arange(x.texts), x.n_a)
                ids = batch.column(0).slice(part.start, x.texts)
                for i, j, n in x.links(kind):
                    text = owner[i]
                    numbers = [i - x.starts_a[text], x.ids_a[i], j - x.starts_b[text], x.ids_b[j], n]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(text)), *(pa.array(v.astype(np.int32)) for v in numbers)], names=schema.names)

    return texts.mapInArrow(run, schema)


PAIRS = ("pair_a", "pair_b", "pair_n")


def with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` without its pairs and blocks, with ``n_best`` (links whose pair's count over all rows is the highest of
    its id of B, ties included) and ``count_sum`` (counts of all links' pairs, summed)."""
    aligned = materialise(aligned)
    kept = [c for c in aligned.columns if c not in (*PAIRS, "block")]
    each = F.inline(F.arrays_zip(*(F.col(c) for c in PAIRS)))
    counts = materialise(
        aligned.select(each).groupBy("pair_a", "pair_b").agg(F.sum(F.col("pair_n").cast("long")).alias("count")))
    # at most one row per id of B, so its size is bounded by the vocabulary
    highest = counts.groupBy("pair_b").agg(F.max("count").alias("highest"))
    told = counts.join(F.broadcast(highest), "pair_b").select(
        "pair_a", "pair_b", "count", (F.col("count") == F.col("highest")).alias("best"))
    asked = aligned.select(F.col("block").alias("asking"), each).select("asking", "pair_a", "pair_b").distinct()
    answers = asked.join(told, ["pair_a", "pair_b"])
    schema = T.StructType([*[aligned.schema[c] for c in kept], *T.StructType.fromDDL("n_best long, count_sum long").fields])

    def price(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        number = lambda table, c: table[c].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = [np.concatenate([np.zeros(0, np.int64), *(x.flatten().to_numpy() for x in texts[c].chunks)]).astype(np.int64)
                for c in PAIRS]
        sizes = number(pa.table({"n": pc.list_value_length(texts["pair_a"])}), "n")
        key = number(pairs, "pair_a") << 32 | number(pairs, "pair_b")
        order = np.argsort(key)
        at = order[np.searchsorted(key[order], flat[0] << 32 | flat[1])]
        total = lambda v: pa.array(np.diff(_starts(v)[_starts(sizes)]))
        found = [total(np.where(number(pairs, "best")[at] > 0, flat[2], 0)), total(number(pairs, "count")[at] * flat[2])]
        return pa.Table.from_arrays([*(texts[c] for c in kept), *found], names=schema.names)

    return aligned.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(price, schema)
