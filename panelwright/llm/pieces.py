"""SentencePiece encoding and decoding by matching all pieces in a suffix array of the batch.

The model is a BPE piece model with byte fallback: characters are merged into ever longer pieces, best score first.
A sequence of pieces is that result exactly if every two neighbours are (Berglund and van der Merwe, "Formalizing BPE
tokenization"), so the last piece of every prefix is unique and one pass from left to right finds it:

1. the batch's texts are cut before each run of spaces, as no piece has a space behind another character, and a first
   word of letters is parted from a sign that no piece has behind a letter, so nothing merges across. Each distinct part
   is worked on once;
2. the distinct parts are joined into one text, whose suffixes are sorted by as many characters as the longest piece has;
3. every piece is searched in the suffix array by bisection, all pieces at once, which gives its range of occurrences;
4. these edges are sorted by the position at which they end, and relaxed in that order: an edge is taken if the piece
   before it may stand in front of it.

Runs of spaces merge after everything else and are added by merging them alone. A character without a piece becomes its
UTF-8 byte pieces. ``Pieces.of`` raises ValueError for a model to which any of this does not apply.

Decoding joins the pieces, turns byte pieces back into characters and takes off the leading space that encoding
adds, so it gives the text back; U+2581, the model's sign for a space, comes back as a space.

Defined cases: null and empty texts have no pieces and decode to the empty text; a text without spaces is one cut of any
length; repeated rows are encoded row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import give_back, map_texts

SPACE = "▁"
MEMORY, LONG = 150_000, 64
#: Entries of the table that remembers which neighbours are possible (a power of two).
PAIRS = 1 << 20
#: Distinct cuts are indexed in blocks of about this many characters.
BLOCK = 100_000
#: Texts encoded at once, in characters: many, as they share parts.
AT_ONCE = 1_000_000
RUNS = re.compile(" *[^ ]+| +")


def merge_all(symbols: list[str], score: dict[str, float]) -> list[str]:
    """Merge the adjacent pair with the best score, the leftmost of equals, until none is left."""
    at, n = list(symbols), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-score[w], i, w) for i in range(n - 1) if (w := at[i] + at[i + 1]) in score]
    heapify(heap)
    while heap:
        _, i, made = heappop(heap)
        j = after[i]
        if at[i] == "" or j >= n or at[i] + at[j] != made:
            continue
        at[i], at[j] = made, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (w := made + at[k]) in score:
                heappush(heap, (-score[w], i, w))
        p = before[i]
        if p >= 0 and (w := at[p] + made) in score:
            heappush(heap, (-score[w], p, w))
    return [s for s in at if s]


@dataclass
class Pieces:
    """A piece model as arrays. Symbol numbers: characters of the alphabet first, then longer pieces by rank."""

    names: list[str]
    score: dict[str, float]
    char_of: dict[str, int]
    symbols: list[str]
    ids: np.ndarray
    byte_ids: list[int]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_rank: np.ndarray
    usable: np.ndarray
    parts: str
    runs: dict[int, bytes] = field(default_factory=dict)

    @classmethod
    def of(cls, model_file: str) -> Pieces:
        """Read a model file with the public library; ValueError if it is of another kind."""
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        score = {names[i]: lib.get_score(i) for i in normal}
        runs = [p for p in score if len(p) > 1 and set(p) == {SPACE}]
        others = [p for p in score if len(p) > 1 and set(p) != {SPACE}]
        scores = sorted(score[p] for p in others)
        probe = "  A  b\t\n ▁cﬁＡ "
        fits = (
            all(lib.is_byte(i) for i in byte_ids) and all(SPACE not in p[1:] for p in others)
            and len(set(scores)) == len(scores) and max((score[p] for p in runs), default=-np.inf) < scores[0]
            and SPACE in score and lib.decode(lib.encode(probe)) == probe.replace(SPACE, " ")
            and lib.encode("b", out_type=str)[0].startswith(SPACE) and max(map(len, others)) <= 20)
        if not fits:
            raise ValueError("not a BPE piece model with byte fallback, a leading space and no other normalisation")
        # signs that no piece has behind a letter
        letters = sorted(c for c in {c for p in others for c in p} if c.isalpha() and ord(c) < 0x250)
        behind = {b for p in others for a, b in zip(p, p[1:]) if a in set(letters)}
        signs = sorted({p for p in score if len(p) == 1 and not p.isalpha() and p != SPACE} - behind)
        parts = ".+"
        if signs and letters:
            group = lambda cs: "[" + "".join(map(re.escape, cs)) + "]"
            parts = f" ?{group(letters)}+(?={group(signs)})|.+"
        chars = sorted({c for p in others for c in p} | {p for p in score if len(p) == 1})
        others.sort(key=lambda p: -score[p])
        symbols = chars + others
        number = {p: i for i, p in enumerate(symbols)}
        rank = np.array([-1] * len(chars) + list(range(len(others))), dtype=np.int64)
        left, right = np.full(len(symbols), -1), np.full(len(symbols), -1)
        usable = np.zeros(len(symbols), dtype=bool)
        usable[:len(chars)] = True
        pairs = {}
        for p in others:
            i = number[p]
            # every way to put a piece together from two others merges with the piece's score
            for cut in range(1, len(p)):
                if p[:cut] in number and p[cut:] in number:
                    pairs[number[p[:cut]] << 32 | number[p[cut:]]] = rank[i]
            # the last merge of the piece: that of the best merges of its characters
            halves = merge_all(list(p), _Below(score, p))
            if len(halves) == 2 and merge_all(list(p), score) == [p]:
                left[i], right[i], usable[i] = number[halves[0]], number[halves[1]], True
        keys = np.array(sorted(pairs), dtype=np.int64)
        ids = np.array([lib.piece_to_id(p) if p in score else -1 for p in symbols], dtype=np.int32)
        return cls(names, score, {c: i for i, c in enumerate(chars)}, symbols, ids, byte_ids, rank, left, right, keys,
                   np.array([pairs[k] for k in keys.tolist()], dtype=np.int64), usable, parts)


class _Below(dict):
    """Scores without one piece: merging with them stops at the halves of that piece."""

    def __init__(self, score, without):
        super().__init__()
        self.score, self.without = score, without

    def __contains__(self, piece):
        return piece != self.without and piece in self.score

    def __getitem__(self, piece):
        return self.score[piece]


class Encoder:
    """Encodes batches of texts; remembers the cuts and neighbours it has seen."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.part = re.compile(pieces.parts, re.DOTALL).findall
        # identifiers, four bytes each; spaces stay spaces in the keys, which halves those of ASCII letters
        self.known: dict[str, bytes] = {}
        self.part_ids: dict[str, bytes] = {}
        self.pair_key = np.full(PAIRS, -1, dtype=np.int64)
        self.pair_ok = np.zeros(PAIRS, dtype=bool)
        self.unknown = len(pieces.symbols)  # a character that no piece has
        n_chars = len(pieces.char_of)
        self.code = np.full(0x110000, n_chars, dtype=np.int32)
        for c, i in pieces.char_of.items():
            self.code[ord(c)] = i
        self.code[ord(" ")] = pieces.char_of[SPACE]
        # characters are packed as code + 1, several to a 63-bit key; 0 stands for the end of a cut
        self.bits = int(n_chars + 1).bit_length()
        self.per_key = 63 // self.bits
        multi = [i for i in np.flatnonzero(pieces.usable).tolist() if len(pieces.symbols[i]) > 1]
        self.multi = np.array(multi, dtype=np.int64)
        self.sizes = np.array([len(pieces.symbols[i]) for i in multi], dtype=np.int64)
        self.longest = int(self.sizes.max(initial=1))
        self.keys = -(-self.longest // self.per_key)
        # the range of keys that a piece's characters leave open, for each key
        self.low = np.zeros((self.keys, len(multi)), dtype=np.int64)
        self.high = np.zeros((self.keys, len(multi)), dtype=np.int64)
        for j, i in enumerate(multi):
            codes = [pieces.char_of[c] + 1 for c in pieces.symbols[i]]
            for k in range(self.keys):
                part = codes[k * self.per_key:(k + 1) * self.per_key]
                value = 0
                for c in part:
                    value = value << self.bits | c
                rest = self.bits * (self.per_key - len(part))
                self.low[k, j], self.high[k, j] = value << rest, ((value + 1) << rest) - 1

    def may_follow(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        """Whether two symbols, each a possible result by itself, also stay two when they meet."""
        key = first << 32 | then
        slot = ((key * np.int64(-7046029254386353131)) >> 44) & (PAIRS - 1)
        seen = self.pair_key[slot] == key
        ok = self.pair_ok[slot]
        if not seen.all():
            new = np.unique(key[~seen])
            result = self._meet(new >> 32, new & 0xFFFFFFFF)
            ok[~seen] = result[np.searchsorted(new, key[~seen])]
            at = ((new * np.int64(-7046029254386353131)) >> 44) & (PAIRS - 1)
            # where two new pairs share a slot, one of them is kept whole
            at, pick = np.unique(at, return_index=True)
            self.pair_key[at], self.pair_ok[at] = new[pick], result[pick]
        return ok

    def _meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges of both sides from the last to the first: the neighbours fail if, at some moment,
        what faces each other would have merged before the merge undone last."""
        p, never = self.p, np.int64(1 << 40)
        out = (a == self.unknown) | (b == self.unknown)
        todo = np.flatnonzero(~out)
        out[todo] = True
        a, b = a[todo], b[todo]
        limit = np.full(len(todo), never)  # merges of a rank below this come first
        strict = np.zeros(len(todo), dtype=bool)  # True: equal rank also comes first
        while len(todo):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(p.pair_keys, key), len(p.pair_keys) - 1)
            rank = np.where(p.pair_keys[at] == key, p.pair_rank[at], never)
            fails = (rank < limit) | (strict & (rank == limit))
            out[todo[fails]] = False
            ra, rb = p.rank[a], p.rank[b]
            # of equal merges the left one is done first, so the right one is undone first
            undo_b = (rb >= ra) & (rb >= 0)
            undo_a = ~undo_b & (ra >= 0)
            go = ~fails & (undo_a | undo_b)
            limit = np.where(undo_b, rb, ra)
            strict = undo_b
            a, b = np.where(undo_a, p.right[a], a), np.where(undo_b, p.left[b], b)
            todo, a, b, limit, strict = todo[go], a[go], b[go], limit[go], strict[go]
        return out

    def _edges(self, codes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and index into ``multi`` of every occurrence of every longer piece, by bisection of the suffix array.

        ``room`` is the number of characters from each position to the end of its cut.
        """
        n = len(codes)
        ahead = np.zeros((self.keys, n), dtype=np.int64)
        padded = np.concatenate([codes + 1, np.zeros(self.longest + self.per_key, dtype=np.int64)])
        for k in range(self.keys):
            for j in range(self.per_key):
                at = k * self.per_key + j
                ahead[k] = ahead[k] << self.bits | np.where(room > at, padded[at:at + n], 0)
        order = np.lexsort(ahead[::-1])
        ahead = ahead[:, order]
        low, high = np.zeros(len(self.multi), dtype=np.int64), np.full(len(self.multi), n, dtype=np.int64)
        for k in range(self.keys):
            use = (self.sizes > k * self.per_key) & (low < high)
            new = [self._bisect(ahead[k], low[use], high[use], bound, right) for bound, right in
                   ((self.low[k, use], False), (self.high[k, use], True))]
            low[use], high[use] = new
        found = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(found)), found)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
        return order[np.repeat(low, found) + inside], which

    @staticmethod
    def _bisect(keys: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
        """First place in ``keys[low:high]`` not below (``right``: above) the value, for all pieces at once."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high) >> 1
            here = keys[np.minimum(mid, len(keys) - 1)]
            up = open_ & ((here <= value) if right else (here < value))
            low = np.where(up, mid + 1, low)
            high = np.where(open_ & ~up, mid, high)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Identifiers of cuts that start with one space or none."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        codes = self.code[points].astype(np.int64)
        n = len(codes)
        starts = np.cumsum(sizes) - sizes
        offset = np.arange(n) - np.repeat(starts, sizes)
        room = np.repeat(sizes, sizes) - offset
        at, which = self._edges(codes, room)
        single = np.where(codes < len(self.p.char_of), codes, self.unknown)
        begin = np.concatenate([np.arange(n), at]).astype(np.int32)
        symbol = np.concatenate([single, self.multi[which]]).astype(np.int32)
        size = np.concatenate([np.ones(n, dtype=np.int64), self.sizes[which]]).astype(np.int32)
        del at, which
        level = (offset[begin] + size).astype(np.uint16 if sizes.max() < 1 << 16 else np.int64)  # where in its cut an edge ends
        order = np.argsort(level, kind="stable").astype(np.int32)
        begin, symbol, size, level = begin[order], symbol[order], size[order], level[order]
        del order
        last = np.full(n, -1, dtype=np.int64)  # of the text up to and with a position: its last symbol
        length = np.zeros(n, dtype=np.int64)
        first = offset == 0
        bounds = np.searchsorted(level, np.arange(1, int(sizes.max()) + 2))
        for i in range(len(bounds) - 1):
            part = slice(bounds[i], bounds[i + 1])
            b, s, m = begin[part], symbol[part], size[part]
            ok = first[b]
            inner = np.flatnonzero(~ok)
            if len(inner):
                ok[inner] = self.may_follow(last[b[inner] - 1], s[inner].astype(np.int64))
            end = (b + m - 1)[ok]
            last[end], length[end] = s[ok], m[ok]
        # walk back from the end of each cut, all cuts at once
        place, owner, steps = starts + sizes - 1, np.arange(len(words)), []
        while len(owner):
            s, m = last[place], length[place]
            steps.append((owner, s, place))
            place = place - m
            on = place >= starts[owner]
            place, owner = place[on], owner[on]
        owners = np.concatenate([x[0] for x in steps])
        found = np.concatenate([x[1] for x in steps])
        places = np.concatenate([x[2] for x in steps])
        order = np.argsort(places, kind="stable")
        owners, found, places = owners[order], found[order], places[order]
        ids = np.where(found < self.unknown, self.p.ids[np.minimum(found, self.unknown - 1)], -1).astype("<i4")
        odd = np.flatnonzero(ids < 0).tolist()  # characters that are spelt in bytes
        if odd:
            spelt = [chr(points[places[k]]).encode() for k in odd]
            times = np.ones(len(ids), dtype=np.int64)
            times[odd] = list(map(len, spelt))
            ids, owners = np.repeat(ids, times), np.repeat(owners, times)
            ids[ids < 0] = [self.p.byte_ids[x] for x in b"".join(spelt)]
        ends = (4 * np.searchsorted(owners, np.arange(len(words)), side="right")).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _run(self, n: int) -> bytes:
        """Identifiers of ``n`` spaces that nothing else merges with."""
        if n not in self.p.runs:
            number = {SPACE * k: i for i, name in enumerate(self.p.names) if (k := len(name)) and name == SPACE * k}
            made = np.array([number[x] for x in merge_all([SPACE] * n, self.p.score)], dtype="<i4").tobytes()
            if n > 1000:
                return made
            self.p.runs[n] = made
        return self.p.runs[n]

    def _encode_parts(self, parts: list[str]) -> None:
        """Learn distinct parts, block by block."""
        block, size = [], 0
        for k, part in enumerate(parts):
            block.append(part)
            size += len(part)
            if size >= BLOCK or k == len(parts) - 1:
                self.part_ids.update(zip(block, self._encode_words(block)))
                block, size = [], 0

    def _learn(self, cuts: list[str]) -> dict[str, bytes]:
        """Identifiers of distinct cuts, each given without its first space."""
        spaces = [1 + len(c) - len(c.lstrip(" ")) for c in cuts]
        parts = [self.part(" " + c[m - 1:]) for c, m in zip(cuts, spaces)]
        needed = set(chain.from_iterable(parts))
        if len(self.part_ids) + len(needed) > MEMORY:
            self.part_ids = {p: ids for p in needed if (ids := self.part_ids.get(p)) is not None}
        self._encode_parts([p for p in needed if p not in self.part_ids])
        alone = self.p.ids[[self.p.char_of[SPACE]]].astype("<i4").tobytes()
        out = {}
        for c, m, ps in zip(cuts, spaces, parts):
            ids = self.part_ids[ps[0]] if len(ps) == 1 else b"".join(map(self.part_ids.__getitem__, ps))
            if m > 1:  # spaces merge last: with the sign before the word if that has stayed alone
                ids = self._run(m) + ids[4:] if ids[:4] == alone else self._run(m - 1) + ids
            out[c] = ids
        for p in needed:
            if len(p) > LONG:
                del self.part_ids[p]
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Identifiers of each text."""
        return [np.frombuffer(ids, dtype="<i4").tolist() for ids in self.packed(texts)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Identifiers of each text, four bytes each. Cuts are kept without the space that each of them starts with."""
        cuts = []
        for t in texts:
            t = t.replace(SPACE, " ")
            if "  " in t or t[:1] == " " or t[-1:] == " ":
                cuts.append([c[1:] for c in RUNS.findall(" " + t)])
            else:
                cuts.append(t.split(" ") if t else [])
        known = self.known
        missing = set(chain.from_iterable(cuts)).difference(known)
        if missing:
            fresh = self._learn(list(missing))
            if len(known) + len(fresh) > MEMORY:
                rest = {c: known[c] for cs in cuts for c in cs if c in known}
                known.clear()
                known.update(rest)
            known.update(fresh)
        out = [b"".join(map(known.__getitem__, cs)) for cs in cuts]
        for c in missing:
            if len(c) > LONG:
                del known[c]
        return out


class Decoder:
    """Turns identifiers back into text."""

    def __init__(self, pieces: Pieces):
        byte = {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}
        self.of = [byte.get(i) or name.replace(SPACE, " ").encode() for i, name in enumerate(pieces.names)]
        self.held = pa.array(self.of, pa.large_binary())
        self.length = np.array(list(map(len, self.of)), dtype=np.int64)

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.of.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")

    def gives(self, ids: np.ndarray, counts: list[int], texts: list[str]) -> list[bool]:
        """Whether the identifiers of each text, one text after another, decode to it; bytes are gathered for all at once."""
        if not len(ids):
            return [not t for t in texts]
        held = memoryview(self.held.take(pa.array(ids)).buffers()[2]).cast("B")
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        want = [(" " + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
        return [held[a:b] == w for a, b, w in zip(ends, ends[1:], want)]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_pieces, ids, round_trip)`` of every row: identifiers, and whether decoding them gives the text back.

    The file is read by the driver alone.
    """
    # as large as the vocabulary; a worker process keeps its copy, and the memory in it, from task to task
    shared = docs.sparkSession.sparkContext.broadcast({"pieces": Pieces.of(model_file)})

    def make():
        give_back()
        at_hand = shared.value
        if "encoder" not in at_hand:
            at_hand["encoder"], at_hand["decoder"] = Encoder(at_hand["pieces"]), Decoder(at_hand["pieces"])
        encoder, decoder = at_hand["encoder"], at_hand["decoder"]

        def work(texts: list[str]) -> list:
            rows = encoder.packed(texts)
            counts = [len(r) >> 2 for r in rows]
            flat = np.frombuffer(b"".join(rows), dtype="<i4")
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            same = decoder.gives(flat, counts, texts)
            return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), same]

        return work

    return map_texts(docs, [id_col], text_col, "n_pieces long, ids array<int>, round_trip boolean", make, AT_ONCE)


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, text)`` from identifiers; null identifiers give null, and so does one that the model lacks."""
    from pyspark.sql import types as T

    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType())])
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces.of(model_file))

    def run(batches):
        decoder = Decoder(shared.value)
        size = len(decoder.of)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            texts = [None if r is None or any(i is None or not 0 <= i < size for i in r) else decoder.decode(r)
                     for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)
