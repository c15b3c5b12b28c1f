"""Near duplicates by an LSH forest over MinHash signatures.

A text's set holds the hashes of its shingles: ``size`` consecutive words after lower-casing A-Z, words being what ASCII
white space separates; a text with fewer words, but some, has its whole sequence as one shingle. Equal sets are one node.

Each of ``TREES`` trees orders the nodes by its own sequence of ``DEPTH`` MinHash values. Neighbours in that order have the
longest common prefixes: where texts are sparse they share few values, where they are dense they share many, so the depth
of comparison adapts to the region. Orders are range-partitioned and sorted, so a region of any size is spread over tasks.
Every node is compared with the ``REACH`` nodes before it by 2-bit signatures. A likely pair is a candidate unless two
strong ones connect it already, so groups of copies give a number of candidates in proportion to their size. Candidates
are confirmed on the full sets; confirmed links are the edges of the components. The first trees give the nearest candidate
of each node; after them a candidate inside a component needs no check and is not made, and one that strong ones seemed to
connect is confirmed after all if they turn out not to.

In a dense region a node's link may lie out of reach. So where nodes of more components than are within reach share
``SHARED`` values, all nodes there are searched exactly: nodes of different components are joined on the rarest
shingles of their sets, at least one of which any linked pair has in common, and confirmed on the full sets. Where a few
groups fill a region, a node's neighbours are members of these, and one that is nearly linked asks the whole group.

A pair of similarity s shares the first d values of a tree with probability s^d. If it does in some tree, it is either
within reach there, or in a region of few groups, or both are in a dense region. It shares none at s = 0.8 and
d = ``SHARED`` in the trees after the first ones with probability 0.488^17, 5 in a million; the estimate from 2-bit values
falls below ``LIKELY`` for 44 in a million pairs of that similarity, and for fewer of greater.

Defined cases: null and empty texts and texts of white space have the empty set, which is linked with nothing; a null id
is a document as any other and the greatest in order; rows of one id with different texts are documents of their own;
repeated rows have the same set; texts are taken whole; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise
from .arrow import give_back, map_texts
from .components import components

TREES, DEPTH, REACH = 20, 8, 16
#: Values used for the estimate, and the least estimates for a candidate and for a strong one.
ESTIMATED, LIKELY, STRONG = 128, 0.62, 0.8
#: Trees whose candidates are confirmed first; the rest only look for links between the groups found by then.
FIRST = 3
#: A compared pair this many percent short of a link has its node compared with the whole group of the other.
NEARLY = 10
#: Values that the nodes of a dense region share, and buckets that shingles are counted in to tell the rare ones.
SHARED, BUCKETS = 3, 1 << 18
BROADCAST_BYTES = 32 << 20
#: Elements and sets of a block, where nodes ask a group; a pair listed costs as much as so many of a matrix product.
BLOCK, BLOCK_SETS, PRODUCT = 1 << 19, 1 << 10, 100
_RNG = np.random.default_rng(20)
FACTORS = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose words are hashed at once.
AT_ONCE = 1_000_000


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased bytes, and where they start."""
    b = np.frombuffer(data, dtype=np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    # sums of byte * BASE^place; a word's sum is divided by BASE^start
    power = np.full(len(b) + 1, BASE, dtype=np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    power[:] = INVERSE
    power[0] = 1
    np.cumprod(power, out=power)
    value = (total[end] - total[start]) * power[start]
    return scramble(value + (end - start).astype(np.uint64) * BASE), start


def blocks_of(data: bytes) -> Iterator[bytes]:
    """Parts of about ``AT_ONCE`` bytes that end behind a space; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + AT_ONCE
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end]
        at = end


def sets_of(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = [t.encode().lower() for t in texts]  # bytes: A-Z only
    ends = np.cumsum([len(d) + 1 for d in data])
    if ends[-1] <= 2 * AT_ONCE:
        words, start = word_hashes(b" ".join(data) + b" ")
        bounds = np.searchsorted(start, np.concatenate([[0], ends]))
        per_text = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    else:
        per_text = [np.concatenate([word_hashes(x)[0] for x in blocks_of(d)] or [np.zeros(0, np.uint64)]) for d in data]
    out = []
    for words in per_text:
        n = len(words)
        take = min(size, n)
        if not n:
            out.append(words)
            continue
        h = np.full(n - take + 1, take, dtype=np.uint64)
        for j in range(take):
            h = scramble(h * BASE + words[j:j + len(h)])
        out.append(np.unique(h))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The upper halves of the least values of each non-empty set under every permutation."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), TREES * DEPTH), dtype=np.uint32)
    step, begin = 1 << 16, 0
    ends = np.append(starts[1:], len(flat))
    while begin < len(sets):  # runs of sets that stay in cache
        stop = max(begin + 1, int(np.searchsorted(ends, starts[begin] + step, side="right")))
        part = flat[starts[begin]:ends[stop - 1]]
        local = starts[begin:stop] - starts[begin]
        for i in range(TREES * DEPTH):
            out[begin:stop, i] = np.minimum.reduceat(part * FACTORS[i] + TERMS[i], local) >> np.uint64(32)
        begin = stop
    return out


def sign(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(id, th, n, node, signature)`` of every row; node and signature are null for the empty set."""

    def make():
        give_back()

        def work(texts: list[str]) -> list:
            sets = sets_of(texts, size)
            full = [i for i, s in enumerate(sets) if len(s)]
            node: list = [None] * len(sets)
            signature: list = [None] * len(sets)
            if full:
                rows = signatures([sets[i] for i in full]).astype(">u4")  # sorts as bytes
                for i, r in zip(full, rows):
                    node[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    signature[i] = r.tobytes()
            return [[len(s) for s in sets], node, signature]
        return work

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"),
                       F.col(text_col).alias("text"))
    return map_texts(rows, ["id", "th"], "text", "n long, node binary, signature binary", make)


def _planes(signature: np.ndarray) -> np.ndarray:
    """The two lowest bits of the first ``ESTIMATED`` values of signatures, as two bit planes."""
    low = signature[:, :ESTIMATED] & 3
    planes = np.concatenate([np.packbits((low & 1).astype(np.uint8), axis=1),
                             np.packbits((low >> 1).astype(np.uint8), axis=1)], axis=1)
    return np.ascontiguousarray(planes).view(np.uint64)


def tree_rows(nodes: DataFrame, trees: range) -> DataFrame:
    """A row per node and tree: ``(tree, key, planes, node, root)``, from ``nodes(node, signature, root)``."""

    def run(batches):
        give_back()
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=">u4").reshape(-1, TREES * DEPTH)
            planes = pa.array([p.tobytes() for p in _planes(raw.astype(np.uint32))], pa.binary())
            for tree in trees:
                keys = np.ascontiguousarray(raw[:, tree * DEPTH:(tree + 1) * DEPTH])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(raw), tree, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                     planes, batch.column(0), batch.column(2)], ["tree", "key", "planes", "node", "root"])

    return nodes.select("node", "signature", "root").mapInArrow(
        run, "tree int, key binary, planes binary, node binary, root binary")


def neighbours(rows: DataFrame, partitions: int, nearest: bool) -> DataFrame:
    """Candidates among neighbours of each tree's order with different roots, and nodes of dense regions.

    ``(what, a, b, region)``: ``what`` 0 is a candidate, ``a`` before ``b`` in bytes; 1 is one that strong ones seem to
    connect; 2 is a node ``a`` of a dense region. With ``nearest`` a node gives one candidate in a tree, the nearest likely
    one before it, and nothing else.
    """

    def run(batches):
        give_back()
        words = ESTIMATED // 32
        last = first = None

        def pairs(what, x, y):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), what, np.int32)), pa.array([min(p, q) for p, q in zip(x, y)], pa.binary()),
                 pa.array([max(p, q) for p, q in zip(x, y)], pa.binary()), pa.array([0] * len(x), pa.int64())],
                ["what", "a", "b", "region"])

        def marks(node, dense):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(node), 2, np.int32)), pa.array(list(node), pa.binary()),
                 pa.array([None] * len(node), pa.binary()), pa.array(dense.view(np.int64))], ["what", "a", "b", "region"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy(zero_copy_only=False)
            keys = np.frombuffer(b"".join(k[:4 * SHARED] for k in batch.column(1).to_pylist()), dtype=">u4").reshape(-1, SHARED)
            region = tree.astype(np.int64) << 32 | keys[:, 0].astype(np.int64)
            shared = scramble(tree.astype(np.uint64))
            for j in range(SHARED):
                shared = scramble(shared * BASE + keys[:, j].astype(np.uint64))
            planes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint64).reshape(-1, words)
            node = np.array(batch.column(3).to_pylist(), dtype=object)
            root = np.array(batch.column(4).to_pylist(), dtype=object)
            marked = np.zeros(len(node), dtype=bool)
            old = 0
            if last is not None:  # the rows within reach of this batch's first ones
                old = len(last[0])
                region, planes, node, root, shared, marked = (
                    np.concatenate(x) for x in zip(last, (region, planes, node, root, shared, marked)))
            n = len(region)
            taken = np.zeros(n, dtype=bool)
            est = np.zeros((REACH + 1, n), dtype=np.float32)  # with the row so many places before
            for lag in range(1, min(REACH, n - 1) + 1):
                at = np.flatnonzero(region[lag:] == region[:-lag]) + lag
                x = planes[at] ^ planes[at - lag]
                half = words // 2
                differ = np.bitwise_count(x[:, :half] | x[:, half:]).sum(axis=1)
                est[lag, at] = 1 - (differ / ESTIMATED) / 0.75
            for lag in range(1, min(REACH, n - 1) + 1):
                at = np.flatnonzero(est[lag] >= LIKELY)
                at = at[at >= old]
                at = at[root[at] != root[at - lag]]
                if nearest:
                    at = at[~taken[at]]
                    taken[at] = True
                found = at
                for between in range(1, lag):
                    if not len(at):
                        break
                    linked = (est[between, at] >= STRONG) & (est[lag - between, at - between] >= STRONG)
                    at = at[~linked]
                if len(at):
                    yield pairs(0, node[at - lag], node[at])
                if not nearest and len(at) < len(found):
                    at = np.setdiff1d(found, at)
                    yield pairs(1, node[at - lag], node[at])
            if not nearest:
                # more than are within reach share values: both ends of every such stretch, so all of it; and what
                # may go on in the partition before
                dense = np.zeros(n, dtype=bool)
                if n > REACH:
                    at = np.flatnonzero(shared[REACH:] == shared[:-REACH])
                    dense[at] = dense[at + REACH] = True
                if first is None:
                    first = shared[0]
                    dense[:REACH] |= shared[:REACH] == first
                dense &= ~marked
                if dense.any():
                    yield marks(node[dense], shared[dense])
                marked |= dense
            last = (region[-REACH:], planes[-REACH:], node[-REACH:], root[-REACH:], shared[-REACH:], marked[-REACH:])
        if last is not None and not nearest:  # what may go on in the partition after
            _, _, node, _, shared, marked = last
            dense = (shared == shared[-1]) & ~marked
            if dense.any():
                yield marks(node[dense], shared[dense])

    ordered = rows.repartitionByRange(partitions, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    return ordered.mapInArrow(run, "what int, a binary, b binary, region long")


def small(df: DataFrame, width: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, to be broadcast if its rows of about ``width`` bytes are known to fit."""
    return F.broadcast(df) if df.count() * width <= most else df


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the numbers of their sets' common elements ``i`` and of all elements ``u``."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    counted = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return counted.select("a", "b", "i", (F.col("t") - F.col("i")).alias("u"))


def at_least(percent: int):
    return F.col("i") * 100 >= F.col("u") * percent


def questions(failed: DataFrame, rooted: DataFrame) -> DataFrame:
    """``(node, root)``: which node is to be compared with which group.

    ``failed(a, b)`` are compared pairs that nearly link two groups. Reach is limited, so another member of the group may
    be closer: the node in the smaller of the two groups asks the larger one.
    """
    sizes = rooted.groupBy("root").agg(F.count("*").alias("k"))
    end = lambda side: (rooted.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
                        .join(sizes.select(F.col("root").alias(f"r{side}"), F.col("k").alias(f"k{side}")), f"r{side}"))
    ends = failed.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        "a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"),
        F.coalesce("ka", F.lit(1)).alias("ka"), F.coalesce("kb", F.lit(1)).alias("kb")).where("ra <> rb and ka + kb > 2")
    a_asks = (F.col("ka") < F.col("kb")) | ((F.col("ka") == F.col("kb")) & (F.col("ra") < F.col("rb")))
    return ends.select(F.when(a_asks, F.col("a")).otherwise(F.col("b")).alias("node"),
                       F.when(a_asks, F.col("rb")).otherwise(F.col("ra")).alias("root")).distinct()


def common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each of one's sets shares with each of two's.

    Elements of many sets on both sides are counted by matrix products, the others by listing the pairs they are in.
    """
    rows = lambda sets: np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    both = np.intersect1d(np.concatenate(one), np.concatenate(two))
    out = np.zeros((len(one), len(two)), dtype=np.int32)
    if not len(both):
        return out

    def places(sets):
        flat, row = np.concatenate(sets), rows(sets)
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        hit = both[at] == flat
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], row[hit][order]

    (x, p), (y, q) = places(one), places(two)
    k, m = np.bincount(x, minlength=len(both)), np.bincount(y, minlength=len(both))
    many = k * m * PRODUCT > out.size
    where = np.flatnonzero(many)
    for begin in range(0, len(where), AT_ONCE >> 9):
        part = where[begin:begin + (AT_ONCE >> 9)]
        column = np.full(len(both), -1)
        column[part] = np.arange(len(part))
        left, right = np.zeros((len(one), len(part)), np.float32), np.zeros((len(two), len(part)), np.float32)
        for full, at, row in ((left, column[x], p), (right, column[y], q)):
            full[row[at >= 0], at[at >= 0]] = 1
        out += (left @ right.T).astype(np.int32)
    start = np.cumsum(m) - m
    few = ~many[x]
    x, p = x[few], p[few]
    ends = np.cumsum(m[x])
    begin = 0
    while begin < len(x):  # runs of about AT_ONCE pairs
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + AT_ONCE, side="right")))
        times = m[x[begin:stop]]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        met = np.repeat(p[begin:stop], times) * len(two) + q[np.repeat(start[x[begin:stop]], times) + inside]
        out += np.bincount(met, minlength=out.size).reshape(out.shape).astype(np.int32)
        begin = stop
    return out


def open_links(asks: DataFrame, rooted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between a node that asks and a member of the group it asks, at least one where there is any.

    A group is connected already, so one member is as good as all. Those who ask and the members are cut into blocks of
    bounded size; all blocks of the one meet all of the other, wherever there is room, so no group is one task's.
    """
    n = F.size("shingles")
    asked = asks.join(sets, "node").select("root", "node", "shingles")
    members = rooted.join(asks.select("root").distinct(), "root", "left_semi").join(sets, "node").select("root", "node", "shingles")
    ways = lambda rows, name: rows.groupBy("root").agg(F.greatest(
        F.ceil(F.sum(n.cast("long")) / BLOCK), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias(name))
    grid = small(materialise(ways(asked, "wx").join(ways(members, "wy"), "root")), 32)
    own = lambda way: F.pmod(F.xxhash64("node"), F.col(way)).cast("int")
    every = lambda way: F.explode(F.sequence(F.lit(0), F.col(way) - 1))
    cells = asked.join(grid, "root").select("root", own("wx").alias("x"), every("wy").alias("y"), F.lit(True).alias("asks"), "node", "shingles").union(
        members.join(grid, "root").select("root", every("wx").alias("x"), own("wy").alias("y"), F.lit(False).alias("asks"), "node", "shingles"))

    def meet(table: pa.Table) -> pa.Table:
        give_back()
        asking = table.column("asks").to_numpy()
        node = table.column("node").to_pylist()
        flat = [x.values.to_numpy(zero_copy_only=False) for x in table.column("shingles")]
        one, two = np.flatnonzero(asking), np.flatnonzero(~asking)
        found: list[list] = [[], []]
        if len(one) and len(two):
            sets = [[flat[i] for i in side] for side in (one, two)]
            shared = common(*sets).astype(np.int64)
            total = np.add.outer(*[np.array([len(x) for x in side]) for side in sets])
            linked = shared * 100 >= (total - shared) * percent
            for i in np.flatnonzero(linked.any(axis=1)):
                found[0].append(node[one[i]])
                found[1].append(node[two[linked[i].argmax()]])
        return pa.table({"a": pa.array(found[0], pa.binary()), "b": pa.array(found[1], pa.binary())})

    return cells.groupBy("root", "x", "y").applyInArrow(meet, "a binary, b binary")


def dense_nodes(marks: DataFrame, rooted: DataFrame) -> DataFrame:
    """``(node)`` of dense regions that hold more components than are within reach."""
    placed = materialise(marks.select("region", F.col("a").alias("node")).join(rooted, "node", "left").select(
        "region", "node", F.coalesce("root", "node").alias("root")))
    groups = placed.select("region", "root").distinct().groupBy("region").agg(F.count("*").alias("k"))
    mixed = materialise(groups.where(F.col("k") > REACH).select("region"))
    return materialise(placed.join(small(mixed, 16), "region", "left_semi").select("node").distinct())


def dense_pairs(sets: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """All pairs ``(a, b)`` of ``sets(node, shingles)`` with different roots that may be linked.

    Of two sets of n and m elements that have at least o in common, the n - o + 1 first of the one and the m - o + 1
    first of the other have one in common, whatever order all elements are in. Here the rarest come first, by counts
    of hashed shingles. The first common one, at places i and j, leaves at most min(n - i, m - j) more.
    """

    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            total += np.bincount((flat % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "k"])

    counted = sets.select("shingles").mapInArrow(count, "bucket long, k long").groupBy("bucket").agg(F.sum("k").alias("k"))
    table = counted.toArrow()  # at most BUCKETS rows
    often = np.zeros(BUCKETS, dtype=np.int64)
    often[table.column(0).to_numpy()] = table.column(1).to_numpy()

    def rarest(batches):
        for batch in batches:
            node, root = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ends = np.cumsum([0] + [len(x) for x in batch.column(2)])
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at, out = 0, [[], [], [], [], []]
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                own, n = flat[a:b], int(b - a)
                take = n - -(-n * percent // 100) + 1
                order = np.lexsort((own, often[(own % np.uint64(BUCKETS)).astype(np.int64)]))[:take]
                out[0].append(own[order].view(np.int64))
                out[1].append(np.arange(1, take + 1, dtype=np.int32))
                out[2].append(np.full(take, n, dtype=np.int32))
                out[3] += [node[i]] * take
                out[4] += [root[i]] * take
                at += take
                if at >= AT_ONCE // 8 or i == len(node) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.concatenate(x)) for x in out[:3]), *(pa.array(x, pa.binary()) for x in out[3:])],
                        ["h", "place", "n", "node", "root"])
                    at, out = 0, [[], [], [], [], []]

    placed = sets.join(rooted, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "shingles")
    rows = materialise(placed.mapInArrow(rarest, "h long, place int, n int, node binary, root binary"))
    # shingles of one component's nodes alone link nothing new
    mixed = materialise(rows.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("h"))
    rows = materialise(rows.join(small(mixed, 16), "h", "left_semi"))
    one = rows.select("h", *[F.col(c).alias(f"{c}1") for c in ("place", "n", "node", "root")])
    two = rows.select("h", *[F.col(c).alias(f"{c}2") for c in ("place", "n", "node", "root")])
    common = F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) + 1
    both = one.join(two, "h").where((F.col("node1") < F.col("node2")) & (F.col("root1") != F.col("root2"))).where(
        common * (100 + percent) >= (F.col("n1") + F.col("n2")).cast("long") * percent)
    return materialise(both.select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct())


def classes(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id, th, n, component, root)`` of every row: hash of the text, set size, the least id reachable by links, and the
    component's least node, null for the empty set."""
    spark = docs.sparkSession
    # signatures are most of what is stored: they lie there once, and until the trees are built
    whole = materialise(sign(docs, id_col, text_col, size))
    nodes = materialise(whole.where("node is not null").select("node", "signature").dropDuplicates(["node"]))
    signed = materialise(whole.select("id", "th", "n", "node"))
    discard(whole)
    repeated = not signed.groupBy("id", "th").agg(F.count("*").alias("k")).where("k > 1").isEmpty()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)

    def candidates(nodes: DataFrame, trees: range) -> DataFrame:
        return materialise(neighbours(tree_rows(nodes, trees), partitions, nearest=0 in trees))

    def pairs(found: DataFrame, what: int) -> DataFrame:
        return materialise(found.where(F.col("what") == what).select("a", "b").distinct())

    def sets_for(pairs: DataFrame) -> DataFrame:
        return full_sets(docs, signed, pairs, size, id_col, text_col, repeated)

    def confirmed(found: DataFrame) -> DataFrame:
        sets = sets_for(found)
        done = materialise(compare(found, sets))
        discard(sets)
        return done

    # the nearest neighbours of a few trees connect most of every group; then all within reach are looked at, but only
    # for what joins different groups
    first = confirmed(pairs(candidates(nodes.withColumn("root", F.col("node")), range(FIRST)), 0))
    rooted = materialise(components(first.where(at_least(percent)).select("a", "b")))
    placed = nodes.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = candidates(placed, range(FIRST, TREES))
    discard(nodes)
    rest = confirmed(pairs(found, 0))
    rooted = materialise(components(rooted.select("node", "root").union(rest.where(at_least(percent)).select("a", "b"))))
    # seemingly connected ones that are not
    end = lambda side: rooted.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
    late = confirmed(materialise(pairs(found, 1).join(end("a"), "a", "left").join(end("b"), "b", "left").where(
        F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")))
    rooted = materialise(components(rooted.select("node", "root").union(late.where(at_least(percent)).select("a", "b"))))
    # what reach may have hidden in dense regions
    dense = dense_nodes(found.where("what = 2"), rooted)
    sets = sets_for(dense.select(F.col("node").alias("a"), F.col("node").alias("b")))
    dense_links = compare(dense_pairs(sets, rooted, percent), sets).where(at_least(percent)).select("a", "b")
    rooted = materialise(components(rooted.select("node", "root").union(dense_links)))
    discard(sets)
    near = materialise(first.union(rest).union(late).where(~at_least(percent) & at_least(percent - NEARLY)).select("a", "b"))
    asks = materialise(questions(near, rooted))
    both = asks.select("node").union(rooted.join(asks.select("root").distinct(), "root", "left_semi").select("node")).distinct()
    sets = sets_for(both.select(F.col("node").alias("a"), F.col("node").alias("b")))
    more = materialise(open_links(asks, rooted, sets, percent))
    discard(sets)
    rooted = materialise(components(rooted.select("node", "root").union(more)))
    members = signed.select("id", "th", "n", "node").join(rooted, "node", "left").select(
        "id", "th", "n", F.coalesce("root", "node").alias("root"))
    least = members.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return members.join(least, "root", "left").select("id", "th", "n", F.coalesce("least", "id").alias("component"), "root")


def full_sets(
    docs: DataFrame, signed: DataFrame, pairs: DataFrame, size: int, id_col: str, text_col: str, repeated: bool,
) -> DataFrame:
    """``(node, shingles)``: the full set of every node in ``pairs(a, b)``, from one document of each.

    Only where rows are ``repeated``, id and text, may a node have several, and sets have to be shuffled to keep one.
    """
    asked = pairs.select(F.col("a").alias("node")).distinct().union(pairs.select("b").distinct()).distinct()
    chosen = signed.where("node is not null").join(asked, "node").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("d"))
    chosen = materialise(chosen.select(F.col("d.id").alias("c_id"), F.col("d.th").alias("c_th")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    wanted = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")).join(
        small(chosen, 64), F.col("id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th")), "left_semi")

    def make():
        give_back()

        def work(texts: list[str]) -> list:
            sets = sets_of(texts, size)
            ends = np.cumsum([0] + [len(s) for s in sets])
            flat = pa.array(np.concatenate(sets).view(np.int64))
            return [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)]
        return work

    sets = map_texts(wanted, [], "text", "node binary, shingles array<bigint>", make)
    return materialise(sets.dropDuplicates(["node"]) if repeated else sets)


def deduplicate(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with one document of each component, that of the least id, then of the least text hash; of repeated rows
    one stays.

    Documents with the empty set all stay, but for repeated rows. Documents of one id with different texts, and those
    without an id, stay or go each for itself.
    """
    found = materialise(classes(docs, size, percent, id_col, text_col))
    # the row that stays of each component
    first = materialise(found.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("d")).select(
            "root", F.col("d.id").alias("c_id"), F.col("d.th").alias("c_th")))
    kept = found.join(first, "root", "left").withColumn("stays", F.col("root").isNull() | (
        F.col("id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th"))))
    gone = materialise(kept.where("not stays").select(F.col("id").alias("g_id"), F.col("th").alias("g_th")).distinct())
    text = F.coalesce(docs[text_col], F.lit(""))
    same = lambda i, t: docs[id_col].eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(t))
    out = docs.join(small(gone, 64), same("g_id", "g_th"), "left_anti")
    again = materialise(kept.where("stays").groupBy("id", "th").agg(F.count("*").alias("k")).where("k > 1").select(
        F.col("id").alias("g_id"), F.col("th").alias("g_th")))
    if again.isEmpty():
        return out
    # rows that stay and stand there several times: one of each
    some = out.join(small(again, 64), same("g_id", "g_th"), "left_semi").dropDuplicates([id_col, text_col])
    return out.join(small(again, 64), same("g_id", "g_th"), "left_anti").unionByName(some)
