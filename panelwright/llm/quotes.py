"""Quoted passages linked to the messages they are from, and conversations in reply order without quotes.

Lines that start with ``>`` signs are quotes, as deep as there are signs; a line that announces a quote ("... wrote:") goes
with it. Neighbouring lines of one depth are a passage, whose sentences are normalised (case, white space, signs) and
hashed, so lines may be wrapped anew. The hashes are joined to the own sentences of earlier messages of the conversation;
each finds the latest one. A message replies to the message that most of its least deep linked quotes are from.

Replies are followed up to the message that starts the thread. A conversation in order has its threads by their first
message, and in each thread messages by depth and turn, so that what is replied to stands before the reply.

Joins are on conversation and hash; only hashes that are quoted take part. Turns are worked on in ranges, so one
conversation with very many messages, or one very common sentence in it, is spread over tasks.

Defined cases: null and empty texts have no quotes and nothing of their own; a message of only quotes gets the empty text;
messages without a linked quote start a thread; rows with a null conversation or turn are not linked and start their own
threads; of rows with the same conversation and turn the quotes are put together; quotes of later messages or of the
message itself do not link; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import map_texts

MARK = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
# Ends of lines that announce a quote.
ANNOUNCES = re.compile(r"(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.IGNORECASE)
SENTENCE = re.compile(r"[.!?…]+(?:\s+|$)")
PLAIN = re.compile(r"[\W_]+")
#: Turns of a range.
RANGE = 1024


def depth_of(line: str) -> tuple[int, str]:
    """How deep a line is quoted, and the line without its signs."""
    found = MARK.match(line)
    return (found.group(1).count(">"), line[found.end():]) if found else (0, line)


def sentences_of(lines: list[str]) -> list[str]:
    """Normalised sentences of a passage, however its lines are wrapped."""
    parts = (PLAIN.sub(" ", s).strip().lower() for s in SENTENCE.split(" ".join(lines)))
    return [p for p in parts if p]


def hash_of(sentence: str) -> int:
    return int.from_bytes(hashlib.blake2b(sentence.encode(), digest_size=8).digest(), "big", signed=True)


def parse(text: str) -> tuple[str, list[str], list[tuple[int, list[str]]]]:
    """A message's own text, its own sentences, and its quoted passages as depth and sentences."""
    if ">" not in text:
        return text, sentences_of(text.split("\n")), []
    lines = [depth_of(line) for line in text.split("\n")]
    runs: list[tuple[int, list[str]]] = []
    for i, (depth, line) in enumerate(lines):
        if not depth and i + 1 < len(lines) and lines[i + 1][0] and ANNOUNCES.search(line):
            continue
        if depth and not line.strip() and runs and runs[-1][0] == depth:
            continue  # an empty quoted line parts nothing
        if runs and runs[-1][0] == depth:
            runs[-1][1].append(line)
        else:
            runs.append((depth, [line]))
    own = [line for depth, part in runs if not depth for line in part]
    kept = re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip("\n") if any(d for d, _ in runs) else text
    quoted = [(depth, found) for depth, part in runs if depth and (found := sentences_of(part))]
    return kept, [s for depth, part in runs if not depth for s in sentences_of(part)], quoted


def parsed(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, turn, role, own_text, own, quoted)`` of every row; sentences as hashes, with sizes for quotes."""

    def make():
        def work(texts: list[str]) -> list:
            kept, own, quoted = [], [], []
            for text in texts:
                rest, mine, quotes = parse(text)
                kept.append(rest)
                own.append(sorted({hash_of(s) for s in mine}))
                quoted.append([{"depth": d, "hash": hash_of(s), "size": len(s)} for d, ss in quotes for s in ss])
            return [kept, own, quoted]
        return work

    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                           F.col(text_col).alias("text"))
    return map_texts(rows, ["conv", "turn", "role"], "text",
                     "own_text string, own array<bigint>, quoted array<struct<depth:int,hash:bigint,size:int>>", make)


def sources(rows: DataFrame) -> DataFrame:
    """``(conv, turn, depth, source, size)``: for each quoted sentence the latest earlier message that has it as its own."""
    rows = rows.where("conv is not null and turn is not null")
    asks = rows.select("conv", "turn", F.explode("quoted").alias("q")).select("conv", "turn", "q.*").distinct()
    asked = asks.select("conv", "hash").distinct()
    own = rows.select("conv", "turn", F.explode("own").alias("hash")).distinct().join(asked, ["conv", "hash"], "left_semi")
    none = F.lit(None)
    both = own.select("conv", "hash", "turn", none.cast("int").alias("depth"), none.cast("int").alias("size")).unionByName(
        asks.select("conv", "hash", "turn", "depth", "size")).withColumn("range", F.floor(F.col("turn") / RANGE))
    both = materialise(both)
    has = F.when(F.col("depth").isNull(), F.col("turn"))
    # within a range of turns, then over the ranges
    inside = Window.partitionBy("conv", "hash", "range").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("conv", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    lasts = both.groupBy("conv", "hash", "range").agg(F.max(has).alias("last")).withColumn("before", F.max("last").over(over))
    found = both.withColumn("near", F.max(has).over(inside)).where("depth is not null").join(
        lasts.select("conv", "hash", "range", "before"), ["conv", "hash", "range"])
    source = F.coalesce("near", "before")
    return found.where(source.isNotNull()).select("conv", "turn", "depth", source.alias("source"), "size")


def parents(found: DataFrame) -> DataFrame:
    """``(conv, turn, parent, n_linked)``: the source of most characters among the least deep linked quotes."""
    votes = found.groupBy("conv", "turn", "depth", "source").agg(F.sum("size").alias("size"), F.count("*").alias("k"))
    return votes.groupBy("conv", "turn").agg(
        F.max(F.struct(-F.col("depth"), "size", "source")).alias("best"), F.sum("k").alias("n_linked")).select(
            "conv", "turn", F.col("best.source").alias("parent"), "n_linked")


def threads(links: DataFrame) -> DataFrame:
    """``(conv, turn, thread, depth)`` of every reply, by doubling the steps up until all have reached a start."""
    state = materialise(links.select("conv", "turn", F.col("parent").alias("up"), F.lit(1).alias("depth")))
    while True:
        above = state.select("conv", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        state = materialise(state.join(above, ["conv", "up"], "left").select(
            "conv", "turn", F.coalesce("up2", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("up2").isNotNull().alias("moved")))
        if state.where("moved").isEmpty():
            return state.select("conv", "turn", F.col("up").alias("thread"), "depth")
        state = state.drop("moved")


def reply_order(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per message: ``(conv_col, turn_col, role_col, text, n_quotes, n_linked, reply_to, thread, depth)``.

    ``text`` is without quotes. Sorted by conversation, thread, depth and turn over all partitions.
    """
    rows = materialise(parsed(messages, conv_col, turn_col, role_col, text_col).withColumn("n_quotes", F.size("quoted")))
    links = materialise(parents(sources(rows)))
    placed = threads(links)
    at = lambda df, c: df.select(F.struct("conv", "turn", *[x for x in df.columns if x not in ("conv", "turn")]).alias(c))
    same = lambda c: (F.col("conv") == F.col(f"{c}.conv")) & (F.col("turn") == F.col(f"{c}.turn"))
    out = rows.join(at(links, "_l"), same("_l"), "left").join(at(placed, "_p"), same("_p"), "left")
    out = out.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("own_text").alias("text"), "n_quotes",
        F.coalesce("_l.n_linked", F.lit(0)).cast("int").alias("n_linked"), F.col("_l.parent").alias("reply_to"),
        F.coalesce("_p.thread", "turn").alias("thread"), F.coalesce("_p.depth", F.lit(0)).alias("depth"))
    order = [conv_col, "thread", "depth", turn_col]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
