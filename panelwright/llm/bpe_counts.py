"""Token counts of byte-level BPE vocabularies by merging with a heap and a linked list.

A text is cut at the vocabulary's added tokens, each of which counts one, and the rest into pre-tokens. In a
pre-token every byte is a symbol in a doubly linked list; a heap holds its adjacent pairs by rank and place.
The lowest pair is popped and merged until none is left, so the count is symbols minus merges. No token
identifier is looked up or emitted.

Pre-tokens repeat, so each worker process remembers counts; the memory is emptied at ``MEMORY`` entries and holds no
pre-token of more than ``LONG`` characters, which bounds it without changing any count.

Defined cases: null and empty texts have 0 bytes and 0 tokens; a text of any length is one piece of work for
one task, in time n log n of its longest pre-token; repeated rows and ids are counted row by row; other columns
are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_texts

#: Fixed pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMORY, LONG = 800_000, 64
#: For a pair of symbols, ``left << 32 | right``: its rank and the symbol it becomes. Bytes are symbols 0 to 255.
Merges = dict[int, tuple[int, int]]


def printable_bytes() -> dict[str, int]:
    """Characters that stand for bytes in the vocabulary file: printable Latin-1 as itself, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[Merges, list[str]]:
    """Mergeable pairs and added tokens of a tokenizer file; ValueError if it works otherwise."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not (spec.get("normalizer") or model.get("dropout") or model.get("continuing_subword_prefix")
                 or model.get("end_of_word_suffix") or model.get("ignore_merges") or before.get("add_prefix_space"))
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or not plain:
        raise ValueError("only byte-level BPE without normalizer, prefix or suffix marks is supported")
    added = spec.get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError("added tokens that take in their surroundings are not supported")
    symbol = printable_bytes()
    merges: Merges = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made = symbol.setdefault(left + right, len(symbol))
        merges[symbol[left] << 32 | symbol[right]] = rank, made
    return merges, [t["content"] for t in added if t["content"]]


def merged_count(text: bytes, merges: Merges) -> int:
    """Symbols left when the lowest-rank adjacent pair, the leftmost of equals, has been merged until none is left."""
    n = count = len(text)
    if n < 2:
        return n
    at, find = list(text), merges.get
    heap = []  # rank << 32 | place of the left symbol
    for i in range(n - 1):
        if (m := find(at[i] << 32 | at[i + 1])) is not None:
            heap.append(m[0] << 32 | i)
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        j = after[i]
        # stale if the left symbol is gone, or the pair that stands here now has another rank
        if j >= n or at[i] < 0 or (m := find(at[i] << 32 | at[j])) is None or m[0] != entry >> 32:
            continue
        count -= 1
        at[i], at[j] = made, _ = m[1], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (m := find(made << 32 | at[k])) is not None:
                heappush(heap, m[0] << 32 | i)
        p = before[i]
        if p >= 0 and (m := find(at[p] << 32 | made)) is not None:
            heappush(heap, m[0] << 32 | p)
    return count


def text_counter(merges: Merges, added: list[str], known: dict[str, int]) -> Callable[[str], int]:
    """A function from a text to its number of tokens; ``known`` is the memory of counts."""
    pretokens = regex.compile(PATTERN).findall
    marks = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

    def count(text: str) -> int:
        parts = [text]
        if marks is not None and any(t in text for t in added):
            parts = marks.split(text)
        total = len(parts) - 1
        for part in parts:
            found = pretokens(part)
            try:
                total += sum(map(known.__getitem__, found))
                continue
            except KeyError:
                pass
            for word in found:
                n = known.get(word)
                if n is None:
                    n = merged_count(word.encode(), merges)
                    if len(word) <= LONG:
                        if len(known) >= MEMORY:
                            known.clear()
                        known[word] = n
                total += n
        return total

    return count


def count_tokens(
    docs: DataFrame, tokenizer_file: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` of every row. The file is read by the driver alone."""
    # as large as the vocabulary; a worker process keeps its copy, and so the memory in it, from task to task
    shared = docs.sparkSession.sparkContext.broadcast((*read_vocabulary(tokenizer_file), {}))

    def make():
        count = text_counter(*shared.value)
        return lambda texts: [[len(t.encode()) for t in texts], [count(t) for t in texts]]

    out = map_texts(docs, [id_col], text_col, "n_bytes long, n_tokens long", make)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
