"""Rows that every operator has to cope with."""

from __future__ import annotations

import random

WORDS = "ba be bi bo bu da de di do du ga ge gi go gu ka ke ki ko ku la le li lo lu ma me mi mo mu".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    some = [prose(rng, rng.randint(3, 60)) for _ in range(12)]
    return [None, "", " \t\n ", "a", "Ünïcödé ÄÖ 漢字 😀 é", *some, some[0], some[0], some[1] + " end",
            prose(rng, 40_000), "x" * 60_000, "<|endoftext|> > quoted\n> > deeper\nMail a.b@c.de, IP 10.1.2.3."]


#: Names that operators use inside, as columns of the input.
EXTRA = {"id": "x", "th": "y", "words": "z", "score": "s", "n": "1", "node": "n", "k": "2", "h": "3", "ids": "4",
         "n_words": "5", "spans": "6", "_text": "7", "lang_pred": "8", "component": "9", "kept": "q", "attempt": "0"}


def documents(spark, seed: int = 1, extra: bool = True):
    rows = [(i, t, None if i % 5 == 0 else "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts(seed))]
    rows += [rows[6], rows[6], (None, "no id here", "en", "s", 10), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        rows = [(*r, *EXTRA.values()) for r in rows]
        schema += "".join(f", `{c}` string" for c in EXTRA)
    return spark.createDataFrame(rows, schema)


def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
