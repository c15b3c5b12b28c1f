"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, replaces letters of other scripts and styles by the Latin letters they look like, and digits and
signs by the letters they stand in for (``1d10t``). Accents stay, as they tell words apart. The folded text's words are
matched against lexicon entries, which are whole words or beginnings of words; a match inside an exception phrase does
not count. The weights found are normalised by the text's length and turned into a score.

Lexicon, exceptions and score weights are learned from labelled rows, at most about ``SAMPLE`` of each label (chosen by a
hash); scoring covers every row and whole texts. Support is counted in distinct surroundings (word before, word
behind), so copies of one text count once.

Defined cases: null and empty texts have no words and get the score of a text without matches; without labels of both
kinds the lexicon is empty and every score is the share of toxic labels, 0.5 if there is none; null labels are not
learned from, and of several labels of one id the highest holds; a null id counts as the empty text; repeated rows are
scored row by row; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import map_texts

# Letters that look like Latin ones.
LOOKALIKES = {
    "a": "аαɑ", "b": "вьƅ", "c": "сϲ", "d": "ԁɗ", "e": "еєҽ", "f": "ƒ", "g": "ɡց", "h": "нһհ", "i": "іιıɩ", "j": "јϳ",
    "k": "кκ", "l": "ӏⅼ", "m": "мⅿ", "n": "пη", "o": "оοօσ", "p": "рρ", "q": "ԛզ", "r": "гɾ", "s": "ѕꜱ", "t": "тτ",
    "u": "υսц", "v": "νѵ", "w": "ѡωш", "x": "хχ", "y": "уγү", "z": "ᴢʐ",
}
# Digits and signs written for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "|": "l"}

SAMPLE = 6000
#: Distinct surroundings that an entry needs among toxic texts at least, and their least share among all its surroundings.
SUPPORT, PURITY = 4, 0.9
SHORTEST, LONGEST = 4, 12
WORD = re.compile(r"[^\W\d_]+")


class Folds(dict):
    """Character table for ``str.translate`` that works out styled letters when they occur."""

    def __init__(self):
        super().__init__({ord(c): latin for latin, others in LOOKALIKES.items() for c in others})
        self.update((ord(c), latin) for c, latin in STAND_INS.items())

    def __missing__(self, code: int) -> str:
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c).lower() if code > 0x24F else c
        plain = plain if len(plain) == 1 else c
        self[code] = self.get(ord(plain), plain)
        return self[code]


def folder():
    """A function from a text to its folded words."""
    table = Folds()
    return lambda text: WORD.findall(text.lower().translate(table))


@dataclass
class Lexicon:
    """Entries: beginnings (``stem``) or whole words (``stem `` with a space behind) and their weights."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    #: bias, weight of the summed weights, weight of the sum per length
    score: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def matcher(self):
        """A function from folded words to the matches that count, as (place, entry)."""
        automaton = ahocorasick.Automaton()
        for phrase in self.exceptions:
            automaton.add_word(f" {phrase} ", (False, len(phrase) + 2, phrase))
        for entry in self.weights:
            automaton.add_word(f" {entry}", (True, len(entry) + 1, entry))
        if not len(automaton):
            return lambda words: []
        automaton.make_automaton()

        def find(words: list[str]) -> list[tuple[int, str]]:
            line = " " + " ".join(words) + " "
            hits, safe = [], []
            for end, (counts, size, entry) in automaton.iter(line):
                if counts:
                    hits.append((end - size + 1, entry))
                else:
                    safe.append((end - size + 1, end))
            if safe:
                hits = [h for h in hits if not any(a <= h[0] < b for a, b in safe)]
            return hits

        return find


def features(total, words):
    """What the score is made of: the summed weight, and that sum per length, both damped."""
    total, words = np.asarray(total, dtype=float), np.asarray(words, dtype=float)
    return np.log1p(total), np.log1p(total / np.log2(2.0 + words))


def held_out(id_col: str) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """``(y, text)`` of labelled rows that may be learned from, about ``most`` of each label at most."""
    marks = (labels.where(F.col(label_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    marks = materialise(marks)
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, min(1.0, most / n)).otherwise(share)
    picked = marks.where(F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 20)) < share * (1 << 20))
    # the picked ids are bounded by the sample, so texts need not move
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "_id")
    return materialise(rows.select("y", F.coalesce("text", F.lit("")).alias("text")).distinct())


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE, support: int = SUPPORT, purity: float = PURITY,
) -> Lexicon:
    """Learn entries, exception phrases and score weights from rows that are not held out."""
    rows = sample_of(docs, labels, id_col, text_col, label_col, sample)
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    share = (bad + 0.5) / (bad + good + 1.0)
    prior = Lexicon(score=(float(np.log(share / (1 - share))), 0.0, 0.0))
    if not bad or not good:
        return prior

    def folded():
        fold = folder()
        return lambda texts: [[fold(t) for t in texts]]

    words = materialise(map_texts(rows, ["y"], "text", "w array<string>", folded))
    at = words.select("y", "w", F.posexplode("w").alias("p", "word"))
    near = F.xxhash64(F.coalesce(F.try_element_at("w", F.when(F.col("p") > 0, F.col("p"))), F.lit("")),
                      F.coalesce(F.try_element_at("w", F.col("p") + 2), F.lit("")))
    places = at.select("word", near.alias("near"), "y").groupBy("word", "near").agg(F.max("y").alias("y"))
    per_word = materialise(places.groupBy("word").agg(
        F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")))
    stems = F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda k: F.when(
        F.length("word") >= k, F.substring(F.col("word"), F.lit(1), k)))
    entries = F.concat(F.array(F.concat("word", F.lit(" "))), F.array_compact(stems))
    totals = per_word.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("n")).first()
    if not totals["bad"] or not totals["good"]:
        return prior
    # so much support that chance alone gives hardly any entry among all words
    chance = totals["bad"] / (totals["bad"] + totals["good"])
    least = max(support, int(np.ceil(np.log(100.0 * totals["n"]) / -np.log(chance))))
    table = (per_word.select(F.explode(entries).alias("entry"), "bad", "good").groupBy("entry")
             .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .where((F.col("bad") >= least) & (F.col("bad") >= purity * (F.col("bad") + F.col("good")))))
    found = {r["entry"]: (r["bad"], r["good"]) for r in table.collect()}  # bounded by the sample
    lexicon = Lexicon(choose(found, totals["bad"], totals["good"]))
    lexicon.exceptions = exceptions_of(words, lexicon)
    lexicon.score = fit(words, lexicon, prior.score)
    return lexicon


def choose(found: dict[str, tuple[int, int]], bad: int, good: int) -> dict[str, float]:
    """Entries with log-odds weights: of each chain of ever longer entries, the longest that keeps nearly all support."""
    ruled, weights = set(), {}
    for entry in sorted(found, key=lambda e: (len(e), e)):
        if any(entry[:k] in ruled for k in range(1, len(entry))):
            continue
        best = entry
        while True:  # one step longer, as long as hardly any surroundings are lost
            longer = [e for e in found if len(e) == len(best) + 1 and e.startswith(best)]
            top = max(longer, key=lambda e: (found[e][0], e), default=None)
            if top is None or found[top][0] < 0.95 * found[best][0]:
                break
            best = top
        if best == entry or found[best][0] >= 0.95 * found[entry][0]:
            ruled.add(entry)
        b, g = found[best]
        weights[best] = round(float(np.log((b + 0.5) / (bad + 1.0)) - np.log((g + 0.5) / (good + 1.0))), 6)
    return {e: w for e, w in weights.items() if w > 0}


def exceptions_of(words: DataFrame, lexicon: Lexicon) -> list[str]:
    """Phrases of one or two words around a match that occur in several clean texts and in no toxic one."""
    shared = words.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample

    def run(batches):
        import pyarrow as pa

        find = shared.value.matcher()
        for batch in batches:
            ys, phrases = [], []
            for y, ws in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts, at = {}, 0
                for i, w in enumerate(ws):
                    starts[at] = i
                    at += len(w) + 1
                own = set()
                for place, _ in find(ws):
                    i = starts[place]
                    own |= {ws[i], " ".join(ws[i:i + 2]), " ".join(ws[max(0, i - 1):i + 1])}
                ys += [y] * len(own)
                phrases += own
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(phrases, pa.string())], ["y", "phrase"])

    seen = words.select("y", "w").mapInArrow(run, "y int, phrase string")
    table = seen.groupBy("phrase").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    kept = table.where("bad = 0 and good >= 2").collect()  # bounded by the sample
    return sorted(r["phrase"] for r in kept)


def weigh(words: DataFrame, id_cols: list[str], lexicon: Lexicon) -> DataFrame:
    """``id_cols``, ``total`` weight and ``n`` words of each row of folded words."""
    shared = words.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        import pyarrow as pa

        find, weights = shared.value.matcher(), shared.value.weights
        for batch in batches:
            rows = batch.column(len(id_cols)).to_pylist()
            total = [sum(weights[e] for _, e in find(ws)) for ws in rows]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(id_cols))], pa.array(total, pa.float64()),
                 pa.array([len(ws) for ws in rows], pa.int64())], [*id_cols, "total", "n"])

    schema = ", ".join(f"{c} {words.schema[c].dataType.simpleString()}" for c in id_cols)
    return words.select(*id_cols, "w").mapInArrow(run, f"{schema}, total double, n long")


def fit(words: DataFrame, lexicon: Lexicon, start: tuple[float, float, float]) -> tuple[float, float, float]:
    """Logistic regression of the labels on the two features, by Newton steps with a small penalty."""
    rows = weigh(words, ["y"], lexicon).select("y", "total", "n").toPandas()  # three numbers a sampled row
    x = np.column_stack([np.ones(len(rows)), *features(rows["total"], rows["n"])])
    y = rows["y"].to_numpy(dtype=float)
    w, penalty = np.array(start), np.diag([1e-6, 0.05, 0.05])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(3),
                               x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols``, ``score`` (0 to 1), ``n_matches`` and ``matches`` (sorted distinct entries) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample it was learned from

    def make():
        lexicon = shared.value
        fold, find, weights, (bias, a, b) = folder(), lexicon.matcher(), lexicon.weights, lexicon.score

        def work(texts: list[str]) -> list:
            sizes, totals, hits = [], [], []
            for text in texts:
                words = fold(text)
                found = find(words)
                sizes.append(len(words))
                totals.append(sum(weights[e] for _, e in found))
                hits.append([e for _, e in found])
            x, y = features(totals, sizes)
            z = np.clip(bias + a * x + b * y, -500, 500)
            return [1 / (1 + np.exp(-z)), [len(h) for h in hits], [sorted({e.strip() for e in h}) for h in hits]]

        return work

    return map_texts(docs, id_cols, text_col, "score double, n_matches int, matches array<string>", make)


def reject(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", limit: float = 0.7) -> DataFrame:
    """``docs`` without those whose score reaches ``limit``; columns and other rows stay as they are."""
    # numbered columns cannot clash with those of the score
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = score(plain, lexicon, plain.columns, f"c{docs.columns.index(text_col)}")
    return scored.where(F.col("score") < limit).select(*plain.columns).toDF(*docs.columns)
