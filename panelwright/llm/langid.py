"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of ``LENGTH``, the last one padded. Bytes are embedded, filters of widths 2, 3
and 4 run over each window, the largest response of each filter is kept, and a softmax layer turns these into
probabilities. A text's probabilities are the mean of its windows', weighted by how much of a window is text, so the
language of most of a mixed text wins.

The network is trained in numpy by the driver on windows of a sample of at most about ``SAMPLE`` labelled rows, the same
number of each language; prediction covers every row and all windows of its text. There the embeddings are folded into
the filters, so that a response is the sum of one or two table rows, found by byte pairs, for all windows at once.

Defined cases: null texts and texts without a letter are ``und`` with score 0; if there is nothing to learn from, every
text is; of equal probabilities the first language in alphabetical order wins; null languages are not learned from; a null
id counts as the empty text; repeated rows are predicted row by row; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import map_texts

LENGTH, DIMS, FILTERS, WIDTHS = 128, 8, 16, (2, 3, 4)
#: Rows learned from, and windows taken from each of them, at even distances over the text.
SAMPLE, PER_TEXT = 6000, 3
EPOCHS, BATCH, RATE = 5, 64, 0.01
#: Windows worked on at once.
BLOCK = 4096
UNKNOWN = "und"


def held_out(id_col: str) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, the text each is from, and how many of its bytes are text. An empty text has none."""
    counts = np.array([-(-len(t) // LENGTH) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(t.ljust(n * LENGTH, b"\0") for t, n in zip(texts, counts.tolist())), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    filled = np.full(len(owner), LENGTH, dtype=np.int64)
    some = counts > 0
    filled[np.cumsum(counts)[some] - 1] = np.array([len(t) for t in texts])[some] - (counts[some] - 1) * LENGTH
    return data.reshape(-1, LENGTH), owner, filled


@dataclass
class Network:
    """Languages and weights."""

    languages: list[str]
    embed: np.ndarray  # 256 x DIMS
    filters: list[np.ndarray]  # per width: width * DIMS x FILTERS
    bias: np.ndarray  # of all filters
    dense: np.ndarray  # filters x languages
    offset: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Per width: responses to the byte pair at 0, and to the byte or pair at 2, as table rows."""
        out = []
        for width, w in zip(WIDTHS, self.filters):
            one = [self.embed @ w[j * DIMS:(j + 1) * DIMS] for j in range(width)]
            pair = [(one[j][:, None, :] + one[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, width - 1, 2)]
            out.append(pair + ([one[-1]] if width % 2 else []))
        return out

    def predictor(self):
        """A function from windows to log probabilities, a row for each."""
        tables = self.tables()

        def block(windows: np.ndarray) -> np.ndarray:
            by_place = np.ascontiguousarray(windows.T).astype(np.int64)
            pairs = (by_place[:-1] << 8) | by_place[1:]
            best = []
            for width, parts in zip(WIDTHS, tables):
                top = None
                for j in range(LENGTH - width + 1):
                    r = parts[0].take(pairs[j], axis=0)
                    if len(parts) > 1:
                        r += parts[1].take(by_place[j + 2] if width % 2 else pairs[j + 2], axis=0)
                    top = r if top is None else np.maximum(top, r, out=top)
                best.append(top)
            hidden = np.maximum(np.concatenate(best, axis=1) + self.bias, 0)
            z = hidden @ self.dense + self.offset
            z -= z.max(axis=1, keepdims=True)
            return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

        def predict(windows: np.ndarray) -> np.ndarray:
            return np.concatenate([block(windows[i:i + BLOCK]) for i in range(0, len(windows), BLOCK)])

        return predict


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam over shuffled batches; some windows are shortened, so that short texts are learned as well."""
    rng = np.random.default_rng(seed)
    n_lang, n = len(languages), len(windows)
    params = [rng.normal(0, 0.5, (256, DIMS))]
    params += [rng.normal(0, (w * DIMS) ** -0.5, (w * DIMS, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n_lang)), np.zeros(n_lang)]
    params = [p.astype(np.float32) for p in params]
    means, squares, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        for pick in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            x = windows[pick].copy()
            short = rng.random(len(pick)) < 0.25
            x[short[:, None] & (np.arange(LENGTH) >= rng.integers(8, LENGTH, len(pick))[:, None])] = 0
            embed, filters, (bias, dense, offset) = params[0], params[1:-3], params[-3:]
            e = embed[x]
            flat, tops, where = [], [], []
            for width, w in zip(WIDTHS, filters):
                m = LENGTH - width + 1
                cols = np.concatenate([e[:, j:j + m] for j in range(width)], axis=2)
                r = (cols.reshape(-1, width * DIMS) @ w).reshape(len(pick), m, FILTERS)
                at = r.argmax(axis=1)
                tops.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0])
                flat.append(cols)
                where.append(at)
            raw = np.concatenate(tops, axis=1) + bias
            hidden = np.maximum(raw, 0)
            z = hidden @ dense + offset
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(pick)), labels[pick]] -= 1
            z /= len(pick)
            back = (z @ dense.T) * (raw > 0)
            d_embed, d_filters = np.zeros_like(embed), []
            for k, (width, w) in enumerate(zip(WIDTHS, filters)):
                d = back[:, k * FILTERS:(k + 1) * FILTERS]
                seen = flat[k][np.arange(len(pick))[:, None], where[k]]  # what each filter answered to most
                d_filters.append(np.einsum("bf,bfc->cf", d, seen))
                d_seen = d[:, :, None] * w.T[None]
                for j in range(width):
                    np.add.at(d_embed, x[np.arange(len(pick))[:, None], where[k] + j],
                              d_seen[:, :, j * DIMS:(j + 1) * DIMS])
            grads = [d_embed, *d_filters, back.sum(axis=0), hidden.T @ z, z.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):
                means[i] = 0.9 * means[i] + 0.1 * g
                squares[i] = 0.999 * squares[i] + 0.001 * g * g
                rate = RATE * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
                params[i] = (params[i] - rate * means[i] / (np.sqrt(squares[i]) + 1e-8)).astype(np.float32)
    return Network(languages, params[0], params[1:-3], *params[-3:])


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
) -> Network | None:
    """Train on about ``sample`` rows at most that are not held out; None if there are none."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col)).agg(F.count("*")).collect()}  # a row for each language
    if not sizes:
        return None
    languages = sorted(sizes)
    most = max(1, sample // len(languages))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang_col) == name, min(1.0, most / n)).otherwise(share)
    picked = rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 20)) < share * (1 << 20))

    def windows():
        def work(texts: list[str]) -> list:
            out = []
            for t in texts:
                data = t.encode()
                last = max(0, len(data) - LENGTH)
                starts = sorted({last * i // max(1, PER_TEXT - 1) for i in range(PER_TEXT)})
                out.append([data[s:s + LENGTH] for s in starts])
            return [out]
        return work

    found = materialise(map_texts(picked.select(F.col(lang_col).alias("y"), F.col(text_col).alias("text")), ["y"], "text",
                                  "windows array<binary>", windows)).collect()  # at most PER_TEXT windows a sampled row
    # the order in which partitions arrive must not matter
    pairs = sorted((bytes(w), r["y"]) for r in found for w in r["windows"] if w)
    if not pairs:
        return None
    number = {name: i for i, name in enumerate(languages)}
    x = np.frombuffer(b"".join(w.ljust(LENGTH, b"\0") for w, _ in pairs), dtype=np.uint8).reshape(-1, LENGTH)
    return train(x, np.array([number[y] for _, y in pairs]), languages)


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand numbers

    def make():
        network = shared.value
        run = network.predictor() if network else None

        def work(texts: list[str]) -> list:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if run else []
            if known:
                windows, owner, filled = cut([texts[i].encode() for i in known])
                part = np.exp(run(windows).astype(np.float64)) * filled[:, None]
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                mean = np.add.reduceat(part, first, axis=0)
                mean /= mean.sum(axis=1, keepdims=True)
                best = mean.argmax(axis=1)
                scores[known] = mean[np.arange(len(best)), best]
                for i, b in zip(known, best.tolist()):
                    names[i] = network.languages[b]
            return [pa.array(names), pa.array(np.clip(scores, 0.0, 1.0))]

        return work

    return map_texts(docs, [id_col], text_col, "lang_pred string, score double", make)
