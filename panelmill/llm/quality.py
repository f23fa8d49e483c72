"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: one entry for each distinct hashed word, of equal weight and unit
length together, and one entry for each statistic, in the bin its value falls in. The score is
``sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``; the pairs are summed in linear
time as half of (square of sums minus sum of squares). It is fitted in numpy on a bounded sample
of labelled rows with Adagrad.

Defined cases: a null or empty text has no words and the lowest bins; a null ``n_chars`` counts
as the length of the text; with no row to learn from every score is 0.5; repeated rows get
equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from panelmill.llm.common import WordCache, map_texts, ngram_hashes, remembered, utf8
from panelmill.llm.rules import Text

#: Labelled rows of either label that the model is fitted on, about.
SAMPLE_ROWS = 1500
BUCKETS, BINS, RANK = 1 << 15, 8, 8
EPOCHS, BATCH, RATE = 8, 64, 0.08
THRESHOLD = 0.7

STATISTICS = ("n_words", "n_chars", "word_length", "symbols", "upper", "digits", "repeated", "distinct", "dup_lines", "line_words")
_DIGITS = b"0123456789"
_words = WordCache(xxhash.xxh64_intdigest)
remembered(_words.clear)


def statistics(text: Text, hashes: np.ndarray, n_chars: int | None) -> list[float]:
    n, size = max(1, text.n_words), max(1, len(text.text))
    triples = np.sort(ngram_hashes(hashes, 3))
    return [
        np.log1p(text.n_words),
        np.log1p(size if n_chars is None else max(0, n_chars)),
        text.word_chars / n,
        text.n_symbols / n,
        text.n_upper / max(1, text.n_upper + text.n_lower),
        text._count(_DIGITS) / size,
        float((triples[1:] == triples[:-1]).sum()) / n,
        len(np.unique(hashes)) / n,
        text.n_dup_lines / max(1, len(text.lines)),
        n / max(1, len(text.lines)),
    ]


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, list[float]]:
    """Distinct word buckets, and the statistics."""
    one = Text(text)
    hashes = _words.array(text.lower().split(), np.uint64)
    return np.unique(hashes % np.uint64(BUCKETS)).astype(np.int64), statistics(one, hashes, n_chars)


class FactorisationMachine:
    def __init__(self, edges: np.ndarray, seed: int = 7):
        size = BUCKETS + len(STATISTICS) * BINS
        self.edges = edges  # of the bins of each statistic
        self.w0, self.w = 0.0, np.zeros(size)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (size, RANK))

    def vector(self, words: np.ndarray, stats: list[float]) -> tuple[np.ndarray, np.ndarray]:
        bins = [BUCKETS + k * BINS + int(np.searchsorted(self.edges[k], x, "right")) for k, x in enumerate(stats)]
        values = np.full(len(words) + len(bins), 1.0)
        values[: len(words)] = 1.0 / np.sqrt(max(1, len(words)))
        return np.r_[words, bins].astype(np.int64), values

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        xv = self.v[at] * x[:, None]
        return self.w0 + float(self.w[at] @ x) + 0.5 * float((xv.sum(axis=0) ** 2).sum() - (xv**2).sum())

    def score(self, words: np.ndarray, stats: list[float]) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.margin(*self.vector(words, stats)), -30, 30))))

    def fit(self, vectors: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7) -> FactorisationMachine:
        rng = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)  # both labels count alike
        gw, gv, g0 = np.full(len(self.w), 1e-3), np.full(self.v.shape, 1e-3), 1e-3
        for _ in range(EPOCHS):
            for batch in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
                at = np.concatenate([vectors[i][0] for i in batch])
                x = np.concatenate([vectors[i][1] for i in batch])
                starts = np.cumsum([0, *(len(vectors[i][0]) for i in batch)])[:-1]
                rows = np.repeat(np.arange(len(batch)), np.diff(np.r_[starts, len(at)]))
                xv = self.v[at] * x[:, None]
                sums = np.add.reduceat(xv, starts)
                pairs = 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((xv**2).sum(axis=1), starts))
                margin = self.w0 + np.add.reduceat(self.w[at] * x, starts) + pairs
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch]) * weight[batch] / len(batch)
                dw = error[rows] * x
                dv = dw[:, None] * (sums[rows] - xv)
                used, place = np.unique(at, return_inverse=True)
                gradient = np.bincount(place, dw, len(used)) + 1e-5 * self.w[used]
                gw[used] += gradient**2
                self.w[used] -= RATE * gradient / np.sqrt(gw[used])
                for k in range(RANK):
                    gradient = np.bincount(place, dv[:, k], len(used)) + 1e-5 * self.v[used, k]
                    gv[used, k] += gradient**2
                    self.v[used, k] -= RATE * gradient / np.sqrt(gv[used, k])
                g0 += error.sum() ** 2
                self.w0 -= RATE * error.sum() / np.sqrt(g0)
        return self


def fit(rows: list) -> FactorisationMachine:
    """A model from rows with text, y (0 or 1) and n_chars."""
    found = [features(r["text"].encode(), r["n_chars"]) for r in rows]
    stats = np.array([f[1] for f in found]).reshape(len(found), len(STATISTICS))
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(stats, shares, axis=0).T if len(found) else np.zeros((len(STATISTICS), BINS - 1))
    model = FactorisationMachine(edges)
    if not rows:
        model.v[:] = 0.0
        return model
    return model.fit([model.vector(*f) for f in found], np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """doc_id and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            chars = rows.column("n_chars").to_pylist()
            scores = [sent.value.score(*features(t, n)) for t, n in zip(utf8(rows.column("text")), chars, strict=True)]
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

        return do

    return map_texts(docs.select("doc_id", "text", "n_chars"), work, "doc_id bigint, score double")
