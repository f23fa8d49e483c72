"""Toxicity: bags of subword embeddings, averaged into a linear softmax and trained jointly.

A word is the mean of the vectors of its hashed character n-grams, taken between marks of its
ends, and of itself, so a misspelt word shares most of its vectors with the right one. A window of
words is the mean of its words; its class is a softmax over a linear layer. A text scores as its
most toxic window, so a short passage in a long text isn't averaged away.

Labels hold for texts, not windows. Training starts with the windows of each text whose words are
most over-represented in toxic texts, and then goes on with the most toxic windows under the model so
far, against the top and some other windows of texts that aren't toxic. At the end the margin of the top window is turned into
log odds of the text. As the layer is linear, the model of a task is one number for each n-gram
bucket. Defined cases: a text without words, or null, scores as an empty window; with no row
to learn from every score is 0.5; repeated rows get equal scores.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from panelmill.llm.common import CACHE_BYTES, Numbered, byte_matrix, map_texts, mix64, remembered, utf8

#: Labelled rows of either label that the model is fitted on, about.
SAMPLE_ROWS = 1500
BUCKETS, DIM, WINDOW = 1 << 17, 8, 12
SIZES = (3, 4, 5)
BATCH, RATE = 128, 0.15
#: Epochs at least, steps at least (a small sample needs more epochs), and the share of epochs on over-represented words.
EPOCHS, STEPS, WARM_SHARE = 10, 500, 0.5
#: Windows of a text in an epoch: about over-represented words, and at random where it isn't toxic.
WINDOWS = 5
THRESHOLD = 0.3
_MOST_WORDS = 600_000
_LETTER = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c in b"@$!*" else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_LETTER).split()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, and where each word's begin."""
    counts = np.array([1 + sum(max(0, len(w) + 3 - n) for n in SIZES) for w in words], np.int64).reshape(-1)
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.int64)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    out[starts] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) >> shift
    for where, codes in byte_matrix(words):
        codes = np.pad(codes, ((0, 0), (1, 1)), constant_values=0).astype(np.uint64) + np.uint64(1)
        place = starts[where] + 1
        for n in SIZES:
            wide = codes.shape[1] - n + 1
            if wide < 1:
                continue
            h = np.full((len(codes), wide), np.uint64(n))
            with np.errstate(over="ignore"):
                for k in range(n):
                    h = (h ^ codes[:, k : k + wide]) * np.uint64(0x9E3779B97F4A7C15)
            out[place[:, None] + np.arange(wide)] = mix64(h) >> shift
            place = place + wide
    return out, starts


class SubwordBag:
    """Vectors of the buckets, and the linear layer of two classes."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.1, (BUCKETS, DIM))
        self.layer = rng.normal(0, 0.1, (DIM, 2))
        self.bias = np.zeros(2)
        self.scale, self.shift = 1.0, 0.0  # from the top window's margin to a text's log odds

    def word_logits(self, words: list[bytes]) -> np.ndarray:
        """The part of a word in the difference of the two classes."""
        if not words:
            return np.zeros(0)
        each = self.vectors @ (self.layer[:, 1] - self.layer[:, 0])
        buckets, starts = subwords(words)
        counts = np.diff(np.r_[starts, len(buckets)])
        return np.add.reduceat(each[buckets], starts) / counts

    def fit(self, texts: list[list[bytes]], y: np.ndarray, seed: int = 7) -> SubwordBag:
        rng, known = np.random.default_rng(seed), Numbered()
        ids = [known.of(words) for words in texts]
        buckets, starts = subwords(list(known))
        counts = np.diff(np.r_[starts, len(buckets)])
        common, marked = word_contrast(ids, y, len(known))
        # n-grams of words of one text only can't be told from chance: they stay out
        used = np.zeros(BUCKETS, bool)
        used[buckets[np.repeat(common, counts)]] = True
        self.vectors[~used] = 0.0
        seen_v, seen_l, seen_b = np.where(used[:, None], 1e-4, np.inf) * np.ones(DIM), np.full((DIM, 2), 1e-4), np.full(2, 1e-4)
        epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, WINDOWS * len(ids))))
        for epoch in range(epochs):
            warm = epoch < WARM_SHARE * epochs
            z = marked if warm else self._word_part(buckets, starts, counts)
            windows, labels = [], []
            for one, label in zip(ids, y, strict=True):
                if not len(one):
                    continue
                ends = max(1, len(one) - WINDOW + 1)
                means = window_means(one, z)
                if not label:
                    more = rng.integers(0, ends, WINDOWS)
                elif warm:
                    about = rng.permutation(np.flatnonzero(z[one]))[:WINDOWS]
                    more = np.clip(about - rng.integers(0, WINDOW, len(about)), 0, ends - 1)
                else:
                    more = []
                chosen = np.unique(np.r_[means.argmax(), more].astype(int))
                windows += [one[i : i + WINDOW] for i in chosen]
                labels += [label] * len(chosen)
            labels = np.array(labels, int)
            toxic = max(1, labels.sum())
            weight = np.where(labels == 1, 0.5 / toxic, 0.5 / max(1, len(labels) - toxic)) * len(labels)
            for batch in np.array_split(rng.permutation(len(labels)), -(-len(labels) // BATCH)):
                self._step([windows[i] for i in batch], labels[batch], weight[batch], buckets, starts, counts, seen_v, seen_l, seen_b)
        z = self._word_part(buckets, starts, counts)
        self._calibrate(np.array([window_means(one, z).max() if len(one) else 0.0 for one in ids]), y)
        return self

    def _calibrate(self, tops: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression of the labels of texts on their top windows, by Newton steps."""
        x = np.stack([tops, np.ones(len(tops))], axis=1)
        at, even = np.array([1.0, 0.0]), 0.5 * len(y) / np.maximum(1, np.bincount(y, minlength=2))[y]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            curve = (x * (even * p * (1 - p))[:, None]).T @ x + 1e-3 * len(y) * np.diag([1e-2, 1e-4])
            at -= np.linalg.solve(curve, x.T @ (even * (p - y)) + 1e-5 * len(y) * at * [1.0, 0.0])
        self.scale, self.shift = float(at[0]), float(at[1])

    def _word_part(self, buckets: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        each = self.vectors @ (self.layer[:, 1] - self.layer[:, 0])
        return np.add.reduceat(each[buckets], starts) / counts

    def _step(self, windows, y, weight, buckets, starts, counts, seen_v, seen_l, seen_b) -> None:
        words = np.concatenate(windows)
        sizes = np.array([len(w) for w in windows])
        rows = np.repeat(np.arange(len(windows)), sizes)
        n = counts[words]
        at = buckets[np.repeat(starts[words] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        share = np.repeat(1.0 / (n * sizes[rows]), n)  # of a bucket in the mean of its window
        row = np.repeat(rows, n)
        mean = np.add.reduceat(self.vectors[at] * share[:, None], np.searchsorted(row, np.arange(len(windows))))
        logits = mean @ self.layer + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - np.eye(2)[y]) * (weight / len(y))[:, None]
        down = error @ self.layer.T
        used, place = np.unique(at, return_inverse=True)
        gradient = np.stack([np.bincount(place, share * down[row, k], len(used)) for k in range(DIM)], axis=1)
        for value, g, seen in ((self.layer, mean.T @ error, seen_l), (self.bias, error.sum(axis=0), seen_b)):
            seen += g**2
            value -= RATE * g / np.sqrt(seen)
        seen_v[used] += gradient**2
        self.vectors[used] -= RATE * gradient / np.sqrt(seen_v[used])


def word_contrast(ids: list[np.ndarray], y: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words are in several texts, and by how many deviations each is more often in toxic ones (over 3, else 0)."""
    own = [np.unique(one) for one in ids]
    counts = [np.bincount(np.concatenate([np.zeros(0, np.int64), *[o for o, label in zip(own, y) if label == k]]), minlength=words) for k in (0, 1)]
    sizes = np.maximum(1, np.bincount(y, minlength=2))
    share = (counts[0] + counts[1]) / sizes.sum()
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / sizes).sum())
    marks = (counts[1] / sizes[1] - counts[0] / sizes[0]) / spread
    return counts[0] + counts[1] > 1, np.maximum(0.0, marks - 3.0) * (counts[1] > 1)


def window_means(at: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Means over all windows of words, given by their numbers; of all words, if there are fewer.

    A word that stands again within three words counts once, or a window of one word over and over
    would weigh as much as that word alone.
    """
    n, z = min(WINDOW, len(at)), z[at]
    for lag in range(1, min(4, len(at))):
        z[lag:][at[lag:] == at[:-lag]] = 0.0
    sums = np.r_[0.0, np.cumsum(z)]
    return (sums[n:] - sums[:-n]) / n


class Scorer:
    def __init__(self, model: SubwordBag):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.words, self.z = Numbered(), np.zeros(0)

    def __call__(self, texts: list[bytes]) -> list[float]:
        if self.words.held > CACHE_BYTES:
            self._forget()
        places = [self.words.of(words_of(t)) for t in texts]
        self.z = np.r_[self.z, self.model.word_logits(self.words.fresh)]
        self.words.fresh = []
        tops = np.array([window_means(at, self.z).max() if len(at) else 0.0 for at in places])
        return (1.0 / (1.0 + np.exp(-np.clip(self.model.scale * tops + self.model.shift, -30, 30)))).tolist()


@lru_cache(maxsize=1)
def _scorer(model: SubwordBag) -> Scorer:
    """One for each Python worker, whatever number of tasks it runs."""
    return Scorer(model)


remembered(_scorer.cache_clear)


def fit(rows: list) -> SubwordBag:
    """A model from rows with text and y (0 or 1)."""
    model = SubwordBag()
    if not rows:
        model.layer[:] = 0.0
        return model
    return model.fit([words_of(r["text"].encode()) for r in rows], np.array([r["y"] for r in rows], int))


def score(docs: DataFrame, model: SubwordBag) -> DataFrame:
    """doc_id and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            scores = _scorer(sent.value)(utf8(rows.column("text")))
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

        return do

    return map_texts(docs.select("doc_id", "text"), work, "doc_id bigint, score double")
