"""Language identification by unigram pieces with the segmentation summed out.

The pieces are those of a fixed public vocabulary; each language has a probability for each.
The probability of a word is the sum over all its segmentations into pieces, by the forward
algorithm; the log-likelihood of a text is the sum over its words, and the score the
posterior of the best language with equal priors. The piece probabilities are fitted by
expectation maximisation over all segmentations of the words of a bounded sample of labelled
rows.

Words are runs of letters, lower-cased. A task scores each distinct word once, all words of
one length together. Defined cases: a text that is null or has no letter is ``und`` with score
0, as is every text if no row could be learnt from; ties go to the language first in order;
a letter that is no piece has one small probability in all languages.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.llm.common import CACHE_BYTES, Numbered, bounded_sample, map_texts, mix64, remembered, strings

#: Rows of each language that the piece probabilities are fitted on, about.
SAMPLE_ROWS = 500
ROUNDS = 4
UNKNOWN = 1e-7
#: Words are learnt from in runs of at most so many letters.
LEARNT_LETTERS = 256
UNDECIDED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"  # how the vocabulary writes the start of a word
_SLOTS = 20


def words_of(text: str) -> list[str]:
    words = _LETTERS.findall(text.lower())
    if not any(map(str.isalpha, words)) and not any(c.isalpha() for w in words for c in w):
        return []
    return words


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of lower-case letters, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == _START or (x := p.removeprefix(_START)).isalpha() and x == x.lower())


class PieceTable:
    """Numbers of pieces by a hash of their characters; 0 is no piece, 1 a single unknown letter."""

    def __init__(self, pieces: list[str]):
        self.size, self.longest = len(pieces) + 2, max(map(len, pieces), default=1)
        codes = [np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in pieces]
        hashes = np.array([self._whole(c) for c in codes], np.uint64)
        self.first, self.second = (np.zeros(1 << _SLOTS, np.int32) for _ in range(2))
        self.keys = np.r_[np.zeros(2, np.uint64), hashes]
        left = []
        for number, h in enumerate(hashes, 2):
            table, slot = self.first, int(h >> np.uint64(64 - _SLOTS))
            if table[slot]:
                left.append((number, h))
            else:
                table[slot] = number
        for number, h in left:
            slot = int(h) & ((1 << _SLOTS) - 1)
            if self.second[slot]:
                raise ValueError("two pieces share both slots")
            self.second[slot] = number

    @staticmethod
    def step(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (h ^ (codes.astype(np.uint64) + np.uint64(0x9E3779B9))) * np.uint64(0xD6E8FEB86659FD93)

    def _whole(self, codes: np.ndarray) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in codes:
            h = self.step(h, np.array([c]))
        return mix64(h)[0]

    def numbers(self, words: np.ndarray) -> list[np.ndarray]:
        """For each length, the number of the piece at each start, of words of one length as rows of code points."""
        out, h = [], np.zeros(words.shape, np.uint64)
        for n in range(1, min(self.longest, words.shape[1]) + 1):
            h = self.step(h[:, : words.shape[1] - n + 1], words[:, n - 1 :])
            spread = mix64(h)
            a = self.first[(spread >> np.uint64(64 - _SLOTS)).astype(np.int64)]
            b = self.second[(spread & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)]
            found = np.where(self.keys[a] == spread, a, np.where(self.keys[b] == spread, b, 0))
            found[self.keys[found] != spread] = 0
            out.append(np.where(found == 0, 1, found) if n == 1 else found)
        return out


def _by_length(words: list[str]):
    """Places and code points of the words of one length, each after the mark of its start."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for n, where in groups.items():
        most = max(1, 400_000 // n)  # rows of a matrix are bounded too
        for k in range(0, len(where), most):
            part = where[k : k + most]
            text = "".join(_START + words[i] for i in part)
            yield np.array(part), np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(part), n + 1)


def forward(numbers: list[np.ndarray], length: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward sums at each place of words of one length, and the log of their scales so far."""
    rows, langs = len(numbers[0]), p.shape[1]
    alpha, scale = np.zeros((length + 1, rows, langs)), np.zeros((length + 1, rows, langs))
    alpha[0] = 1.0
    for j in range(1, length + 1):
        total = np.zeros((rows, langs))
        for n in range(1, min(len(numbers), j) + 1):
            factor = p[numbers[n - 1][:, j - n]]
            total += alpha[j - n] * factor * (np.exp(scale[j - n] - scale[j - 1]) if j > 24 else 1.0)
        scale[j] = scale[j - 1]
        if j >= 24:
            scale[j] += np.log(total)
            total = np.ones_like(total)
        alpha[j] = total
    return alpha, scale


def _in_runs(counts: Counter) -> Counter:
    """Counted words, the longest ones cut into runs of letters."""
    out: Counter = Counter()
    for word, n in counts.items():
        for at in range(0, len(word), LEARNT_LETTERS):
            out[word[at : at + LEARNT_LETTERS]] += n
    return out


class LanguageModel:
    """Piece probabilities of each language."""

    def __init__(self, langs: list[str], pieces: list[str]):
        self.langs, self.table = langs, PieceTable(pieces)
        self.p = np.full((self.table.size, len(langs)), 1.0 / self.table.size)
        self.p[:2] = [[0.0], [UNKNOWN]]

    def fit(self, counts: list[Counter], rounds: int = ROUNDS) -> LanguageModel:
        """Expectation maximisation over all segmentations of the counted words of each language."""
        counts = [_in_runs(c) for c in counts]
        words = sorted(set().union(*counts))
        weight = np.array([[c[w] for c in counts] for w in words], float).reshape(len(words), len(self.langs))
        for _ in range(rounds):
            expected = np.zeros_like(self.p)
            for where, codes in _by_length(words):
                numbers, length, w = self.table.numbers(codes), codes.shape[1], weight[where]
                alpha, scale = forward(numbers, length, self.p)
                beta = np.zeros_like(alpha)
                beta[length] = w / alpha[length]
                for j in range(length - 1, -1, -1):
                    for n in range(1, min(len(numbers), length - j) + 1):
                        number = numbers[n - 1][:, j]
                        share = self.p[number] * beta[j + n] * (np.exp(scale[j] - scale[j + n]) if j + n >= 24 else 1.0)
                        beta[j] += share
                        for k in range(len(self.langs)):
                            expected[:, k] += np.bincount(number, share[:, k] * alpha[j][:, k], self.table.size)
            expected[2:] += 0.01
            expected[:2] = 0.0
            self.p = expected / expected.sum(axis=0)
            self.p[1] = UNKNOWN
        return self

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)))
        for where, codes in _by_length(words):
            if codes.shape[1] > 512:  # a word of any length, with the memory of the last few places
                out[where] = self._long(codes)
                continue
            alpha, scale = forward(self.table.numbers(codes), codes.shape[1], self.p)
            out[where] = np.log(alpha[-1]) + scale[-1]
        return out

    def _long(self, codes: np.ndarray) -> np.ndarray:
        """As ``forward``, but holding only the last places."""
        numbers, length = self.table.numbers(codes), codes.shape[1]
        last = [np.ones((len(codes), len(self.langs)))]
        log = np.zeros((len(codes), len(self.langs)))
        for j in range(1, length + 1):
            total = sum(last[-n] * self.p[numbers[n - 1][:, j - n]] for n in range(1, min(len(numbers), j, len(last)) + 1))
            log += np.log(total)
            last = [x / total for x in last[-self.table.longest + 1 :]] + [np.ones_like(total)]
        return log


class Scorer:
    """A model with the words that this worker has scored."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.words, self.known = Numbered(), np.zeros((0, len(self.model.langs)), np.float32)

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        if self.words.held > CACHE_BYTES:
            self._forget()
        places = [self.words.of(words_of(t)) for t in texts]
        if self.words.fresh:
            self.known = np.concatenate([self.known, self.model.word_scores(self.words.fresh).astype(np.float32)])
            self.words.fresh = []
        return [self._best(self.known[at].sum(axis=0, dtype=np.float64)) if len(at) else (UNDECIDED, 0.0) for at in places]

    def _best(self, score: np.ndarray) -> tuple[str, float]:
        if not len(score):
            return UNDECIDED, 0.0
        best = int(score.argmax())
        return self.model.langs[best], float(1.0 / np.exp(score - score[best]).sum())


@lru_cache(maxsize=1)
def _scorer(model: LanguageModel) -> Scorer:
    """One for each Python worker, whatever number of tasks it runs."""
    return Scorer(model)


remembered(_scorer.cache_clear)


def fit(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model of each value of ``lang`` among the rows to learn from, on about ``rows`` of each."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts: dict[str, Counter] = {}
    for row in bounded_sample(labelled, rows, by="lang").toLocalIterator():
        counts.setdefault(row["lang"], Counter()).update(words_of(row["text"]))
    langs = sorted(counts)
    model = LanguageModel(langs, vocabulary())
    return model.fit([counts[x] for x in langs]) if langs else model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, which take the place of columns so named."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = _scorer(sent.value)(strings(rows.column("text")))
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            return pa.RecordBatch.from_arrays([*rows.columns, *added], [*rows.schema.names, "lang_pred", "score"])

        return do

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_texts(docs, work, T.StructType([*docs.schema.fields, *added]))
