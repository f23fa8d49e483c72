"""Language-model scoring by cross-entropy difference.

Two word-bigram models of one form share one vocabulary: the background is counted over all
documents, the target over the documents marked as good. A bigram's probability is smoothed
towards the unigram with a Dirichlet prior, and the unigram by adding one. The score of a
document is its mean loss per word under the target model less that under the background
model; below 0 it is closer to the target than the corpus is.

Every word of every document is counted, and words and bigrams are told apart by 64-bit hashes
of the whole word or bigram. Nothing is capped: texts are encoded in chunks of about
``CHUNK_BYTES``, kept as a table in the shared folder. A chunk asks for the counts of its
distinct keys, in one row for each range of keys; the ranges are as many as the keys need
(``RANGE_KEYS`` each), one task adds up a range and answers every chunk that asked, and the
answers go back to the chunk. A key comes once from a chunk, however often it stands there, so
a frequent one is no heavier than others.

Defined cases: a null or empty text has no words and null losses and score; with no target
document both models are the uninformed one on the target side; repeated rows are counted each.
The vocabulary has the words of the corpus and one for all others.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import WordCache, enter, mix64, remembered, slices, small_batches, staged, utf8

#: Weight of the unigrams against the bigrams of a word.
PRIOR = 20.0
#: Text bytes in a chunk, and keys asked for in a range.
CHUNK_BYTES, RANGE_KEYS = 16_000_000, 1 << 21
#: Rows of an Arrow batch of chunks, questions or answers.
CHUNK_ROWS = 16
_words = WordCache(xxhash.xxh64_intdigest)
remembered(_words.clear)
_START, _BEFORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_CHUNK = "chunk bigint, counted boolean, doc_ids array<bigint>, lengths array<bigint>, target array<boolean>, words binary, tokens binary, n_keys bigint"
_ANSWER = "chunk bigint, part int, counts array<binary>, totals array<bigint>"
_RESULT = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"


def _hashes(text: bytes) -> np.ndarray:
    return _words.array(text.lower().split(), np.uint64)


def _pairs(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(words ^ (before * np.uint64(0xC2B2AE3D27D4EB4F)))


def buckets(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each word, of the word before it (the start's for the first), and of the bigram."""
    hashes = np.r_[_START, _hashes(text)]
    return hashes[1:], hashes[:-1], _pairs(hashes[:-1], hashes[1:])


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed; their count comes first."""
    planes = np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, dtype=np.int64) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).reshape(n)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _encoded(docs: DataFrame, counted: bool) -> DataFrame:
    """Chunks of documents: their distinct word hashes, and the number of each word among them.

    ``docs`` has doc_id, text and is_target; only ``counted`` ones are counted.
    """

    def chunk(number: int, held: list) -> pa.RecordBatch:
        ids, target, hashes = zip(*held, strict=True)
        words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        row = {
            "chunk": number, "counted": counted, "doc_ids": ids, "lengths": [len(x) for x in hashes], "target": target,
            "words": _packed_keys(words), "tokens": _packed(tokens.astype(np.int32)), "n_keys": 2 * len(words) + 1 + len(tokens),
        }
        types = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        number, held, size = TaskContext.get().partitionId() << 33 | (not counted) << 32, [], 0
        for batch in batches:
            for rows in slices(batch, "text"):
                for doc, is_target, text in zip(rows.column("doc_id").to_pylist(), rows.column("is_target").to_pylist(), utf8(rows.column("text"))):
                    held.append((doc, is_target, _hashes(text)))
                    size += len(text)
                    if size >= CHUNK_BYTES:
                        yield chunk(number, held)
                        number, held, size = number + 1, [], 0
        if held:
            yield chunk(number, held)

    small_batches(docs.sparkSession)
    return staged(docs.select("doc_id", "text", "is_target").mapInArrow(run, _CHUNK), "lm-chunks")


def _keys(words: bytes, tokens: bytes, lengths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct keys of a chunk, and each token's place among them: of words, of words before, of bigrams."""
    hashes, at = np.r_[_unpacked_keys(words), _START], _unpacked(tokens, np.int32)
    ends = np.cumsum([0, *lengths])
    before = np.r_[len(hashes) - 1, at][: len(at)]
    before[ends[:-1][ends[:-1] < len(at)]] = len(hashes) - 1
    kinds, place = np.unique(mix64(hashes ^ _BEFORE), return_inverse=True)
    return [(hashes[:-1], at), (kinds, place[before]), np.unique(_pairs(hashes[before], hashes[at]), return_inverse=True)]


def _questions(chunks: DataFrame, parts: int) -> DataFrame:
    """For each chunk and range of keys: the chunk's keys, and how often background and target have them there."""
    firsts = np.array([(p << 64) // parts for p in range(parts)], np.uint64)
    lists = pa.list_(pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            target = np.repeat(np.array(row["target"], bool), row["lengths"])
            keys, counts = [[] for _ in range(parts)], [[] for _ in range(parts)]
            for distinct, at in _keys(row["words"], row["tokens"], row["lengths"]):
                n = [np.bincount(x, minlength=len(distinct)) * row["counted"] for x in (at, at[target])]
                cuts = [*np.searchsorted(distinct, firsts).tolist(), len(distinct)]
                for p in range(parts):
                    part = slice(cuts[p], cuts[p + 1])
                    keys[p].append(_packed_keys(distinct[part]))
                    counts[p].append(_packed(np.concatenate([x[part] for x in n])))
            for k in range(0, parts, CHUNK_ROWS):
                some = range(k, min(parts, k + CHUNK_ROWS))
                columns = [pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(some, pa.int32())]
                columns += [pa.array([x[p] for p in some], lists) for x in (keys, counts)]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "part", "keys", "counts"])

    return chunks.select("chunk", "counted", "lengths", "target", "words", "tokens").mapInArrow(
        run, "chunk bigint, part int, keys array<binary>, counts array<binary>"
    )


def _answers(questions: DataFrame, parts: int) -> DataFrame:
    """Counts over all chunks in place of the chunk's own; totals are distinct words, and words of background and target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, list] = {}
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            ranges.setdefault(row["part"], []).append((row["chunk"], row["keys"], row["counts"]))
        for part, rows in ranges.items():
            answers, totals = [[] for _ in rows], []
            for kind in range(3):
                keys = [_unpacked_keys(r[1][kind]) for r in rows]
                own = [_unpacked(r[2][kind]).reshape(2, -1) for r in rows]
                distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
                # sums of whole numbers below 2^53 are exact
                sums = np.array([np.bincount(at, np.concatenate([x[m] for x in own]), len(distinct)) for m in (0, 1)]).astype(np.int64)
                totals = totals or [int((sums[0] > 0).sum()), *sums.sum(axis=1).tolist()]
                for answer, places in zip(answers, np.split(at, np.cumsum([len(x) for x in keys])[:-1]), strict=True):
                    answer.append(_packed(sums[:, places].reshape(-1)))
            for (chunk, *_), answer in zip(rows, answers, strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), pa.array([answer], pa.list_(pa.binary())), pa.array([totals], pa.list_(pa.int64()))],
                    ["chunk", "part", "counts", "totals"],
                )

    return questions.repartitionById(parts, "part").mapInArrow(run, _ANSWER)


def _losses(row: dict, answers: list[dict]) -> list[np.ndarray]:
    """Mean losses under target and background of each document of a chunk."""
    lengths = np.array(row["lengths"], np.int64)
    distinct, *n = np.sum([a["totals"] for a in answers], axis=0).tolist()
    counts = [np.concatenate([_unpacked(a["counts"][k]).reshape(2, -1) for a in answers], axis=1) for k in range(3)]
    places = [at for _, at in _keys(row["words"], row["tokens"], row["lengths"])]
    doc, out = np.repeat(np.arange(len(lengths)), lengths), []
    for m in (1, 0):
        word, before, pair = (c[m] for c in counts)
        unigram = PRIOR * (word + 1) / (n[m] + distinct + 1)
        each = np.log(before + PRIOR)[places[1]] - np.log(pair[places[2]] + unigram[places[0]])
        out.append(np.bincount(doc, each, len(lengths)) / np.maximum(lengths, 1))
    return out


def fit(docs: DataFrame, target_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents and their encoded chunks; documents whose id is among ``target_ids`` are the target."""
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("doc_id")).distinct().withColumn("is_target", F.lit(True))
    # both sides are shuffled at any size: the ids grow with the corpus, and small ones would be broadcast otherwise
    marked = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    return docs, _encoded(marked, counted=True)


def score(docs: DataFrame, fitted: DataFrame, chunks: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (means in nats) and their difference as score.

    ``fitted`` and ``chunks`` are from ``fit``; documents other than the fitted ones are encoded, but not counted.
    """
    same = docs is fitted
    if not same:
        chunks = chunks.unionAll(_encoded(docs.select("doc_id", "text", F.lit(False).alias("is_target")), counted=False))
    parts = max(1, math.ceil((chunks.agg(F.sum("n_keys")).first()[0] or 0) / RANGE_KEYS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = itertools.chain.from_iterable(b.to_pylist() for b in batches)
        for _, (row, *answers) in itertools.groupby(rows, lambda r: r["chunk"]):
            if row["part"] >= 0:
                continue  # the chunk is not to be scored
            target, background = _losses(row, answers)
            none = np.array(row["lengths"]) == 0
            losses = [pa.array(x, pa.float64(), mask=none) for x in (target, background, target - background)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["lengths"], pa.int64()), *losses],
                ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
            )

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(CHUNK_ROWS))
    answers = _answers(_questions(chunks, parts), parts)
    scored = chunks.where(F.col("counted") == same).select("chunk", F.lit(-1).alias("part"), "doc_ids", "lengths", "words", "tokens")
    together = scored.unionByName(answers, allowMissingColumns=True)
    return together.repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(run, _RESULT)
