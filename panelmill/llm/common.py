"""What the text operators share: reading, batches of bounded size, word caches, held-out rows, samples.

Per-row work runs in tasks on Arrow batches (``mapInArrow``). A batch is cut into
slices of a bounded number of text bytes, so memory does not follow the length of
texts times the number of rows in a batch. Every function selects the columns it
needs by name, so further columns, also those named like a result, do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelmill.session import scratch_path

#: Text bytes that are worked on at once in a task.
SLICE_BYTES = 4_000_000
#: Bytes that a worker remembers of words before it starts anew: the words, and about so many for each entry.
CACHE_BYTES, ENTRY_BYTES = 48_000_000, 200
#: Rows of one Arrow batch between Spark and Python.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str | int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes in a column; a longer value is a run of its own."""
    sizes = batch.column(column).cast(pa.binary())
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), dtype=np.int64)
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


_FORGET: list[Callable[[], None]] = []
_owner: str | None = None


def remembered(clear: Callable[[], None]) -> None:
    """``clear`` is called when a worker goes on with another operator, so workers hold the words of one only."""
    _FORGET.append(clear)


def enter(owner: str) -> None:
    global _owner
    if _owner != owner:
        for clear in _FORGET:
            clear()
        _owner = owner


def map_texts(
    df: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, text: str = "text"
) -> DataFrame:
    """Run ``work()`` once in each task, and what it returns on each slice of rows."""
    small_batches(df.sparkSession)
    owner = work.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(owner)
        do = work()
        for batch in batches:
            for part in slices(batch, text):
                yield do(part)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows; a session that asks for smaller ones keeps them.

    Spark has this as a setting of the session only, and reads it when a plan runs.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


class WordCache(dict):
    """A value for each word, made when the word is first met; forgotten when they take too many bytes."""

    def __init__(self, make: Callable, most: int = CACHE_BYTES):
        super().__init__()
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, word):
        self.held += len(word) + ENTRY_BYTES
        if self.held > self.most:
            self.clear()
            self.held = len(word) + ENTRY_BYTES
        value = self[word] = self.make(word)
        return value

    def array(self, words: Sequence, dtype) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype, len(words))


class Numbered(dict):
    """Words numbered as they are met; ``fresh`` has those that nothing is known of yet, ``held`` the bytes of all."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []
        self.held = 0

    def __missing__(self, word) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        self.held += len(word) + ENTRY_BYTES
        return n

    def of(self, words: Sequence) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ngram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive word hashes; none where there are fewer."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(len(ids) - n + 1, np.uint64(n))
        for i in range(n):
            out = (out ^ ids[i : len(ids) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return mix64(out)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def held_out(by: int, which: int, doc_id: str = "doc_id") -> Column:
    """Rows that are never learnt from; a row without an id is one of them."""
    return F.coalesce(remainder(F.col(doc_id), by) == which, F.lit(True))


def sampled(df: DataFrame, by: str, rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` rows of each value of ``by`` (all, if there are fewer), chosen by a hash of the key.

    For fitting models only. The counts come from one narrow pass; the driver gets
    one row for each value of ``by``. Only keys that are unique keep the bound: see ``bounded_sample``.
    """
    counts = {r[0]: r[1] for r in df.where(F.col(by).isNotNull()).groupBy(by).count().collect()}
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(by) == F.lit(value), F.lit(int(min(1.0, rows / n) * 2**30))).otherwise(share)
    return df.where(F.pmod(F.xxhash64(key), F.lit(2**30)) < share)


def bounded_sample(df: DataFrame, rows: int, by: str | None = None) -> DataFrame:
    """About ``rows`` different rows (of each value of ``by``), and never more, whatever the ids.

    For fitting models only. ``df`` has doc_id and text. Rows are chosen by a hash of both, so neither
    rows without an id nor those of a repeated id pass together; copies of a row count as one.
    """
    mark = df.withColumn("_mark", F.xxhash64("doc_id", "text"))
    group = F.lit(True) if by is None else F.col(by)
    counts = df.groupBy(group.alias("_by")).count().collect()
    share = F.lit(0)
    for value, n in counts:
        share = F.when(group.eqNullSafe(F.lit(value)), F.lit(int(min(1.0, rows / n) * 2**30))).otherwise(share)
    chosen = mark.where(F.pmod("_mark", F.lit(2**30)) < share)
    # few rows are left: copies are put together within the tasks first, then the lowest hashes of a value stay
    chosen = chosen.dropDuplicates(["_mark", *([by] if by else [])])
    if by is None:
        return chosen.orderBy("_mark").limit(rows).drop("_mark")
    place = F.row_number().over(Window.partitionBy(by).orderBy("_mark"))
    return chosen.withColumn("_place", place).where(F.col("_place") <= rows).drop("_mark", "_place")


def labelled_sample(spark: SparkSession, sf_dir: str, label: str, by: int, which: int, rows: int) -> list:
    """(text, label, n_chars) of about ``rows`` rows of either label, and never more, without held-out rows.

    The sampled ids are few by construction, so they can be broadcast; the rows that have them are bounded
    again, as ids may repeat in ``documents``. An id with both labels is left out.
    """
    labels = (
        table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("y")).where(~held_out(by, which) & F.col("y").isin(0, 1))
    )
    clear = labels.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_y")).where("y = _y").drop("_y")
    chosen = sampled(clear, "y", rows)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    found = docs.join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())
    return sorted(bounded_sample(found, rows, by="y").collect(), key=lambda r: (r["doc_id"], r["text"]))


def byte_matrix(words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their places in the list, and their bytes as rows."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for n, where in zip(*_runs(lengths[order], order)):
        yield where, np.frombuffer(b"".join([words[i] for i in where]), np.uint8).reshape(len(where), n)


def _runs(values: np.ndarray, order: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(values):
        return [], []
    cuts = np.flatnonzero(np.diff(values)) + 1
    return values[np.r_[0, cuts]].tolist(), np.split(order, cuts)
