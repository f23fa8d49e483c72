"""Benchmark decontamination: a broadcast set of benchmark word windows, scanned for in every document.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. A window is
``window`` consecutive words of an item; an item with fewer words is one window. The words
of a document that a window covers are hit. The scan looks up hashes of the document's
windows first and then compares the words themselves.

Defined cases: a null or empty text has no words and is never hit; an item without words has
no windows; an item without an id is listed as ``null``; an empty benchmark hits nothing;
repeated rows get equal results. The broadcast is bounded: a benchmark of more than
``block_words`` words is taken in blocks of that size, each with a scan of its own, and the
hits of all blocks are put together by document. Cutting takes the spans of all blocks on one
text together, so that the size of a block does not change what is left.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import map_texts, ngram_hashes, staged, utf8

WINDOW = 10
#: Benchmark words in one broadcast set: about 200 MB in a task.
BLOCK_WORDS = 1_000_000

# A-Z to a-z; bytes that are in no word to a space
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_SPANS = "array<struct<start: bigint, end: bigint>>"
_RESULT = f"n_words bigint, spans {_SPANS}, items array<string>"
#: Spans known so far, while several blocks are scanned.
_HIT = "_hit_spans"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class _Numbers(dict):
    """Word numbers from 1; a word of no item is 0."""

    def __missing__(self, word: bytes) -> int:
        return 0

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class WindowSet:
    """Windows of benchmark items by length: their hashes, and the exact windows with their items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.numbers = _Numbers()
        self.exact: dict[int, dict[bytes, set[str]]] = {}
        for item, words in items:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
            ids, n = self.numbers.of(words), min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                self.exact.setdefault(n, {}).setdefault(ids[i : i + n].tobytes(), set()).add(item)
        self.hashes = {
            n: np.unique(ngram_hashes(np.frombuffer(b"".join(found), np.uint64), n)[::n]) for n, found in self.exact.items()
        }

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, words, items) of each occurrence; number 0 is in no window."""
        unknown = np.r_[0, np.cumsum(ids == 0)]
        for n, hashes in self.hashes.items():
            if len(ids) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[:-n])
            if len(starts):
                hit = np.isin(ngram_hashes(ids, n)[starts], hashes)
                for i in starts[hit].tolist():
                    if items := self.exact[n].get(ids[i : i + n].tobytes()):
                        yield i, n, items


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def scan_texts(texts: list[bytes], windows: WindowSet) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text: its number of words, the hit runs of words, the items found."""
    words = [words_of(t) for t in texts]
    ids = windows.numbers.of([w for one in words for w in (*one, b"")])  # a 0 ends each text
    firsts = np.cumsum([0, *(len(one) + 1 for one in words)])
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    for start, n, found in windows.find(ids):
        doc = int(np.searchsorted(firsts, start, "right")) - 1
        first = int(firsts[doc])
        spans.setdefault(doc, []).append((start - first, start - first + n))
        items.setdefault(doc, set()).update(found)
    return [(len(one), joined(spans.get(i, [])), sorted(items.get(i, ()))) for i, one in enumerate(words)]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without runs of words, and what stands between their words; a space is left."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORD_BYTES))]
    out, at = [], 0
    for start, end in spans:
        out += [text[at : places[start][0]].rstrip(b" "), b" "]
        at = places[end - 1][1]
    return b"".join([*out, text[at:].lstrip(b" ") if out else text])


def _blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[WindowSet]:
    """Sets of at most ``block_words`` words, or of one longer item; rows come to the driver one partition at a time."""
    block: list[tuple[str, list[bytes]]] = []
    total = 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").where(F.col("text").isNotNull())
    for item, text in rows.toLocalIterator():
        words = words_of(text.encode())
        if block and total + len(words) > block_words:
            yield WindowSet(block, window)
            block, total = [], 0
        block.append((item, words))
        total += len(words)
    yield WindowSet(block, window)


def _scanned(docs: DataFrame, windows: WindowSet) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = scan_texts(utf8(rows.column("text")), sent.value)
            return pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("row_hash"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in f[1]] for f in found],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                    ),
                    pa.array([f[2] for f in found], pa.list_(pa.string())),
                ],
                ["doc_id", "row_hash", "n_words", "spans", "items"],
            )

        return do

    return map_texts(docs, work, f"doc_id bigint, row_hash bigint, {_RESULT}")


# Runs of all blocks as ``joined`` puts them together: in order, those that meet are one.
_JOIN_SPANS = """
aggregate(
    array_sort(flatten(collect_list(spans))), cast(array() as array<struct<start: bigint, end: bigint>>),
    (out, s) -> if(size(out) > 0 and s.start <= element_at(out, -1).end,
        concat(slice(out, 1, size(out) - 1),
               array(named_struct('start', element_at(out, -1).start, 'end', greatest(element_at(out, -1).end, s.end)))),
        concat(out, array(s))))
"""


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, spans (hit runs of words), items (ids found, as sorted text) of every document."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text")
    found = [_scanned(rows, windows) for windows in _blocks(benchmark, window, block_words)]
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit")
    if len(found) == 1:
        return found[0].select("doc_id", "n_words", n_hit, "spans", "items")
    parts = [staged(x, "scan") for x in found]
    every = parts[0]
    for x in parts[1:]:
        every = every.unionAll(x)
    merged = every.groupBy("doc_id", "row_hash").agg(
        F.max("n_words").alias("n_words"),
        F.expr(_JOIN_SPANS).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count("*") / len(parts)).cast("int").alias("copies"),
    )
    return merged.select(
        "doc_id", "n_words", n_hit, "spans", "items",
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
    ).drop("_copy")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "spans",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without hit words (``spans``), or without the documents that have any (``documents``).

    Cutting can bring two halves of a window together, so a text is scanned again until
    nothing is hit. A document that loses all its words goes. The columns stay as they are;
    ``n_chars``, where present, follows the text.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is spans or documents, not {remove}")
    blocks = _blocks(benchmark, window, block_words)
    first, second = next(blocks), next(blocks, None)
    if remove == "spans" and second is not None:
        return _cut_over_blocks(docs, benchmark, window, block_words)
    docs = _cleaned(docs, first, remove)
    for windows in itertools.chain([second] if second is not None else [], blocks):
        docs = _cleaned(staged(docs, "cleaned"), windows, remove)  # a task holds one block at a time
    return docs


def _cut_over_blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """As with one block: all blocks scan the same text, their spans are cut together, and what was cut is scanned again.

    The texts are staged after each block, so that a task holds one block at a time.
    """
    clean, left = [], docs
    while True:
        left = left.withColumn(_HIT, F.array().cast(_SPANS))
        for windows in _blocks(benchmark, window, block_words):
            left = staged(_marked(left, windows), "spans")
        clean.append(left.where(F.size(_HIT) == 0).drop(_HIT))
        hit = left.where(F.size(_HIT) > 0)
        if hit.isEmpty():
            return functools.reduce(DataFrame.unionAll, clean)
        left = staged(_cut(hit), "cut")


def _marked(docs: DataFrame, windows: WindowSet) -> DataFrame:
    """The spans of one more block put to those that are known."""
    sent = docs.sparkSession.sparkContext.broadcast(windows)
    names, kind = docs.columns, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            spans = []
            for known, (_, found, _) in zip(rows.column(_HIT).to_pylist(), scan_texts(utf8(rows.column("text")), sent.value), strict=True):
                spans.append([{"start": a, "end": b} for a, b in joined([*((k["start"], k["end"]) for k in known), *found])])
            columns = {n: rows.column(n) for n in names} | {_HIT: pa.array(spans, kind)}
            return pa.RecordBatch.from_arrays(list(columns.values()), names)

        return do

    return map_texts(docs, work, docs.schema)


def _cut(docs: DataFrame) -> DataFrame:
    """The texts without their spans; one without words goes."""
    names = [n for n in docs.columns if n != _HIT]

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[(k["start"], k["end"]) for k in known] for known in rows.column(_HIT).to_pylist()]
            texts = [without(t, found) for t, found in zip(utf8(rows.column("text")), spans, strict=True)]
            decoded = [t.decode() for t in texts]
            columns = {n: rows.column(n) for n in names} | {"text": pa.array(decoded, pa.string())}
            if "n_chars" in names:
                columns["n_chars"] = pa.array([len(t) for t in decoded], rows.column("n_chars").type)
            return pa.RecordBatch.from_arrays(list(columns.values()), names).filter(pa.array([bool(words_of(t)) for t in texts], pa.bool_()))

        return do

    return map_texts(docs, work, docs.drop(_HIT).schema)


def _cleaned(docs: DataFrame, windows: WindowSet, remove: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(windows)
    names = docs.columns

    def clean(text: bytes, spans: list) -> bytes | None:
        while spans:
            text = without(text, spans)
            _, spans, _ = scan_texts([text], sent.value)[0]
        return text if words_of(text) else None

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            texts, keep, new = rows.column("text"), [], {}
            for i, (text, (_, spans, _)) in enumerate(zip(t := utf8(texts), scan_texts(t, sent.value), strict=True)):
                if spans:
                    new[i] = clean(text, spans) if remove == "spans" else None
                keep.append(new.get(i, b"") is not None)
            if not new:
                return rows
            changed = [new[i].decode() if new.get(i) is not None else x for i, x in enumerate(texts.to_pylist())]
            columns = {n: rows.column(n) for n in names} | {"text": pa.array(changed, pa.string())}
            if "n_chars" in names:
                counts = rows.column("n_chars")
                columns["n_chars"] = pa.array(
                    [len(changed[i]) if new.get(i) is not None else x for i, x in enumerate(counts.to_pylist())], counts.type
                )
            return pa.RecordBatch.from_arrays(list(columns.values()), names).filter(pa.array(keep))

        return do

    return map_texts(docs, work, docs.schema)
