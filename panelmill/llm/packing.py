"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's token ids, with an end id, are cut at multiples of the capacity, so that long
documents give full windows and one rest. The rests of a few thousand documents at a time are
spread over windows by largest differencing: each rest starts as a partition of its own over
all windows; the two partitions with the largest imbalance are merged, fullest window of one
with emptiest of the other, until one is left. If its fullest window is over the capacity,
there are more windows and the differencing starts again.

Tokenising and cutting is one pass over the texts; only narrow piece rows (with the ids, if
asked for) go through one shuffle that evens out the groups. Nothing has to meet in one task.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each; an
empty table gives no pieces; a rest of exactly the capacity is a full window.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import CACHE_BYTES, Numbered, WordCache, enter, remembered, slices, small_batches, staged, utf8

CAPACITY = 4096
END_ID = 2
#: Windows of tokens that rests come to which are spread together.
GROUP_WINDOWS = 200
# How byte-level vocabularies write bytes: printable Latin-1 as it is, the others in order from 256 on.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def tokenizer_json() -> str:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


class Tokenizer:
    """Ids of a text, put together from the ids of its space-separated chunks.

    The tokenizer drops white space and never joins across it, so a chunk is encoded when it
    is first met and then remembered, as a run of one flat array. It also lower-cases, so
    chunks that differ in the case of A-Z are one. A chunk of printable ASCII and Latin-1 letters
    is split here as the tokenizer splits it, and its parts go straight to the model. A text that holds
    the string of a special token, in whatever case, is left to the library as a whole.
    """

    #: Fixed value: how the tokenizer splits, for lower-case text of these characters.
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")

    def __init__(self, json: str, most: int = CACHE_BYTES):
        from tokenizers import Tokenizer as Own

        self.own = Own.from_str(json)
        self.special = [t.content.lower().encode() for t in self.own.get_added_tokens_decoder().values()]
        self.model = self.own.model
        self.most = most
        self.parts = WordCache(lambda part: [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(_BYTES))])
        self._forget()

    def _forget(self) -> None:
        self.place = Numbered()
        self.ids = np.zeros(0, np.uint32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _chunk(self, chunk: bytes) -> list[int]:
        text = chunk.decode()
        if self.PLAIN.fullmatch(text):
            return [i for part in self.PARTS.findall(text.lower()) for i in self.parts[part]]
        return self.own.encode(text, add_special_tokens=False).ids

    def _learn(self) -> None:
        found = [self._chunk(c) for c in self.place.fresh]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(lengths) - lengths]
        self.lengths = np.r_[self.lengths, lengths]
        self.ids = np.r_[self.ids, np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))]
        self.place.fresh = []

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.place.held > self.most:
            self._forget()
        lowered = [t.lower() for t in texts]
        whole = {i for i, t in enumerate(lowered) if any(s in t for s in self.special)}
        places = [self.place.of(t.split()) if i not in whole else () for i, t in enumerate(lowered)]
        self._learn()
        out = []
        for i, at in enumerate(places):
            if i in whole:
                out.append(np.array(self.own.encode(texts[i].decode(), add_special_tokens=False).ids, np.uint32))
                continue
            lengths = self.lengths[at]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.ids[np.repeat(self.starts[at] - ends + lengths, lengths) + np.arange(total)])
        return out


@lru_cache(maxsize=1)
def _tokenizer(json: str, most: int) -> Tokenizer:
    """One for each Python worker, whatever number of tasks it runs."""
    return Tokenizer(json, most)


remembered(_tokenizer.cache_clear)


def spread(sizes: list[int], windows: int) -> list[list[int]]:
    """Numbers of the sizes in each window, by largest differencing.

    A partition is the loads of its windows, from full to empty, over the load of its least
    full one: that level is common to all windows and is left out. What a window holds is a
    node: 0 is empty, then the sizes, then pairs of nodes.
    """
    if not sizes:
        return []
    left, right, nodes = [], [], len(sizes) + 1
    heap = [(-size, i, np.array([size]), np.array([i + 1])) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tick = itertools.count(len(sizes))
    while len(heap) > 1:
        _, _, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        n = min(windows, len(a) + len(b))
        load, held = np.zeros(n, np.int64), np.zeros(n, np.int64)
        load[: len(a)], held[: len(a)] = a, held_a
        load[n - len(b) :] += b[::-1]  # the full windows of one meet the empty ones of the other
        other = np.zeros(n, np.int64)
        other[n - len(b) :] = held_b[::-1]
        both = (held > 0) & (other > 0)
        left.append(held[both])
        right.append(other[both])
        held = np.where(both, np.cumsum(both) + nodes - 1, held + other)
        nodes += int(both.sum())
        order = np.argsort(-load, kind="stable")
        load, held = load[order], held[order]
        if n == windows:
            load -= load[-1]
        heapq.heappush(heap, (-int(load[0]), next(tick), load, held))
    left, right = (np.concatenate([np.zeros(0, np.int64), *x]).tolist() for x in (left, right))
    out, first = [], len(sizes) + 1
    for node in heap[0][3].tolist():
        stack, items = [node], []
        while stack:
            node = stack.pop()
            if node >= first:
                stack += [left[node - first], right[node - first]]
            elif node:
                items.append(node - 1)
        if items:
            out.append(items)
    return out


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; more of them whenever differencing fills one above it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = spread(sizes, windows)
        fullest = max((sum(sizes[i] for i in one) for one in found), default=0)
        if fullest <= capacity:
            return found
        # as many more as bring the fullest down to the capacity if all shrink alike
        windows = max(windows + 1, windows * fullest // capacity)


class _Packer:
    """The pieces of one task: full windows go on at once, rests when they are enough for a group."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.rests, self.tokens = capacity, first, [], 0

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """A document's pieces as far as they are packed: doc, start, ids, its tokens, sequence, offset."""
        for start in range(0, len(ids), self.capacity):
            piece = ids[start : start + self.capacity]
            if len(piece) == self.capacity:
                yield doc, start, piece, len(ids), self.next, 0
                self.next += 1
            else:
                self.rests.append((doc, start, piece, len(ids)))
                self.tokens += len(piece)
        if self.tokens >= GROUP_WINDOWS * self.capacity:
            yield from self.packed()

    def packed(self) -> Iterator[tuple]:
        for one in pack_group([len(r[2]) for r in self.rests], self.capacity) if self.rests else []:
            at = 0
            for i in one:
                yield *self.rests[i], self.next, at
                at += len(self.rests[i][2])
            self.next += 1
        self.rests, self.tokens = [], 0


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, their ``ids`` if asked for,
    ``sequence_id`` and their ``offset`` in that sequence.

    Tokens of remembered words are four times cheaper; without ids to carry a worker has room for more of them.
    """
    cache_bytes = CACHE_BYTES if with_ids else 4 * CACHE_BYTES
    json = docs.sparkSession.sparkContext.broadcast(tokenizer_json())
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids, "sequence_id", "offset"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        doc, start, ids, tokens, sequence, offset = zip(*rows, strict=True)
        crc = [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]
        columns = [pa.array(c, pa.int64()) for c in (doc, start, list(map(len, ids)), crc, tokens)]
        if with_ids:
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
        return pa.RecordBatch.from_arrays([*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enter(__name__)
        tokenizer = _tokenizer(json.value, cache_bytes)
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40)  # a task has fewer sequences than that
        for rows in itertools.chain.from_iterable(slices(b, "text") for b in batches):
            out = []
            for doc, ids in zip(rows.column("doc_id").to_pylist(), tokenizer.encode(utf8(rows.column("text"))), strict=True):
                out += packer.add(doc, np.append(ids, np.uint32(END_ID)))
            if out:
                yield batch(out)
        if packer.rests:
            yield batch(list(packer.packed()))

    small_batches(docs.sparkSession)
    schema = ", ".join(f"{n} {'array<int>' if n == 'ids' else 'bigint'}" for n in names)
    return staged(docs.select("doc_id", "text").mapInArrow(run, schema), "packed")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each sequence, from pieces packed with their ids; a sequence is bounded by the capacity."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts")["ids"]).alias("ids"))
