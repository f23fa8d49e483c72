"""Near-duplicate groups from SimHash fingerprints, found by Golay-code fuzzy hashing.

A fingerprint has 64 bits; a bit is set if it is set in more than half of the hashes of a text's
shingles, repeats included. Fingerprints of at most four differing bits are linked.

The bits are cut into three segments of at most 23, and the perfect [23, 12] Golay code gives each
segment the indices of the codewords nearby: the one within three errors, and, where that is
exactly three away, the five at distance four. So a segment has one or six indices of 12 bits. Two
segments with up to two differing bits share an index; with one differing bit, the nearest
codeword of either is among the indices of the other.

Four errors over three segments leave two cases (pigeonhole), each with keys of its own:

* a segment is free of errors, and one of the others has two or less: its bits with an index of the
  other, for either other (33 bits and more, 6 to 36 keys);
* two have one at most, the third two at most: an index of each (36 bits, 1 to 216 keys). It is asked
  for with the nearest codeword of two segments and any index of the third (3 to 18 probes).

Equal fingerprints are one class first. Keys of a class meet in lists. The members of a list meet
its least probe, the hub, not one another; links found join classes to groups. Lists that still hold
several groups draw other hubs, while all their pairs would be many times their members; at last what is
left in different groups meets in pairs, so no link is lost. Every meeting is verified by the
number of differing bits, on the fingerprints themselves.

Defined cases: a text without words, or null, has fingerprint zero and is linked like any other; a text of
fewer words than a shingle is one shingle; rows with one id are judged each by its own text; a row without
an id has its fingerprint and no component; an empty table gives no rows; long texts are hashed in runs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import map_texts, staged, utf8
from panelmill.llm.neardup import components

WORDS, SEED, BITS = 4, 42, 4
#: Segments as (first bit, number of bits).
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Shingles that are counted at once; fingerprints in a batch.
RUN = 65_536
#: All pairs of open lists are made when they are at most so many for each member; rounds of hubs until then, at most.
PAIRS_EACH, ROUNDS = 4, 6
# Fixed value: the generator polynomial of the binary Golay code.
_GENERATOR = 0b101011100011
#: Fingerprints whose keys one task makes.
TASK_FINGERPRINTS = 16_384


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bits that are set in more than half of the hashes of all shingles."""
    found = text.lower().split()
    if not found:
        return 0
    n = min(words, len(found))
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: len(found) - n + 1].tolist()
    ends = ends[n - 1 :].tolist()
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), RUN):
        run = [hashed(joined[a:b], SEED) for a, b in zip(starts[at : at + RUN], ends[at : at + RUN])]
        bits = np.unpackbits(np.array(run, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp (as a signed number) of each document."""

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, words) for t in utf8(rows.column("text"))], np.uint64)
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

        return do

    return map_texts(docs.select("doc_id", "text"), work, "doc_id bigint, fp bigint")


def _remainders(x: np.ndarray) -> np.ndarray:
    """Syndromes: what is left of 23 bits after division by the generator."""
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= np.where(x >> bit & 1, _GENERATOR << bit - 11, 0)
    return x


@lru_cache(maxsize=1)
def error_patterns() -> np.ndarray:
    """For each of 2048 syndromes the errors that lead to codewords nearby: nearest first, then those of four bits, or -1."""
    weight = np.bitwise_count(np.arange(1 << 23))
    out, held = np.full((2048, 6), -1, np.int64), np.zeros(2048, np.int64)
    for wanted in range(5):
        errors = np.flatnonzero(weight == wanted)
        for syndrome, error in zip(_remainders(errors).tolist(), errors.tolist()):
            out[syndrome, held[syndrome]] = error
            held[syndrome] += 1
    return out


def indices(segment: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Indices of the codewords near each segment, the nearest first; -1 where there are no more."""
    errors = patterns[_remainders(segment)]
    return np.where(errors >= 0, (segment[:, None] ^ errors) >> 11, -1)


def _joined(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All combinations of one entry of each (n, m) column, 12 bits each, and which are whole."""
    key, whole = np.zeros((len(columns[0]), 1), np.int64), np.ones((len(columns[0]), 1), bool)
    for c in columns:
        key = ((key[:, :, None] << 12) | np.maximum(c, 0)[:, None, :]).reshape(len(key), -1)
        whole = (whole[:, :, None] & (c >= 0)[:, None, :]).reshape(len(key), -1)
    return key, whole


def keys_of(fps: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and whether it is a probe, of every key of each fingerprint (unsigned)."""
    raw = [((fps >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [indices(r, patterns) for r in raw]
    rows, keys, probes = [], [], []

    def put(tag: int, key: np.ndarray, whole: np.ndarray, probe: bool | np.ndarray) -> None:
        at = np.nonzero(whole)
        rows.append(at[0])
        keys.append(key[at] | (tag << 56))
        probes.append(np.broadcast_to(probe, key.shape)[at])

    for tag, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        put(tag, (raw[i][:, None] << 12) | np.maximum(near[j], 0), near[j] >= 0, True)
    place = np.indices((6, 6, 6)).reshape(3, -1)
    put(6, *_joined(*near), ((place > 0).sum(axis=0) <= 1)[None, :])
    return tuple(map(np.concatenate, (rows, keys, probes)))


def keyed(classes: DataFrame) -> DataFrame:
    """key, fp and probe of every key of every fingerprint; tasks are cut by the number of fingerprints."""

    def run(batches):
        patterns = error_patterns()
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 512):
                part = fps[at : at + 512]
                row, key, probe = keys_of(part.view(np.uint64), patterns)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row]), pa.array(probe)], ["key", "fp", "probe"])

    dealt = classes.select("fp").repartition(max(1, -(-classes.count() // TASK_FINGERPRINTS)))
    return dealt.mapInArrow(run, "key bigint, fp bigint, probe boolean")


def by_lists(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on key, both sides sorted. Spark sizes keys by the fingerprints they are made of, some 183 times too low,
    and would send all hubs through the driver to every task."""
    return left.hint("merge").join(right.hint("merge"), "key")


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= BITS


def _linked(met: DataFrame) -> DataFrame:
    return staged(met.where(_near("fp", "hub")).select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct(), "links")


def _open_lists(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members, with their groups, of lists of several groups."""
    own = members.select("key", "fp", "probe").join(groups.toDF("fp", "grp"), "fp", "left").withColumn("grp", F.coalesce("grp", "fp"))
    several = own.groupBy("key").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).where("x <> y").select("key")
    return staged(by_lists(own, several), "open")


def _open_pairs(members: DataFrame) -> tuple[int, int]:
    """How many members open lists have, and how many pairs of a probe and a member of another group."""
    by_group = members.groupBy("key", "grp").agg(F.count("*").alias("n"), F.count_if("probe").alias("p"))
    sums = [F.sum(c).alias(c) for c in ("n", "p")]
    lists = by_group.withColumn("own", F.col("n") * F.col("p")).groupBy("key").agg(*sums, F.sum("own").alias("own"))
    found = lists.agg(F.sum("n"), F.sum(F.col("n") * F.col("p") - F.col("own"))).first()
    return found[0] or 0, found[1] or 0


def links(classes: DataFrame, pairs_each: int = PAIRS_EACH, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all fingerprints of at most four differing bits, and the groups of those linked."""
    keys = keyed(classes)
    hubs = keys.where("probe").groupBy("key").agg(F.min("fp").alias("hub"))
    met = staged(by_lists(keys, hubs).where("fp <> hub"), "met")
    found = _linked(met)
    groups = components(found)
    members = met.select("key", "fp", "probe").unionAll(met.select("key", F.col("hub").alias("fp"), F.lit(True)).distinct())
    for turn in range(rounds + 1):
        members = _open_lists(members, groups)
        n, pairs = _open_pairs(members)
        if not pairs:
            break
        if last := turn == rounds or pairs <= pairs_each * n:
            hubs = members.where("probe").select("key", F.col("fp").alias("hub"), F.col("grp").alias("own"))
        else:
            drawn = F.min_by(F.struct("fp", "grp"), F.xxhash64("key", "fp", F.lit(turn)))
            hubs = members.where("probe").groupBy("key").agg(drawn.alias("h")).select("key", F.col("h.fp").alias("hub"), F.col("h.grp").alias("own"))
        # the distance is part of the join: only links leave it
        new = _linked(by_lists(members, hubs).where((F.col("grp") != F.col("own")) & _near("fp", "hub")))
        if not new.isEmpty():
            found = found.unionAll(new)
            groups = components(found)
        if last:
            break
    return found, groups


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    marks = staged(fingerprints(docs, words), "fingerprints")
    classes = staged(marks.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-classes")
    _, groups = links(classes)
    placed = classes.join(groups.toDF("fp", "grp"), "fp", "left").withColumn("grp", F.coalesce("grp", "fp"))
    named = placed.groupBy("grp").agg(F.min("least").alias("component_id"))
    of_class = placed.join(named, "grp").select("fp", "component_id")
    out = marks.join(of_class, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))
