"""Repair of conversation structure: cheapest edits, by the auction algorithm for shortest paths.

A conversation should be an optional system turn and then user and assistant in turn, ending with
the assistant. Its rows and the four states of that pattern span a lattice: the node (i, state) has
i rows behind it. Its arcs are the edits of row i (Delete, Keep, Rerole), which lead to the next
layer, and Insert, which stays in the layer; all costs are small integers.

Every node has a price, at most the cost of an arc plus the price of its end. The auction holds one
path: its last node takes the best offer (cost plus price) of its arcs; where that is above its own
price, the price rises and the path is contracted by the node, otherwise the path is extended by the
arc. When it reaches the end, the price of the node it began at is the cheapest cost from there.
Arcs without slack between price and offer are tight. The trace takes, from the start, the tight
arc of the least letter; before it is taken its end is the origin of an auction too, since
a price is sure to be the full cost only for an origin; an arc that loses its tightness is passed over.

Conversations of any length are cut into blocks of ``BLOCK`` rows. Prices pass between blocks as four
numbers: once backward through the blocks of a conversation, which gives each block the prices at its
end, and once forward, which carries the state. Both passes stream narrow rows (a byte for each turn);
a task holds one block. Order, faults and blocks are DataFrame work: a range sort splits a
conversation over many tasks, and first occurrences are found by an aggregation that combines
before its shuffle. Only the digest of a repaired conversation, a hash of its whole text, has to
read that text in one stream; it holds one batch of rows.

Defined cases: null roles and texts are one space, so is a null id or turn in the damage mark; rows
without a turn come first; rows of one turn stand in the order of role and text; a null conv_id is a
conversation of its own; a role that begins with none of s, u, a is never kept as it is; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import staged

#: Costs of edits, and of a truncated row that isn't deleted.
RENAME, DELETE, INSERT, TRUNCATED_ROW = 1, 2, 5, 5
#: Rows of a block.
BLOCK = 64
START, SYSTEM, USER, ASSISTANT = range(4)
# which role may come next, and the state it leads to; a kept system turn may also come first
_NEED = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_NEVER = 10**9
#: Prices at the end of a conversation, before inserts: the pattern may be empty or end with the assistant.
END = (0, _NEVER, _NEVER, 0)
# A row is one letter: small letters for the initials s, u, a and others (o); capital if truncated; D if it has to go.
_WHITE = " \t\n\x0b\x0c\r"
_CONVERSATION = ["conv_id", "turn", "role", "text"]


class Lattice:
    """A block of rows, its prices, and the prices at its end; inserts after the last row only in the last block."""

    def __init__(self, codes: str, ends: tuple[int, ...], last: bool):
        self.codes, self.ends, self.last, self.n = codes, ends, last, len(codes)
        # a price may start at any bound that no arc undercuts: what the rows to come cost at least
        least = [min(ends)]
        for code in reversed(codes):
            least.append(least[-1] + (DELETE if code == "D" or code.isupper() else code == "o"))
        self.price = [[bound] * 4 for bound in reversed(least)] + [[0] * 4]

    def arcs(self, i: int, state: int) -> list[tuple[str, int, int, int]]:
        """Edit, cost and end of each arc, by edit; the arc out of the block has no letter."""
        need, then = _NEED[state]
        insert = ("I", INSERT, i, then)
        if i == self.n:
            return [("", self.ends[state], i + 1, START), insert] if self.last else [("", self.ends[state], i + 1, START)]
        code = self.codes[i]
        out = [("D", DELETE, i + 1, state), insert]
        if code != "D":
            extra, initial = TRUNCATED_ROW * code.isupper(), code.lower()
            if initial == need:
                out.append(("K", extra, i + 1, then))
            elif initial == "s" and state == START:
                out.append(("K", extra, i + 1, SYSTEM))
            out.append(("R", RENAME + extra, i + 1, then))
        return out

    def auction(self, i: int, state: int) -> int:
        """The price of a node, made exact."""
        price, path = self.price, [(i, state)]
        while path[-1][0] <= self.n:
            at, here = path[-1]
            offer, to = min((cost + price[j][q], (j, q)) for _, cost, j, q in self.arcs(at, here))
            if price[at][here] < offer:
                price[at][here] = offer
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[i][state]

    def trace(self, state: int) -> tuple[list[str], list[str], int, int]:
        """Edits and new roles of each row (inserts stand with the row that follows, or the last one), end state, cost."""
        at, total = 0, 0
        edits, roles, before = [], [], ["", ""]
        self.auction(at, state)
        while True:
            for letter, cost, j, q in self.arcs(at, state):
                if cost + self.price[j][q] == self.price[at][state] and (j > self.n or cost + self.auction(j, q) == self.price[at][state]):
                    break
            role = "-" if letter == "D" else "=" if letter == "K" else _NEED[state][0]
            if j > self.n:
                if edits and before[0]:
                    edits[-1], roles[-1] = edits[-1] + before[0], roles[-1] + before[1]
                return edits, roles, state, total
            before = [before[0] + letter, before[1] + role]
            total += cost
            if letter != "I":
                edits.append(before[0])
                roles.append(before[1])
                before = ["", ""]
            at, state = j, q


@lru_cache(maxsize=20_000)
def entry_prices(codes: str, ends: tuple[int, ...], last: bool) -> tuple[int, ...]:
    lattice = Lattice(codes, ends, last)
    return tuple(lattice.auction(0, state) for state in range(4))


@lru_cache(maxsize=20_000)
def traced(codes: str, ends: tuple[int, ...], last: bool, state: int) -> tuple[list[str], list[str], int, int]:
    return Lattice(codes, ends, last).trace(state)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults that a hash of conversation and turn sets; nulls are one space."""
    blank = F.lit(" ")
    mark = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        (F.crc32(mark.cast("binary")) % 20).alias("_way"),
    ).where("_way <> 0")
    text = F.when(F.col("_way") == 1, F.lit("")).when(F.col("_way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_way") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("_way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, which counts within tasks and grows with (conv_id, turn, role, text)."""
    keys = [F.col(c).asc_nulls_first() for c in _CONVERSATION]
    dealt = rows.select(*_CONVERSATION).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return staged(dealt.withColumn("pos", F.monotonically_increasing_id()), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """Ordered rows with ``fault`` (none, or the first of blank, duplicate, truncated), ``initial`` and ``code``."""
    marked = turns.withColumn("_sign", F.md5(F.col("text").cast("binary")))
    seen = marked.groupBy("conv_id", "role", "_sign").agg(F.min("pos").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    seen = seen.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_sign").alias("_s"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_sign") == F.col("_s"))
    body = F.rtrim(F.col("text"), F.lit(_WHITE))
    fault = (
        F.when(body == "", "blank")
        .when(F.col("pos") > F.col("_first"), "duplicate")
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated")
    )
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "D").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    found = marked.join(seen, same, "left").withColumn("fault", fault).withColumn("initial", initial)
    return found.withColumn("code", code).select(*_CONVERSATION, "pos", "fault", "initial", "code")


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """conv_id, block, first (position), codes: at most ``size`` neighbouring rows of a conversation."""
    held = rows.groupBy("conv_id", F.floor(F.col("pos") / size).alias("block")).agg(
        F.min("pos").alias("first"), F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows")
    )
    return held.select("conv_id", "block", "first", F.array_join(F.col("rows")["code"], "").alias("codes"))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def priced(found: DataFrame) -> DataFrame:
    """Blocks with the prices at their end; one pass backward over the blocks of each conversation."""
    names = ["conv_id", "block", "first", "codes", "ends", "last"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ends = object(), END
        for batch in batches:
            out = []
            for conv, block, first, codes in zip(*(c.to_pylist() for c in batch.columns)):
                last = conv != own
                own, ends = conv, END if last else ends
                out.append((conv, block, first, codes, ends, last))
                ends = entry_prices(codes, ends, last)
            yield _batch(out, names, types)

    dealt = found.select(*names[:4]).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return staged(dealt.mapInArrow(run, "conv_id bigint, block bigint, first bigint, codes string, ends array<bigint>, last boolean"), "prices")


def decided(prices: DataFrame) -> DataFrame:
    """Edits and new roles of each row of each block, and their cost; one pass forward."""
    names = ["conv_id", "block", "first", "edits", "roles", "cost"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = object(), START
        for batch in batches:
            out = []
            for conv, block, first, codes, ends, last in zip(*(c.to_pylist() for c in batch.columns)):
                own, state = conv, START if conv != own else state
                edits, roles, state, cost = traced(codes, tuple(ends), last, state)
                out.append((conv, block, first, edits, roles, cost))
            yield _batch(out, names, types)

    dealt = prices.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return dealt.mapInArrow(run, "conv_id bigint, block bigint, first bigint, edits array<string>, roles array<string>, cost bigint")


def repair(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Every edit in order of (conv_id, pos, at): edit, and the row it leaves as (role, text).

    A deleted row has the role null; an inserted one has no fault, initial or turn.
    """
    found = staged(faults(ordered(rows)), "faults")
    edits = decided(priced(blocks(found, size))).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "first", "edits", "roles")
    block = F.floor(F.col("pos") / size)
    both = found.join(edits, F.col("conv_id").eqNullSafe(F.col("_c")) & (block == F.col("_b")))
    place = (F.col("pos") - F.col("first") + 1).cast("int")
    own = both.withColumn("_e", F.element_at("edits", place)).withColumn("_r", F.element_at("roles", place))
    each = F.explode(F.sequence(F.lit(1), F.length("_e")))
    one = own.withColumn("at", each).withColumn("edit", F.expr("substring(_e, at, 1)")).withColumn("_new", F.expr("substring(_r, at, 1)"))
    inserted = F.col("edit") == "I"
    role = F.when(F.col("_new") == "u", "user").when(F.col("_new") == "a", "assistant").when(F.col("_new") == "=", F.col("role"))

    def original(c: str) -> Column:
        return F.when(~inserted, F.col(c)).alias(c)

    text = F.when(inserted, F.lit("")).when(F.col("edit") != "D", F.col("text"))
    return one.select("conv_id", "pos", "at", "edit", role.alias("role"), text.alias("text"), *map(original, ("fault", "initial", "turn")))


class _Digest:
    """What is known of one conversation from its edits in order."""

    def __init__(self):
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = 0
        self.last = self.low = self.high = None
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def add(self, edit, role, text, fault, initial, turn) -> None:
        self.audit.append(edit)
        if edit != "I":
            if fault:
                self.count[fault] += 1
            self.illegal += self.last is not None and self.last + initial not in ("su", "ua", "au")
            self.last = initial
            if turn is not None and turn != self.high:  # turns come in order
                self.turns += 1
                self.low, self.high = turn if self.low is None else self.low, turn
        self.cost += {"K": 0, "R": RENAME, "D": DELETE, "I": INSERT}[edit]
        if edit != "D":
            self.cost += TRUNCATED_ROW * (fault == "truncated")
            self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def row(self, conv) -> tuple:
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return conv, gaps, *self.count.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def digests(edits: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, audit and the hash of what is left."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None
        for batch in batches:
            out = []
            for conv, _, _, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or conv != own:
                    if digest is not None:
                        out.append(digest.row(own))
                    own, digest = conv, _Digest()
                digest.add(*row)
            yield _batch(out, names, types)
        if digest is not None:
            yield _batch([digest.row(own)], names, types)

    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "at")
    dealt = dealt.select("conv_id", "pos", "at", "edit", "role", "text", "fault", "initial", "turn")
    schema = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'string'}" for n, t in zip(names, types))
    return dealt.mapInArrow(run, schema)


def audited(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """Digests of the repairs of damaged conversations, for every id of the table."""
    found = digests(repair(damaged(conversations), size)).withColumnRenamed("conv_id", "_c")
    ids = conversations.select("conv_id").distinct()
    all_ids = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return all_ids.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )
