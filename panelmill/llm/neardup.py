"""Near-duplicate groups from bottom-k sketches.

A document is the set of its distinct shingles (runs of ``words`` words; all its words, if there
are fewer). Every shingle has one 64-bit hash, and the k smallest of a set are its sketch.

1. Documents of one set are one class, stood for by its smallest id; all else is on classes.
2. Inverted lists of the retained values. Two sets as similar as asked for share at least
   ``shared`` of the k smallest values of their union, so they share one of the
   ``k - shared + 1`` rarest values of either sketch. Only those are listed: values that are
   in very many sketches are in a list only of documents that have little else. Where the first
   value that two have in common stands too late in either order for enough others to follow,
   they don't meet. Sets of up to 0.8 k shingles have sketches without loss, and there both rules
   are exact.
3. A list gives pairs of a hub with each other member, not all pairs: first the smallest id.
   Links found join groups; a list within one group is done. Documents of lists that are in
   several groups get finer sketches (``FINE``), which leave few of them in a list together; there
   hubs are drawn by a hash, and only members still in different groups meet in pairs, each pair in
   the first list that both are in and in no other.
4. Of a pair, the sketches are merged to the sketch of the union, and the share of it in both
   estimates the similarity; pairs clearly below are left out. The others are confirmed on the
   full sets.
5. Groups are the connected components of links: within tasks first, then by rounds of large and
   small stars.

For sets of more than 0.8 k shingles, the chance that a link of exactly the asked similarity is
missed by 2 or 4 is that of fewer than ``shared`` hits in k draws of 0.8: below 1e-6 for either k.

Nothing is collected; groups of copies of any size combine before a shuffle or are on the
sides of joins that adaptive execution splits. Results that later steps start from are tables in
the shared folder.

Defined cases: a document without words, or null, has an empty set and is its own group; so is a
row without an id, with no component id; rows with one id are judged each by its own text, and
an id's rows are one document in a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import WordCache, map_texts, ngram_hashes, remembered, staged, utf8

#: Size of a sketch, and how many values of the union's sketch a linked pair has in common at least.
K, SHARED = 64, 34
FINE, FINE_SHARED = 512, 364
#: Similarity of a link in hundredths.
SIMILARITY = 80
#: Rounds of drawn hubs before members of different groups meet in pairs.
DRAWN_ROUNDS = 1
#: Links that one task joins.
TASK_LINKS = 250_000

_words = WordCache(xxhash.xxh64_intdigest)
remembered(_words.clear)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    ids = _words.array(text.lower().split(), np.uint64)
    return np.unique(ngram_hashes(ids, min(words, len(ids)))) if len(ids) else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, words: int, k: int = K) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (of equal sets) and sketch (values as signed numbers) of each document."""

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t, words) for t in utf8(rows.column("text"))]
            kept = [s[:k].view(np.int64) for s in sets]
            offsets = np.cumsum([0, *map(len, kept)], dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *kept]))),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_id", "sketch"],
            )

        return do

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_texts(rows, work, "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, sketch array<bigint>")


def _resketched(texts: DataFrame, words: int, k: int) -> DataFrame:
    """rep, n and sketch of the k smallest values, from texts."""
    rows = texts.select(F.col("rep").alias("doc_id"), "text")
    return sketches(rows, words, k).select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch")


def listed_values(classes: DataFrame, k: int, shared: int, similarity: int, before: bool = False) -> DataFrame:
    """value, rep, n, rest: the rarest values of each sketch, as many as one in common is sure for a link.

    ``rest`` is how many values of the sketch come after it in the order by rarity; with ``before``
    there are also the listed values that come before it.
    """
    values = classes.select("rep", "n", F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    known = values.join(often, "value").groupBy("rep", "n").agg(F.collect_list(F.struct("often", "value")).alias("found"))
    size = F.least("n", F.lit(k))
    common = F.when(F.col("n") * 100 <= k * similarity, F.ceil(F.col("n") * similarity / 100)).otherwise(F.lit(shared))
    # values of this sketch alone come first in the order, and link nothing
    take = (size - common + 1 - (size - F.size("found"))).cast("int")
    earlier = [F.slice(F.col("listed")["value"], F.lit(1), F.col("at")).alias("before")] if before else []
    return (
        known.withColumn("take", take)
        .where("take > 0")
        .withColumn("last", F.size("found") - 1)
        .withColumn("listed", F.slice(F.array_sort("found"), F.lit(1), F.greatest("take", F.lit(0))))
        .select("rep", "n", "last", "listed", F.posexplode(F.col("listed")["value"]).alias("at", "value"))
        .select("value", "rep", "n", (F.col("last") - F.col("at")).alias("rest"), *earlier)
    )


def _may_link(k: int, shared: int, similarity: int, n: Column, rest: Column, other_n: Column, other_rest: Column) -> Column:
    """Whether two members of a list can be linked, if its value is the first that they have in common."""
    sizes = F.least(n, other_n) * 100 >= F.greatest(n, other_n) * similarity
    exact = F.ceil((n + other_n) * similarity / (100 + similarity))
    need = F.when(F.greatest(n, other_n) <= k, exact).otherwise(F.lit(shared))
    return sizes & (F.least(rest, other_rest) + 1 >= need)


def _estimated(pairs: DataFrame, classes: DataFrame, k: int, shared: int, similarity: int) -> DataFrame:
    """Pairs whose sketches don't rule out a link: exact on sets that are whole in their sketches."""
    side = classes.select("rep", "n", "sketch")
    both = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
    common = F.array_intersect("sa", "sb")
    whole = F.greatest("na", "nb") <= k
    exact = F.size(common) * (100 + similarity) >= similarity * (F.col("na") + F.col("nb"))
    union = F.slice(_unsigned_order(F.array_union("sa", "sb")), 1, k)
    return both.where(F.when(whole, exact).otherwise(F.size(F.array_intersect(union, common)) >= shared)).select("a", "b")


def _unsigned_order(values: Column) -> Column:
    """Hashes are kept as signed numbers; their order is that of unsigned ones."""
    return F.concat(
        F.array_sort(F.filter(values, lambda x: x >= 0)), F.array_sort(F.filter(values, lambda x: x < 0))
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""

    def work():
        last: list = [None, None]

        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            ids = rows.column("a").to_pylist()
            for a, ta, tb in zip(ids, utf8(rows.column("ta")), utf8(rows.column("tb")), strict=True):
                if last[0] != a:
                    last[:] = [a, shingles(ta, words)]
                one, other = last[1], shingles(tb, words)
                common = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * common >= similarity * (len(one) + len(other) - common))
            return pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return do

    both = pairs.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
    return map_texts(both.select("a", "b", "ta", "tb"), work, "a bigint, b bigint", text="tb")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task as (node, smallest node that they connect it with)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    pairs = [(x, root) for x in parent if (root := find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node, component (smallest node reachable) of every node in links (a, b).

    Each task joins a bounded number of links first. If there is more than one task, rounds of
    large and small stars join what they found.
    """
    tasks = max(1, -(-links.count() // task_links))
    edges = staged(links.select("a", "b").repartition(tasks).mapInArrow(_stars, "u bigint, v bigint"), "edges")
    if tasks == 1:
        return edges.toDF("node", "component")
    before = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = staged(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")


def _grouped(lists: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Lists with the group of each member, without lists that are within one group."""
    lists = lists.drop("grp")
    if groups is None:
        members = lists.select(*lists.columns, F.col("rep").alias("grp"))
    else:
        members = lists.join(groups.toDF("rep", "component"), "rep", "left")
        members = members.select(*lists.columns, F.coalesce("component", "rep").alias("grp"))
    several = members.groupBy("value").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).where("x <> y").select("value")
    return staged(members.join(several, "value"), "lists")


def _hub_pairs(members: DataFrame, by: Column, rule: tuple[int, int, int]) -> DataFrame:
    hubs = members.groupBy("value").agg(F.min_by(F.struct("rep", "n", "rest", "grp"), by).alias("hub"))
    near = _may_link(*rule, F.col("n"), F.col("rest"), F.col("hub.n"), F.col("hub.rest"))
    met = members.join(hubs, "value").where((F.col("grp") != F.col("hub.grp")) & near)
    return met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()


def _all_pairs(members: DataFrame, rule: tuple[int, int, int]) -> DataFrame:
    """Pairs of members of a list in different groups, each in the first list that both are in."""
    columns = ["value", "rep", "n", "rest", "before", "grp"]
    members = members.select(*columns)
    other = members.toDF("value", "b", "nb", "rest_b", "before_b", "grp_b")
    near = _may_link(*rule, F.col("n"), F.col("rest"), F.col("nb"), F.col("rest_b"))
    apart = (F.col("rep") < F.col("b")) & (F.col("grp") != F.col("grp_b"))
    met = members.join(other, "value").where(apart & near & ~F.arrays_overlap("before", "before_b"))
    return met.select(F.col("rep").alias("a"), "b")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    similarity: int = SIMILARITY,
    k: int = K,
    shared: int = SHARED,
    fine: tuple[int, int] = (FINE, FINE_SHARED),
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the document is the smallest of its component) for every row."""
    marks = staged(sketches(docs, words, k), "sketches")
    found = marks.where("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = staged(found.select("set_id", F.col("least.doc_id").alias("rep"), F.col("least.text_hash").alias("text_hash"), "n", "sketch"), "classes")
    lists = staged(listed_values(classes, k, shared, similarity), "listed")
    members = _grouped(lists, None)
    chosen = members.select("rep").distinct().join(classes.select("rep", "text_hash"), "rep")
    texts = staged(
        docs.select(F.col("doc_id").alias("rep"), "text", F.xxhash64("text").alias("text_hash"))
        .join(chosen, ["rep", "text_hash"])
        .dropDuplicates(["rep", "text_hash"])
        .select("rep", "text"),
        "texts",
    )

    def links_of(pairs: DataFrame) -> DataFrame:
        likely = _estimated(pairs, classes, k, shared, similarity)
        return staged(_confirmed(likely, texts, words, similarity), "links")

    links = links_of(_hub_pairs(members, F.col("rep"), (k, shared, similarity)))
    groups = components(links)
    contested = _grouped(members, groups).select("rep").distinct()
    finer = staged(_resketched(texts.join(contested, "rep"), words, fine[0]), "finer")
    members, rule = listed_values(finer, *fine, similarity, before=True), (*fine, similarity)
    for turn in range(DRAWN_ROUNDS + 1):
        members = _grouped(members, groups)
        if members.isEmpty():
            break
        drawn = turn < DRAWN_ROUNDS
        new = links_of(_hub_pairs(members, F.xxhash64("value", "rep", F.lit(turn)), rule) if drawn else _all_pairs(members, rule))
        if not new.isEmpty():
            links = links.unionAll(new)
            groups = components(links)
    placed = classes.select("set_id", "rep").join(groups.toDF("rep", "component"), "rep", "left")
    placed = placed.select("set_id", F.coalesce("component", "rep").alias("component"))
    joined = marks.select("doc_id", "n_shingles", "set_id").join(placed, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _apart(docs: DataFrame) -> DataFrame | None:
    """doc_id, text_hash and a number of its own below all ids, for every further text of a repeated id."""
    texts = docs.where("doc_id is not null").select("doc_id", "text_hash").distinct()
    first = texts.groupBy("doc_id").agg(F.min("text_hash").alias("first"), F.count("*").alias("n")).where("n > 1")
    further = texts.join(first.select("doc_id", "first"), "doc_id").where("text_hash <> first")
    further = staged(further.select("doc_id", "text_hash", F.monotonically_increasing_id().alias("at")), "further")
    least = further.agg(F.min("doc_id").alias("least")).first()["least"]
    if least is None:
        return None
    least = min(0, docs.agg(F.min("doc_id").alias("least")).first()["least"])
    return further.select("doc_id", "text_hash", (F.lit(least - 1) - F.col("at")).alias("own"))


def deduplicated(docs: DataFrame, words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The documents without those that are near copies of one with a smaller id.

    Of equal rows one stays. Different texts of one id are documents of their own: each is judged by
    its text, and only near copies go. Rows without an id stay.
    """
    columns = docs.columns
    hashed = docs.withColumn("_th", F.xxhash64("text"))
    names = hashed.select("doc_id", F.col("_th").alias("text_hash"), "text")
    further = _apart(names)
    if further is None:
        found = near_duplicates(docs, words, similarity).where("kept and doc_id is not null").select("doc_id").distinct()
        named = hashed.join(found, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    else:
        own = names.where("doc_id is not null").join(further, ["doc_id", "text_hash"], "left").withColumn("own", F.coalesce("own", "doc_id"))
        found = near_duplicates(own.select(F.col("own").alias("doc_id"), "text"), words, similarity).distinct()
        of = own.select("own", "doc_id", "text_hash").distinct().join(found.select(F.col("doc_id").alias("own"), "component_id"), "own")
        stay = of.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("s")).select("s.*")
        stay = stay.select("doc_id", F.col("text_hash").alias("_th"))
        named = hashed.join(stay, ["doc_id", "_th"], "left_semi").dropDuplicates(["doc_id", "_th"])
    return named.select(*columns).unionByName(docs.where("doc_id is null"))
