"""Named queries of this package over the test tables, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.llm import centroids, chat, decontaminate, language, lmscore, neardup, packing, pii, quality, repair, rules, simhash, toxicity
from panelmill.llm.common import held_out, labelled_sample, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: A conversation of its own in ``op10_chat_formatting``: both texts try to end their turn.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~held_out(3, 1))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def _scored(found: DataFrame, threshold: float) -> DataFrame:
    return found.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.fit(labelled_sample(spark, sf_dir, "quality", 4, 2, quality.SAMPLE_ROWS))
    return _scored(quality.score(table(spark, sf_dir, "documents"), model), quality.THRESHOLD)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit(labelled_sample(spark, sf_dir, "toxic", 4, 2, toxicity.SAMPLE_ROWS))
    return _scored(toxicity.score(table(spark, sf_dir, "documents"), model), toxicity.THRESHOLD)


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _listed(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    kinds = F.col("base_spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_listed("base_spans").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans")
    )


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.cascade(table(spark, sf_dir, "documents"), counts=True).drop("rejected_by")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id")
    return lmscore.score(docs, *lmscore.fit(docs, good))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], conversations.schema)
    return chat.digests(chat.format_chat(chat.text_parts(conversations.unionAll(own))))


@query
def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(table(spark, sf_dir, "conversations"))


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))
