"""A training corpus from raw documents: language, near copies, benchmark passages, personal data, packing.

Defined cases: null and empty texts have no letters and go with the first stage; rows without an id are
documents of their own; of equal rows with one id one stays, and different texts of one id are judged
each; further columns are carried as they are up to packing, also those named like a result of a
stage; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.llm import decontaminate, language, neardup, packing, pii
from panelmill.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Documents with a language; where none is given, the predicted one.

    A document without letters, or on which the likeliest language has a posterior below ``least``, goes.
    Where no row gives a language nothing can be predicted, and every document with a letter stays.
    """
    model = language.fit(docs, F.lit(True))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own = {c: f"_own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = language.identify(docs.withColumnsRenamed(own), model)
    kept = found.where((F.col("lang_pred") != language.UNDECIDED) & (F.col("score") >= least))
    named = kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return named.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group that 0.8 of their shingles of five words link."""
    return neardup.deduplicated(docs, words=5, similarity=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is nothing else goes."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="spans")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked by their kind."""
    return pii.masked(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: No SQL: languages, personal data and windows are decided by fitted models and a heuristic.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
