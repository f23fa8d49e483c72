from __future__ import annotations

import corpus_pipeline
from __spark_entry__ import queries
from check import compare, connect
import pytest

from panelmill.llm import decontaminate, neardup, packing, pii
from panelmill.llm.queries import QUERIES
from panelmill.llm.sql import SQL
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD, documents, prose


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_SMALL), SF_SMALL, name).startswith("ok")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries())


def test_stages_take_effect_one_after_another(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, SF_SMALL), "stage")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == before.columns and docs.count() <= before.count()
    assert list(seen) == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert seen["near_duplicates"].count() == seen["language"].select("doc_id").distinct().count() - (
        neardup.near_duplicates(seen["language"], words=5).where("not kept").count()
    )
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert decontaminate.scan(seen["near_duplicates"], benchmark).where("n_hit > 0").count() > 0
    assert decontaminate.scan(seen["decontamination"], benchmark).where("n_hit > 0").isEmpty()
    assert not any(pii.base_spans(r["text"]) for r in seen["personal_data"].collect())
    last = seen["personal_data"].count()
    assert seen["packing"].select("doc_id").distinct().count() == last
    own = packing.Tokenizer(packing.tokenizer_json())
    for r in seen["personal_data"].limit(5).collect():
        pieces = seen["packing"].where(seen["packing"]["doc_id"] == r["doc_id"]).orderBy("start").collect()
        assert [i for p in pieces for i in p["ids"]] == [*own.encode([r["text"].encode()])[0].tolist(), packing.END_ID]


def test_language_stage_rejects_only_texts_without_letters(spark):
    rows = [*ODD, *[(40 + i, f"the {w} and then of it", "en") for i, w in enumerate("abc")]]
    kept = corpus_pipeline.known_language(spark, documents(spark, rows), SF_SMALL).collect()
    assert {r["doc_id"] for r in kept} == {5, 6, 7, None, 40, 41, 42}
    assert all(r["lang"] == "en" for r in kept)


def through_all_stages(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), "stage")
    return docs


def test_empty_table_goes_through_all_stages(spark):
    assert through_all_stages(spark, documents(spark, [])).collect() == []


def test_odd_rows_go_through_all_stages(spark):
    """Null and repeated ids, a text of megabytes, and columns named like results."""
    long = prose(8, 400_000)
    rows = [*ODD, (50, long, "en"), (51, prose(3, 60), "en"), (51, prose(4, 60), "en"), (52, prose(3, 60), None)]
    packed = through_all_stages(spark, documents(spark, rows, extra=True))
    own = packing.Tokenizer(packing.tokenizer_json())
    pieces = packed.where("doc_id = 50").orderBy("start").collect()
    assert [i for p in pieces for i in p["ids"]] == [*own.encode([long.encode()])[0].tolist(), packing.END_ID]
    # 52 is a copy of one text of 51; the other text of 51 stays on its own
    assert packed.where("doc_id = 51 and start = 0").count() == 2 and packed.where("doc_id = 52").isEmpty()


def test_without_any_given_language_texts_with_letters_stay(spark):
    docs = documents(spark, [(1, "some words"), (2, "12 34"), (3, None), (4, "été")], extra=True)
    kept = corpus_pipeline.known_language(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 4}
    assert all(r["score"] == r["lang_pred"] == "x" and r["lang"] is None for r in kept.collect())
