from __future__ import annotations

import pytest

from panelmill.llm import common as C
from tests.llm.helpers import documents, prose


def test_words_are_forgotten_by_bytes():
    made = []
    cache = C.WordCache(lambda w: made.append(w) or len(w), most=10 * (100 + C.ENTRY_BYTES))
    words = [f"{i:0100d}" for i in range(40)]
    assert cache.array(words, int).tolist() == [100] * 40
    assert len(cache) <= 10 and len(made) == 40
    assert cache["x" * 10_000_000] == 10_000_000 and len(cache) == 1  # a text without spaces is one word


def test_a_worker_holds_the_words_of_one_operator(monkeypatch):
    cleared = []
    monkeypatch.setattr(C, "_FORGET", [lambda: cleared.append(1)])
    monkeypatch.setattr(C, "_owner", None)
    for owner in ("a", "a", "b", "b", "a"):
        C.enter(owner)
    assert len(cleared) == 3


def test_smaller_batches_of_the_session_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for asked, kept in (("10000", C.BATCH_ROWS), ("0", C.BATCH_ROWS), ("64", 64)):
            spark.conf.set(key, asked)
            C.small_batches(spark)
            assert int(spark.conf.get(key)) == kept
    finally:
        spark.conf.set(key, before)


@pytest.fixture
def labelled(spark, tmp_path):
    """A repeated id with most rows, an id with both labels, nulls, and plain rows."""
    rows = [(1, prose(i, 5)) for i in range(300)] + [(i, prose(1000 + i, 5)) for i in range(2, 60)] + [(60, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2) for i in range(1, 61)] + [(2, 1), (3, None)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_labelled_sample_is_bounded_by_rows(spark, labelled):
    rows = C.labelled_sample(spark, labelled, "quality", 4, 2, 20)
    for label in (0, 1):
        assert 0 < sum(r["y"] == label for r in rows) <= 20
    whole = C.labelled_sample(spark, labelled, "quality", 4, 2, 10_000)
    ids = {r["doc_id"] for r in whole}
    assert 2 not in ids and 60 not in ids  # both labels; no text
    assert {r["y"] for r in whole if r["doc_id"] == 3} <= {1}
    assert len(whole) == len({(r["doc_id"], r["text"]) for r in whole})
