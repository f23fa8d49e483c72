"""Tasks in proportion to the stored input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelmill import session as S
from panelmill.catalog.queries import QUERIES

FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def settings(spark):
    keys = (FIRST, LEAST, *S.TASK_BYTES)
    before = {k: spark.conf.get(k, None) for k in keys}
    yield spark.conf
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partitions_follow_the_input_and_more_of_them_stay(spark, settings, monkeypatch, tmp_path):
    spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).write.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(S, "INPUT_PER_PARTITION", 10_000)
    settings.set("spark.sql.files.maxPartitionBytes", "1m")
    S.size_tasks(spark, str(tmp_path), f"{tmp_path}/none")
    found = int(settings.get(FIRST))
    assert found > 30
    assert settings.get("spark.sql.files.maxPartitionBytes") == "1m"
    settings.set(FIRST, str(found + 1))
    S.size_tasks(spark, str(tmp_path))
    assert settings.get(FIRST) == str(found + 1)


def test_no_task_of_a_query_reads_more_than_its_share(spark, settings, monkeypatch):
    """With four shuffle partitions, a quarter of the rows came to each task of the last aggregation."""
    monkeypatch.setattr(S, "INPUT_PER_PARTITION", 2_000)
    monkeypatch.setitem(S.TASK_BYTES, "spark.sql.adaptive.advisoryPartitionSizeInBytes", 2_000)
    settings.set(LEAST, "1b")
    df = QUERIES["gold_v1"](spark, SMALL)
    assert df.rdd.getNumPartitions() > 8
