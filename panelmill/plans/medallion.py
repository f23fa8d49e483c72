"""Raw files to bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from panelmill.operators.cleaning import clean
from panelmill.operators.dataset import (
    SPLIT_60_20_20,
    SPLIT_70_15_15,
    assert_not_empty,
    model_dataset,
)
from panelmill.operators.orders import completed_orders
from panelmill.operators.profile import table_profile
from panelmill.plans.gold import GOLD_PARTITIONS, gold
from panelmill.schema import ENTITIES, SNAPSHOT, SPLIT
from panelmill.session import scratch_folder, size_tasks
from panelmill.sources.tables import read_entity_csv, staged, write_parquet, write_verified


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    out: DataFrame | None = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    if out is None:
        raise ValueError("no datasets")
    return out


def _side_by_side(write: Callable[[str], DataFrame], entities: Iterable[str], parallelism: int = 4) -> DataFrame:
    """Independent tables, whose writes are submitted together so that small ones fill the gaps of large ones."""
    with ThreadPoolExecutor(parallelism) as pool:
        return _union(list(pool.map(write, entities)))


def validate_raw(spark: SparkSession, raw: str, entity: str, file_name: str = "{}.csv") -> DataFrame:
    """Rows, columns, types and NULL counts of a raw file."""
    return table_profile(read_entity_csv(spark, f"{raw}/{file_name.format(entity)}", entity))


def ingest(
    spark: SparkSession, raw: str, bronze: str, entities: Iterable[str] = tuple(ENTITIES), file_name: str = "{}.csv"
) -> DataFrame:
    """Every raw file to parquet under the entity's name; the verification of each write."""
    return _side_by_side(
        lambda e: write_verified(read_entity_csv(spark, f"{raw}/{file_name.format(e)}", e), f"{bronze}/{e}", e), entities
    )


def refine(spark: SparkSession, bronze: str, silver: str, entities: Iterable[str] = tuple(ENTITIES)) -> DataFrame:
    """Bronze tables through their recipes; the verification of each write."""
    return _side_by_side(
        lambda e: write_verified(clean(spark.read.parquet(f"{bronze}/{e}"), e), f"{silver}/{e}", e), entities
    )


def stored_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {e: spark.read.parquet(f"{root}/{e}") for e in ENTITIES}


def build_gold(spark: SparkSession, silver: str, path: str, generation: str = "v3") -> DataFrame:
    """Feature table of one generation, written in its partitions and read back.

    The completed orders go to a table in the shared folder first, as three
    branches of the plan start from them; it is removed after the write.
    """
    tables = stored_tables(size_tasks(spark, silver), silver)
    with scratch_folder(spark):
        completed = staged(completed_orders(tables["orders"], tables["customers"]), "completed-orders")
        write_parquet(gold(tables, generation, completed=completed), path, GOLD_PARTITIONS[generation])
    return assert_not_empty(spark.read.parquet(path), f"gold {generation}")


def build_model_dataset(spark: SparkSession, gold_path: str, path: str, generation: str = "v3") -> DataFrame:
    """Dataset with a split column, in directories per split (v1, v2) or snapshot (v3)."""
    table = spark.read.parquet(gold_path)
    if generation == "v3":
        out, by = model_dataset(table, SPLIT_60_20_20), SNAPSHOT
    else:
        out, by = model_dataset(table, SPLIT_70_15_15, guard_last_dates=True), SPLIT
    write_parquet(out, path, [by])
    return spark.read.parquet(path)
