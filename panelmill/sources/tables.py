"""Table input and output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.functions.columns import standardize_columns
from panelmill.operators.cleaning import require_columns
from panelmill.schema import ENTITIES, FEATURES
from panelmill.session import scratch_path

CORRUPT = "_malformed"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    keep_malformed: bool = False,
    mode: str = "PERMISSIVE",
    **options: Any,
) -> DataFrame:
    """CSV with a header line.

    With a schema, columns go by position. Without one they go by the header and
    are text, or typed by an extra pass over the data with ``infer``. In
    permissive mode a malformed line becomes NULLs; ``keep_malformed`` adds its
    text in a column of its own, for which a schema is needed.
    """
    reader = spark.read.option("header", True).option("mode", mode).options(**options)
    if schema is None:
        if keep_malformed:
            raise ValueError("keeping malformed lines needs a schema")
        return reader.option("inferSchema", infer).csv(path)
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_entity_csv(spark: SparkSession, path: str, entity: str, **options: Any) -> DataFrame:
    """Raw file of one entity: columns by the header, all text, so cleaning sees what was written."""
    df = standardize_columns(read_csv(spark, path, **options))
    return require_columns(df, list(ENTITIES[entity].columns), f"{entity} columns")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else require_columns(df, columns).select(*columns)


def read_part(spark: SparkSession, path: str, **partition: Any) -> DataFrame:
    """One partition of a table by value; the predicate prunes directories."""
    df = spark.read.parquet(path)
    for column, value in partition.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", refresh: str = "all"
) -> str:
    """Parquet, optionally in directories per partition value.

    An overwrite replaces the whole table; with ``refresh="partitions"`` only the partitions
    that the rows belong to. The choice goes with the write, whatever the session says.

    Rows are rebalanced on the partition columns first, so few files are written
    per directory; unlike a plain repartition, adaptive execution splits a value
    that holds a large share of the rows over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if refresh not in ("all", "partitions"):
        raise ValueError(f"refresh is all or partitions, not {refresh}")
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static" if refresh == "all" else "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder.

    For results that several jobs start from: it cuts the lineage, is computed
    once, and survives the loss of executors, which a cache does not.
    """
    return df.sparkSession.read.parquet(write_parquet(df, scratch_path(df.sparkSession, name)))


def read_back(spark: SparkSession, path: str, name: str, columns: int, rows: int) -> DataFrame:
    """Row and column counts as stored against those expected, one row."""
    stored = spark.read.parquet(path)
    return stored.agg(F.count("*").alias("verified_rows")).select(
        F.lit(name).alias("dataset"),
        F.lit(rows).cast("long").alias("rows"),
        F.lit(columns).alias("columns"),
        "verified_rows",
        F.lit(len(stored.columns)).alias("verified_columns"),
    )


def write_verified(df: DataFrame, path: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write, then compare what is stored with what was sent.

    The rows sent are counted by an observation riding on the write itself, so
    the plan runs once.
    """
    sent = Observation(f"sent-{name}")
    write_parquet(df.observe(sent, F.count(F.lit(1)).alias("rows")), path, partition_by)
    return read_back(df.sparkSession, path, name, len(df.columns), sent.get["rows"])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: Any) -> str:
    """CSV with a header line. Tables that only later steps read are better compressed (``compression="gzip"``)."""
    df.write.mode(mode).option("header", True).options(**options).csv(path)
    return path


def write_json_record(spark: SparkSession, path: str, record: Mapping[str, Any]) -> str:
    """One document as one JSON line."""
    spark.createDataFrame([Row(**record)]).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_scoring_batch(spark: SparkSession, path: str, features: Sequence[str] = FEATURES) -> DataFrame:
    """A CSV to score. Columns go by the header and stay text until the row checks ran."""
    return require_columns(read_csv(spark, path), features, "features")


def inline_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(rows), list(names))
