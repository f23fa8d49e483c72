"""Ranges of a feature's values whose rows all have one label: signs of a leak, found without naming a column.

Rows become one cell for each (feature, value), with its rows and positives; equal values combine before the
shuffle. Cells are stored in ranges of (feature, value). Inside a range neighbouring cells of one
kind (all positive, all negative, mixed) are put together to runs; a run that ends with its range goes on in the
next one, and only those border runs, at most two for each range and feature, meet in one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.operators.cleaning import require_columns
from panelmill.schema import FEATURES, TARGET
from panelmill.sources.tables import staged

MIXED = -1


def pure_runs(df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, digits: int | None = None) -> DataFrame:
    """feature, label, low, high, rows: every longest run of neighbouring values with one label; missing values are left out.

    ``digits`` rounds the values first, so that sums that differ in their last bits are one value.
    """
    require_columns(df, [*features, target], "features and target")

    def value(name: str):
        number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        return number if digits is None else F.round(number, digits)

    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), value(f).alias("value")) for f in features])
    long = df.select(F.col(target).alias("_y"), F.inline(pairs)).where("value is not null and _y is not null")
    cells = long.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("_y").alias("pos"))
    kind = F.when(F.col("pos") == F.col("n"), 1).when(F.col("pos") == 0, 0).otherwise(MIXED)
    cells = staged(
        cells.withColumn("label", kind).repartitionByRange("feature", "value").withColumn("_range", F.spark_partition_id()), "pure-cells"
    )
    inside = Window.partitionBy("feature", "_range").orderBy("value")
    new = F.coalesce(F.col("label") != F.lag("label").over(inside), F.lit(True)).cast("int")
    runs = (
        cells.withColumn("_new", new)
        .withColumn("_run", F.sum("_new").over(inside))
        .groupBy("feature", "_range", "_run", "label")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("rows"))
        .withColumn("_last", F.max("_run").over(Window.partitionBy("feature", "_range")))
    )
    at_border = (F.col("_run") == 1) | (F.col("_run") == F.col("_last"))
    across = Window.partitionBy("feature").orderBy("_range", "_run")  # at most two rows for each range
    apart = (F.col("label") != F.lag("label").over(across)) | (F.col("_range") == F.lag("_range").over(across))
    border = (
        runs.where(at_border)
        .withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_whole", F.sum("_new").over(across))
        .groupBy("feature", "_whole", "label")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"))
    )
    columns = ["feature", "label", "low", "high", "rows"]
    return border.select(*columns).unionByName(runs.where(~at_border).select(*columns)).where(F.col("label") != MIXED)


def purest_ranges(
    df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, least_share: float = 0.01, digits: int | None = None
) -> DataFrame:
    """The largest pure run of each feature and label, where it has at least ``least_share`` of all rows."""
    best = pure_runs(df, features, target, digits).groupBy("feature", "label").agg(
        F.max_by(F.struct("low", "high", "rows"), F.struct("rows", -F.col("low"))).alias("r")
    )
    total = df.agg(F.count("*").alias("_all"))  # one row
    found = best.select("feature", "label", "r.*").crossJoin(F.broadcast(total))
    return found.where(F.col("rows") >= F.lit(least_share) * F.col("_all")).drop("_all")
