"""From the feature table to a modelling dataset: splits by time, leakage checks."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.operators.cleaning import require_columns
from panelmill.schema import CUSTOMER, FUTURE_COLUMNS, ID_COLUMNS, SNAPSHOT, SPLIT, TARGET, TIME_COLUMNS

SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class SplitSpec:
    """Shares of the distinct snapshot dates that end the training and validation periods."""

    train_until: float
    validation_until: float
    min_dates: int = 1


SPLIT_70_15_15 = SplitSpec(0.70, 0.85)
SPLIT_60_20_20 = SplitSpec(0.60, 0.80, min_dates=10)


def complete_horizon(df: DataFrame, horizon_days: int = 90) -> DataFrame:
    """Keep snapshots at least one horizon before the last snapshot."""
    last = df.agg(F.date_sub(F.max(SNAPSHOT), horizon_days).alias("_cut"))
    # one aggregate row, so the broadcast is bounded
    return df.crossJoin(F.broadcast(last)).where(F.col(SNAPSHOT) <= F.col("_cut")).drop("_cut")


def split_cuts(df: DataFrame, spec: SplitSpec = SPLIT_60_20_20) -> DataFrame:
    """One row with the boundary dates of the split.

    Positions are counted over distinct dates, ``int(n * share)``, and dates are
    few (months), so ranking them in one window is safe after ``distinct``.
    """
    dates = df.select(SNAPSHOT).distinct()
    ranked = dates.select(
        SNAPSHOT,
        F.row_number().over(Window.partitionBy().orderBy(SNAPSHOT)).alias("_pos"),
        F.count("*").over(Window.partitionBy()).alias("_n"),
    )

    def position(share: float):
        cut = F.floor(F.col("_n") * F.lit(share))
        # a cut before the first date wraps round to the last one
        return F.when(cut == 0, F.col("_n")).otherwise(cut)

    def last_of(share: float):
        return F.max(F.when(F.col("_pos") <= position(share), F.col(SNAPSHOT)))

    def first_after(share: float):
        return F.min(F.when(F.col("_pos") > position(share), F.col(SNAPSHOT)))

    return ranked.agg(
        F.count("*").alias("n_dates"),
        last_of(spec.train_until).alias("train_end"),
        first_after(spec.train_until).alias("validation_start"),
        last_of(spec.validation_until).alias("validation_end"),
        first_after(spec.validation_until).alias("test_start"),
    )


def chronological_split(df: DataFrame, spec: SplitSpec = SPLIT_60_20_20) -> DataFrame:
    """Label rows train, validation or test by the position of their date.

    Too few dates make the query fail when it runs, without a pass of its own.
    """
    cuts = split_cuts(df, spec).select(
        "train_end",
        "validation_end",
        F.when(F.col("n_dates") >= spec.min_dates, True)
        .otherwise(
            F.raise_error(
                F.concat(F.lit("not enough snapshot dates for a split by time: "), F.col("n_dates").cast("string"))
            ).cast("boolean")
        )
        .alias("_enough"),
    )
    label = (
        F.when(F.col(SNAPSHOT) <= F.col("train_end"), "train")
        .when(F.col(SNAPSHOT) <= F.col("validation_end"), "validation")
        .otherwise("test")
    )
    return (
        df.crossJoin(F.broadcast(cuts))  # one aggregate row
        .where("_enough")
        .withColumn(SPLIT, label)
        .drop("train_end", "validation_end", "_enough")
    )


def split_by_dates(
    df: DataFrame, train_end: str, validation_start: str, validation_end: str, test_start: str
) -> DataFrame:
    """Label rows by fixed dates; rows in no period are dropped."""
    day = F.col(SNAPSHOT)
    label = (
        F.when(day <= F.lit(train_end).cast("date"), "train")
        .when(
            (day >= F.lit(validation_start).cast("date")) & (day <= F.lit(validation_end).cast("date")),
            "validation",
        )
        .when(day >= F.lit(test_start).cast("date"), "test")
    )
    return df.withColumn(SPLIT, label).where(F.col(SPLIT).isNotNull())


def split_frames(df: DataFrame) -> dict[str, DataFrame]:
    """The three parts without their label."""
    return {s: df.where(F.col(SPLIT) == s).drop(SPLIT) for s in SPLITS}


def concat_splits(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_distribution(df: DataFrame) -> DataFrame:
    """Rows per split and target value."""
    return df.groupBy(SPLIT, TARGET).agg(F.count("*").alias("rows"))


def split_ranges(df: DataFrame) -> DataFrame:
    """Rows, date range and target rate per split."""
    return df.groupBy(SPLIT).agg(
        F.count("*").alias("rows"),
        F.min(SNAPSHOT).alias("min_date"),
        F.max(SNAPSHOT).alias("max_date"),
        F.avg(TARGET).alias("churn_rate"),
    )


def split_completeness(df: DataFrame) -> DataFrame:
    """One row: split sizes, total, and whether they add up."""
    sizes = [F.count_if(F.col(SPLIT) == s).alias(f"{s}_rows") for s in SPLITS]
    counted = df.agg(*sizes, F.count("*").alias("total_rows"))
    together = sum((F.col(f"{s}_rows") for s in SPLITS[1:]), F.col(f"{SPLITS[0]}_rows"))
    return counted.withColumn("complete", (together == F.col("total_rows")).cast("int"))


def assert_complete_split(df: DataFrame) -> DataFrame:
    if split_completeness(df).where("complete = 0").take(1):
        raise ValueError("the split does not contain all rows")
    return df


def customer_overlap(df: DataFrame) -> DataFrame:
    """Customers shared by each pair of splits, in one pass: a bit per split and customer."""
    bit = F.when(F.col(SPLIT) == "train", 1).when(F.col(SPLIT) == "validation", 2).otherwise(4)
    member = df.groupBy(CUSTOMER).agg(F.bit_or(bit).alias("_in"))

    def both(a: int, b: int):
        return F.count_if(F.col("_in").bitwiseAND(a | b) == (a | b))

    return member.agg(
        both(1, 2).alias("train_validation"),
        both(2, 4).alias("validation_test"),
        both(1, 4).alias("train_test"),
    )


def overlap_between(left: DataFrame, right: DataFrame) -> DataFrame:
    """Customers present in both frames."""
    return left.select(CUSTOMER).intersect(right.select(CUSTOMER))


def with_target(df: DataFrame) -> DataFrame:
    """Rows with a known target, as an integer."""
    return df.where(F.col(TARGET).isNotNull()).withColumn(TARGET, F.col(TARGET).cast("int"))


def feature_columns(df: DataFrame, exclude: Collection[str] = ()) -> list[str]:
    """All columns that are not target, id, time, split or knowledge of the future."""
    out = {TARGET, SPLIT, *FUTURE_COLUMNS, *ID_COLUMNS, *TIME_COLUMNS, *exclude}
    return [c for c in df.columns if c not in out]


def numeric_columns(df: DataFrame, among: Collection[str] | None = None) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and (among is None or f.name in among)
    ]


def assert_no_leakage(df: DataFrame, features: Sequence[str]) -> None:
    """Schema-level checks before a dataset is written or a model is fitted."""
    if TARGET not in df.columns:
        raise ValueError(f"target column missing: {TARGET}")
    present = sorted(set(FUTURE_COLUMNS) & set(df.columns))
    if present:
        raise ValueError(f"columns that know the future are present: {present}")
    if TARGET in features:
        raise ValueError(f"target {TARGET} is listed as a feature")
    identity = sorted(set(features) & {*ID_COLUMNS, *TIME_COLUMNS, SPLIT})
    if identity:
        raise ValueError(f"identifiers are listed as features: {identity}")
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"listed features are missing: {missing}")


def leakage_probe(df: DataFrame, feature: str, min_rows: int = 2) -> DataFrame:
    """Values of a feature whose rows all share one label."""
    return (
        df.groupBy(F.col(feature).alias("feature_value"))
        .agg(F.count("*").alias("rows"), F.avg(TARGET).alias("churn_rate"))
        .where((F.col("rows") >= min_rows) & F.col("churn_rate").isin(0.0, 1.0))
        .select(F.lit(feature).alias("feature"), "feature_value", "rows", "churn_rate")
    )


def assert_not_empty(df: DataFrame, what: str = "dataset") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def model_dataset(gold: DataFrame, split: SplitSpec = SPLIT_60_20_20, guard_last_dates: bool = False) -> DataFrame:
    """Id, date, features, target and split label, with the leakage checks passed.

    ``guard_last_dates`` cuts the last horizon afterwards, for panels built
    without a guard of their own.
    """
    require_columns(gold, [CUSTOMER, SNAPSHOT, TARGET, "future_orders_90d", "order_count_180d"])
    df = complete_horizon(gold) if guard_last_dates else gold
    features = feature_columns(df)
    out = with_target(df.select(CUSTOMER, SNAPSHOT, *features, TARGET))
    assert_no_leakage(out, features)
    return chronological_split(out, split)
