"""Data-quality profiles, one pass each, in long format."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.sources.tables import staged

def _long(row: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Turn one row of ``column__stat`` values into one row per column."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{s}`").alias(s) for s in stats])
            for c in columns
        ]
    )
    return row.select(F.inline(entries))


def _profile(df: DataFrame, columns: Sequence[str], stats: dict[str, object]) -> DataFrame:
    aggregates: list[Column] = [
        make(F.col(f"`{c}`")).alias(f"{c}__{name}") for c in columns for name, make in stats.items()
    ]
    return _long(df.agg(*aggregates), columns, list(stats))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column."""
    return _profile(df, columns or df.columns, {"null_count": lambda c: F.count_if(c.isNull())})


def null_zero_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs and zeros per numeric column."""
    return _profile(
        df,
        columns,
        {"null_count": lambda c: F.count_if(c.isNull()), "zero_count": lambda c: F.count_if(c == 0)},
    )


def numeric_summary(df: DataFrame, columns: Sequence[str], quartiles: bool = True) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per column."""
    d = "double"
    stats = {
        "n": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c.cast(d)),
        "max": lambda c: F.max(c.cast(d)),
    }
    if not quartiles:
        return _profile(df, columns, stats)
    df = staged(df.select(*columns), "summary")  # two passes over a few columns
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    marks = quantiles(df, columns, tuple(names)).groupBy("column_name").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in names.items()]
    )
    return (
        _profile(df, columns, stats)
        .join(F.broadcast(marks), "column_name", "left")  # one row per column
        .select("column_name", "n", "mean", "stddev", "min", *names.values(), "max")
    )


#: Intervals of a range in one pass, and the rows of a range that are few enough to be put in order.
INTERVALS, FEW = 4096, 200_000


def _intervals_of_all() -> Column:
    """Number of the interval of any double, in order: even steps of the logarithm, infinities and NaN on their own."""
    v = F.col("value")
    # logarithms of positive doubles lie between -744.5 and 709.8, so that all sizes are positive and 0 is between the signs
    size = F.coalesce(F.ln(F.nullif(F.abs(v), F.lit(0.0))) + 746, F.lit(0.0))
    step = (F.signum(v) * size + 1456) * (INTERVALS / 2912)
    return (
        F.when(F.isnan(v), F.lit(INTERVALS + 1.0)).when(v == float("inf"), F.lit(float(INTERVALS)))
        .when(v == float("-inf"), F.lit(-1.0)).otherwise(F.floor(step).cast("double"))
    )


def _intervals_of_range() -> Column:
    """Number of the interval between ``low`` and ``high``; halves, as their difference may exceed all doubles."""
    part = F.try_divide(F.col("value") / 2 - F.col("low") / 2, F.col("high") / 2 - F.col("low") / 2)
    part = F.coalesce(part, (F.col("value") > F.col("low")).cast("double"))
    return F.least(F.lit(INTERVALS - 1.0), F.floor(part * INTERVALS).cast("double"))


def _pieces(cells: DataFrame, group: str, piece: Column) -> DataFrame:
    """Pieces of each group in order, with their rows, ends, and the rows up to their end and of all."""
    found = cells.groupBy(group, piece.alias("_piece")).agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    whole = Window.partitionBy(group)  # no more rows than intervals, or than a range of few rows has values
    return found.withColumn("_upto", F.sum("n").over(whole.orderBy("_piece"))).withColumn("_all", F.sum("n").over(whole))


def _inside(df: DataFrame, columns: Sequence[str], numbers: Mapping[tuple[int, float, float], int]) -> DataFrame:
    """Number of its range and value, for each value in a range. Ranges of a column don't overlap, so a value is looked up, not compared with all."""
    places: dict[int, list[tuple[float, float, int]]] = {}
    for (column, low, high), i in numbers.items():
        places.setdefault(column, []).append((low, high, i))
    sought = [tuple(np.array(x) for x in zip(*sorted(places[c]))) for c in sorted(places)]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, (lows, highs, own) in zip(batch.columns, sought):
                v = values.to_numpy(zero_copy_only=False)  # NULL as NaN, which is in no range
                at = np.maximum(np.searchsorted(lows, v, "right") - 1, 0)
                on = (v >= lows[at]) & (v <= highs[at])
                yield pa.RecordBatch.from_pydict({"_range": own[at[on]].astype(np.int32), "value": v[on]})

    wanted = [F.col(f"`{columns[c]}`").cast("double").alias(f"_{c}") for c in sorted(places)]
    return df.select(*wanted).mapInArrow(found, "_range int, value double")


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """column_name, share, value: the smallest value that at least that share of a column's values does not exceed.

    Exact at any size, by narrowing: a pass counts the rows of 4,096 intervals of each column, the interval that
    holds a wanted rank is counted again from its least to its greatest value, until both are equal or its rows are
    few; those are counted by value. So histograms move, not values. Intervals are even in the logarithm first (a factor of
    two each) and even in value then, which leaves at most five passes more of any 53 bits. ``df`` is read once for each pass.

    NULLs don't count; NaN is the greatest value. A column without values has no row.
    """
    spark = df.sparkSession
    values = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(columns)])
    cells = df.select(F.inline(values)).where("value is not null")
    rank = F.greatest(F.lit(1), F.ceil(F.col("_all") * F.col("share"))).cast("long")
    first = (
        _pieces(cells, "column", _intervals_of_all())
        .withColumn("share", F.explode(F.array(*map(F.lit, shares))))
        .withColumn("_rank", rank)
        .where("_rank > _upto - n and _rank <= _upto")
        .select("column", "share", (F.col("_rank") - F.col("_upto") + F.col("n")).alias("rank"), "low", "high", "n")
    )
    found, wanted = [], [tuple(r) for r in first.collect()]  # a row per column and share, here and below
    while True:
        found += [(columns[c], share, low + 0.0) for c, share, _, low, high, _ in wanted if not low < high]
        wanted = [t for t in wanted if t[3] < t[4]]
        if not wanted:
            return spark.createDataFrame(found, "column_name string, share double, value double")
        large = [t for t in wanted if t[5] > FEW]
        now, wanted = large or wanted, [t for t in wanted if large and t[5] <= FEW]
        numbers = {place: i for i, place in enumerate(sorted({(t[0], t[3], t[4]) for t in now}))}
        ranges = spark.createDataFrame([(i, *place) for place, i in numbers.items()], "_range int, column int, low double, high double")
        asked = spark.createDataFrame(
            [(numbers[t[0], t[3], t[4]], *t[:3]) for t in now], "_range int, column int, share double, rank long"
        )
        inside = _inside(df, columns, numbers).join(F.broadcast(ranges.drop("column")), "_range")
        pieces = _pieces(inside, "_range", _intervals_of_range() if large else F.col("value"))
        wanted += [
            tuple(r)
            for r in pieces.join(F.broadcast(asked), "_range")
            .where("rank > _upto - n and rank <= _upto")
            .select("column", "share", F.expr("rank - _upto + n"), "low", "high", "n")
            .collect()
        ]


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, data_type string, nullable boolean",
    )


def table_profile(df: DataFrame) -> DataFrame:
    """NULLs per column beside the row and column count of the table, in one pass."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__null_count") for c in df.columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(t).alias("data_type"),
                F.col(f"`{c}__null_count`").alias("null_count"),
                F.col("_rows").alias("rows"),
                F.lit(len(df.columns)).alias("columns"),
            )
            for c, t in df.dtypes
        ]
    )
    return row.select(F.inline(entries))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and distinct combinations of some columns."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct(*columns).alias("distinct_rows"))


def sample_rows(df: DataFrame, n: int = 5, *order: str) -> DataFrame:
    """First n rows, by the given columns if any."""
    return (df.orderBy(*order) if order else df).limit(n)


def share_of_total(df: DataFrame, value: str, name: str, digits: int) -> DataFrame:
    """Percentage of the column total; ``df`` is already aggregated, its total is one row."""
    total = df.agg(F.sum(value).alias("_total"))
    return (
        df.crossJoin(F.broadcast(total))
        .withColumn(name, F.round(F.col(value) / F.col("_total") * 100, digits))
        .drop("_total")
    )
