"""Interval joins by bins, for windows that date arithmetic can't turn into runs of months.

Both sides are cut into bins of time: a row stands once in each bin that its interval touches. Rows of
one key and bin meet by an equi join, and the exact condition on times stays as a residual. A pair
that shares several bins is taken in the one where its overlap starts, so there are no duplicates and no
distinct. The bin is part of the join key, so a key with a third of all rows is dealt over as many
parts as its rows have bins, and a single hot bin is left to adaptive skew splitting.

Cost: a row is copied once for each bin it touches, and meets what is in its bins; a bin of about the
length of the shorter intervals keeps both small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.operators.orders import PURCHASE_TIME
from panelmill.operators.panel import V3, SnapshotSpec
from panelmill.schema import CUSTOMER, SNAPSHOT

BIN_DAYS = 90


@dataclass(frozen=True)
class Interval:
    """Start and end (timestamps) of the rows of one side; a point is an interval of equal ends.

    An open start is left out, a closed one belongs to the interval; ends belong to it. A row with a null
    bound, or without a point inside its bounds, meets nothing.
    """

    start: Column
    end: Column
    open_start: bool = False


def _bin(time: Column, days: int) -> Column:
    return F.floor(F.unix_timestamp(time) / (days * 86_400))


def _binned(df: DataFrame, interval: Interval, names: tuple[str, str], days: int) -> DataFrame:
    start, end = names
    placed = df.withColumn(start, interval.start.cast("timestamp")).withColumn(end, interval.end.cast("timestamp"))
    whole = placed.where(F.col(start) < F.col(end) if interval.open_start else F.col(start) <= F.col(end))
    return whole.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), days), _bin(F.col(end), days))))


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_interval: Interval, right_interval: Interval, days: int = BIN_DAYS
) -> DataFrame:
    """Pairs of rows of equal keys whose intervals overlap; a null key meets nothing.

    Columns of the right side with the name of one of the left are left out.
    """
    if days <= 0:
        raise ValueError("bins must have a positive length")
    extra = [c for c in right.columns if c not in left.columns]
    a = _binned(left, left_interval, ("_a", "_a_end"), days)
    b = _binned(right.select(*keys, *extra, right_interval.start.alias("_from"), right_interval.end.alias("_to")),
                Interval(F.col("_from"), F.col("_to")), ("_b", "_b_end"), days).drop("_from", "_to")

    def before(start: str, end: str, is_open: bool) -> Column:
        return F.col(start) < F.col(end) if is_open else F.col(start) <= F.col(end)

    overlap = before("_a", "_b_end", left_interval.open_start) & before("_b", "_a_end", right_interval.open_start)
    here = _bin(F.greatest("_a", "_b"), days) == F.col("_bin")
    return a.join(b, [*keys, "_bin"]).where(overlap & here).select(*left.columns, *extra)


def lookback_pairs(snapshots: DataFrame, orders: DataFrame, spec: SnapshotSpec = V3, days: int = BIN_DAYS) -> DataFrame:
    """Every snapshot with each order of its look-back window, by the interval join.

    The same pairs as ``panel.join_to_panel`` without its unmatched snapshots; snapshots may be on any date.
    """
    at = F.col(SNAPSHOT).cast("timestamp")
    window = Interval(at - F.make_dt_interval(F.lit(spec.history_days)), at, open_start=not spec.lower_inclusive)
    return interval_join(snapshots, orders, [CUSTOMER], window, Interval(F.col(PURCHASE_TIME), F.col(PURCHASE_TIME)), days)
