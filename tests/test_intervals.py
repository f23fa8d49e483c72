from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelmill.operators import intervals as I
from panelmill.operators import panel as P
from panelmill.operators.orders import order_level, review_rollup

DAY = dt.timedelta(days=1)


def spans(rng, n, keys):
    start = [dt.datetime(2018, 1, 1) + dt.timedelta(hours=rng.randrange(4000)) for _ in range(n)]
    out = [(rng.choice(keys), i, s, s + dt.timedelta(hours=rng.choice([0, 0, 5, 24, 400, 2000, -3]))) for i, s in enumerate(start)]
    return [*out, (None, n, start[0], start[0]), (keys[0], n + 1, None, start[0]), (keys[0], n + 2, start[0], None)]


@pytest.mark.parametrize("days", [1, 7, 400])
@pytest.mark.parametrize("open_start", [False, True])
def test_pairs_equal_brute_force(spark, days, open_start):
    rng = random.Random(days)
    left, right = spans(rng, 60, ["a", "b", "hot"]), spans(rng, 60, ["a", "hot", "hot", "c"])
    a, b = spark.createDataFrame(left, "k string, l int, s timestamp, e timestamp"), spark.createDataFrame(right, "k string, r int, x timestamp, y timestamp")
    found = I.interval_join(a, b, ["k"], I.Interval(F.col("s"), F.col("e"), open_start), I.Interval(F.col("x"), F.col("y")), days)
    expected = [
        (k, i, j)
        for k, i, s, e in left
        for q, j, x, y in right
        if k is not None and k == q and None not in (s, e, x, y)
        and (s < e and s < y if open_start else s <= e and s <= y) and x <= e and x <= y
    ]
    assert sorted((r["k"], r["l"], r["r"]) for r in found.collect()) == sorted(expected) and expected


@pytest.mark.parametrize("spec", [P.V1, P.V2, P.V3])
def test_lookback_pairs_equal_the_fan_out(make_orders, spec):
    rng = random.Random(3)
    start = dt.datetime(2017, 1, 1)
    rows = [(str(i), f"c{rng.randrange(4)}", str(start + dt.timedelta(hours=rng.randrange(24 * 500)))) for i in range(150)]
    rows += [("x", "c1", "2017-08-04 00:00:00"), ("y", "c1", "2018-01-31 00:00:00"), ("z", "c1", "2018-01-31 10:00:00")]
    orders = make_orders(rows)
    snapshots = P.panel(orders, spec)
    fanned = P.join_to_panel(snapshots, orders, spec).where("order_id is not null")
    columns = ["customer_unique_id", "observation_date", "order_id"]
    for days in (7, 90):
        pairs = I.lookback_pairs(snapshots, orders, spec, days)
        assert sorted(map(tuple, pairs.select(*columns).collect())) == sorted(map(tuple, fanned.select(*columns).collect()))


def test_join_is_by_key_and_bin(make_orders):
    orders = make_orders([("1", "a", "2018-01-10 00:00:00")])
    plan = I.lookback_pairs(P.panel(orders, P.V2), orders, P.V2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bin" in plan


def test_empty_sides(spark, make_orders):
    none = make_orders([])
    assert I.lookback_pairs(P.panel(none, P.V2), none, P.V2).collect() == []
    with pytest.raises(ValueError):
        I.lookback_pairs(P.panel(none, P.V2), none, P.V2, 0)


# ---- reviews and deliveries by their own time ---------------------------------------------


def test_late_review_and_delivery_leave_the_early_snapshot(spark, make_orders):
    """Bought in January, delivered in February (late), reviewed in March; a second order has neither."""
    orders = make_orders(
        [
            ("1", "a", "2018-01-10 00:00:00", "2018-02-20 00:00:00", "2018-02-01 00:00:00"),
            ("2", "a", "2018-01-12 00:00:00"),
            ("3", "a", "2018-09-30 00:00:00"),
        ]
    )
    reviews = spark.createDataFrame(
        [("1", 2, dt.datetime(2018, 3, 31)), ("1", 4, dt.datetime(2018, 3, 1))], "order_id string, review_score int, review_creation_date timestamp"
    )
    measures = ["avg_review_score_180d", "review_count_180d", "avg_delivery_delay_180d", "late_delivery_rate_180d"]

    def rows(**options):
        spec = P.SnapshotSpec(**options)
        level = order_level(orders, reviews=review_rollup(reviews, spec.strict_as_of), missing_as_zero=spec.missing_as_zero)
        found = P.snapshot_features(level, spec=spec).where("observation_date < '2018-05-01'").orderBy("observation_date")
        return [tuple(float(r[m]) for m in measures) for r in found.collect()]

    whole = (3.0, 1.0, 19.0, 0.5)
    assert rows() == [whole] * 4
    nothing, delivered = (0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 19.0, 0.5)
    assert rows(strict_as_of=True) == [nothing, delivered, whole, whole]
    # zeros stand in for what is missing, so they count as reviews of score zero here
    zero, late = (0.0, 2.0, 0.0, 0.0), (0.0, 2.0, 9.5, 0.5)
    assert rows(strict_as_of=True, missing_as_zero=True) == [zero, late, (1.5, 2.0, 9.5, 0.5), (1.5, 2.0, 9.5, 0.5)]


def test_a_review_without_a_date_is_never_known(spark):
    reviews = spark.createDataFrame(
        [("1", 2, None), ("1", 4, dt.datetime(2018, 3, 1)), ("2", 5, dt.datetime(2018, 3, 2))],
        "order_id string, review_score int, review_creation_date timestamp",
    )
    known = {r["order_id"]: r["review_known_at"] for r in review_rollup(reviews, known_at=True).collect()}
    assert known == {"1": None, "2": dt.datetime(2018, 3, 2)}


def test_first_snapshot_is_the_first_at_or_after(spark):
    times = ["2018-01-31 00:00:00", "2018-01-31 00:00:01", "2018-02-01 00:00:00", "2018-02-28 00:00:00"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(P.first_snapshot(F.col("t").cast("timestamp"))).collect()
    january = 2018 * 12
    assert [r[0] for r in rows] == [january, january + 1, january + 1, january + 1]
