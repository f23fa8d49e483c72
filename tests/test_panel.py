from __future__ import annotations

import calendar
import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelmill.operators import panel as P
from panelmill.operators.orders import order_level

T = dt.date(2018, 1, 31)
BOUNDARY = [
    # purchase time, in look-back of v1/v2, in look-back of v3, in forward window
    ("2017-08-04 00:00:00", True, False, False),
    ("2017-08-04 00:00:01", True, True, False),
    ("2018-01-31 00:00:00", True, True, False),
    ("2018-01-31 10:00:00", False, False, True),
    ("2018-05-01 00:00:00", False, False, True),
    ("2018-05-01 00:00:01", False, False, False),
]


@pytest.mark.parametrize("spec,column", [(P.V2, 1), (P.V3, 2)])
def test_window_boundaries(make_orders, spec, column):
    orders = make_orders([(str(i), f"c{i}", row[0]) for i, row in enumerate(BOUNDARY)])
    runs = orders.withColumns(P.snapshot_runs(F.col("order_purchase_timestamp"), spec)).collect()
    index = T.year * 12 + T.month - 1
    got = {
        int(r["order_id"]): (
            r["history_from"] <= index <= r["history_to"],
            r["future_from"] <= index < r["history_from"],
        )
        for r in runs
    }
    for i, row in enumerate(BOUNDARY):
        assert got[i] == (row[column], row[3]), row


def month_ends(lo: dt.date, hi: dt.date):
    y, m = lo.year, lo.month
    while True:
        d = dt.date(y, m, calendar.monthrange(y, m)[1])
        if d > hi:
            return
        yield d
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)


def brute(rows, spec):
    """Snapshots, order counts and future counts by pairing everything."""
    times = [(c, dt.datetime.fromisoformat(t)) for _, c, t in rows]
    last = max(t for _, t in times).date()
    guard = last - dt.timedelta(days=spec.horizon_days)
    by_customer = defaultdict(list)
    for c, t in times:
        by_customer[c].append(t)
    out = {}
    for c, ts in by_customer.items():
        first = min(ts).date()
        if spec.panel == "dense":
            days = list(month_ends(first, guard))
        else:
            days = sorted({next(month_ends(t.date(), dt.date(2100, 1, 1))) for t in ts})
        for d in days:
            at = dt.datetime(d.year, d.month, d.day)
            low = at - dt.timedelta(days=spec.history_days)
            past = [t for t in ts if (low <= t if spec.lower_inclusive else low < t) and t <= at]
            future = [t for t in ts if at < t <= at + dt.timedelta(days=spec.horizon_days)]
            if past or not spec.active_only:
                out[c, d] = (
                    len(past),
                    len(future),
                    (d - max(past).date()).days if past else 0,
                    (d - min(past).date()).days if past else 0,
                )
    return out


def random_rows(seed: int, n: int):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.datetime(2016, 1, 1) + dt.timedelta(days=rng.randrange(900))
        if rng.random() < 0.3:  # month ends and other boundary days
            day = day.replace(day=calendar.monthrange(day.year, day.month)[1])
        seconds = rng.choice([0, 1, 36000, 86399])
        # one customer holds a third of all orders
        customer = "hot" if rng.random() < 0.34 else f"c{rng.randrange(12)}"
        rows.append((str(i), customer, (day + dt.timedelta(seconds=seconds)).isoformat(" ")))
    return rows


@pytest.mark.parametrize(
    "spec",
    [
        P.V2,
        P.V3,
        P.SnapshotSpec(active_only=False),
        P.SnapshotSpec(history_days=7, horizon_days=3),
        P.SnapshotSpec(history_days=2500, horizon_days=200),
    ],
)
def test_features_match_brute_force(make_orders, spec):
    rows = random_rows(7, 200)
    got = P.snapshot_features(order_level(make_orders(rows)), None, spec).collect()
    assert {
        (r["customer_unique_id"], r["observation_date"]): (
            r["order_count_180d"],
            r["future_orders_90d"],
            r["recency_days"],
            r["customer_lifetime_days"],
        )
        for r in got
    } == brute(rows, spec)
    assert all(r["churn_90d"] == int(r["future_orders_90d"] == 0) for r in got)


@pytest.mark.parametrize("spec", [P.V2, P.V3])
def test_label_and_panel_match_brute_force(make_orders, spec):
    rows = random_rows(11, 150)
    orders = make_orders(rows)
    full = P.SnapshotSpec(**{**spec.__dict__, "active_only": False})
    expected = brute(rows, full)
    label = P.forward_label(orders, spec).collect()
    assert {(r["customer_unique_id"], r["observation_date"]): r["future_orders_90d"] for r in label} == {
        k: v[1] for k, v in expected.items()
    }
    rows_of_panel = [(r[0], r[1]) for r in P.panel(orders, spec).collect()]
    assert sorted(rows_of_panel) == sorted(expected)


@pytest.mark.parametrize("history", [180, 3000])
def test_distinct_entities_match_brute_force(spark, make_orders, history):
    spec = P.SnapshotSpec(history_days=history, guard=False)
    rows = random_rows(3, 300)
    rng = random.Random(5)
    product = {r[0]: rng.choice(["a", "b", "c", None]) for r in rows}
    facts = make_orders(rows).join(
        spark.createDataFrame(list(product.items()), "order_id string, product string"), "order_id"
    )
    got = P.count_entities(
        P.entity_contributions(facts, {"n": "product"}, spec, None), {"n": "product"}
    ).collect()
    seen = defaultdict(set)
    for i, c, t in rows:
        t = dt.datetime.fromisoformat(t)
        for d in month_ends(t.date(), t.date() + dt.timedelta(days=history)):
            at = dt.datetime(d.year, d.month, d.day)
            if at - dt.timedelta(days=history) < t <= at and product[i]:
                seen[c, d].add(product[i])
    assert {(r["customer_unique_id"], r["observation_date"]): r["n"] for r in got} == {
        k: len(v) for k, v in seen.items()
    }


def test_means_skip_or_zero_fill_missing_values(spark, make_orders):
    orders = make_orders(
        [
            ("1", "a", "2018-01-05 09:00:00", "2018-01-20 00:00:00", "2018-01-15 00:00:00"),
            ("2", "a", "2018-01-06 09:00:00", None, "2018-01-15 00:00:00"),
            ("3", "b", "2018-09-01 09:00:00"),
        ]
    )
    reviews = spark.createDataFrame([("1", 4.0, 2)], "order_id string, review_score double, review_count long")
    v3 = P.snapshot_features(order_level(orders, reviews=reviews), None, P.V3)
    row = v3.where("customer_unique_id = 'a' and observation_date = '2018-01-31'").first()
    assert (row["avg_delivery_delay_180d"], row["late_delivery_rate_180d"]) == (5.0, 0.5)
    assert (row["avg_review_score_180d"], row["review_count_180d"]) == (4.0, 1)
    v2 = P.snapshot_features(order_level(orders, reviews=reviews, missing_as_zero=True), None, P.V2)
    row = v2.where("customer_unique_id = 'a' and observation_date = '2018-01-31'").first()
    assert (row["avg_delivery_delay_180d"], row["late_delivery_rate_180d"]) == (2.5, 0.5)
    assert (row["avg_review_score_180d"], row["review_count_180d"]) == (2.0, 2)


def test_zero_history_rows_of_the_second_generation_are_never_churned(make_orders):
    rows = P.snapshot_features(order_level(make_orders(random_rows(1, 300))), None, P.V2)
    zero = rows.where("order_count_180d = 0")
    assert zero.count() > 0 and zero.where("churn_90d = 1").count() == 0


def test_invariants(make_orders):
    rows = P.snapshot_features(order_level(make_orders(random_rows(2, 400))), None, P.V3).persist()
    assert rows.count() == rows.select("customer_unique_id", "observation_date").distinct().count()
    assert rows.where("recency_days not between 0 and 180").count() == 0
    assert rows.where("customer_lifetime_days < recency_days").count() == 0
    assert rows.where("churn_90d not in (0, 1)").count() == 0


def test_lookback_join_keeps_empty_snapshots(make_orders):
    orders = make_orders([("1", "a", "2018-01-05 09:00:00"), ("2", "a", "2019-01-05 09:00:00")])
    pairs = P.join_to_panel(P.panel(orders, P.V3), orders, P.V3)
    assert pairs.where("order_id is not null").count() == 6
    assert pairs.where("order_id is null").count() == pairs.select("observation_date").distinct().count() - 6


def test_no_snapshot_when_data_is_shorter_than_the_horizon(make_orders):
    orders = make_orders([("1", "a", "2018-01-05 09:00:00"), ("2", "b", "2018-02-05 09:00:00")])
    assert P.snapshot_features(order_level(orders), None, P.V3).count() == 0
    assert P.calendar(P.calendar_bounds(orders)).count() == 0


def test_bad_specs_are_refused():
    for bad in ({"panel": "weekly"}, {"diversity": "x"}, {"history_days": 0}):
        with pytest.raises(ValueError):
            P.SnapshotSpec(**bad)
