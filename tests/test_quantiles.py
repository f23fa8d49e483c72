"""Quantiles by narrowing against sorted values."""

from __future__ import annotations

import math
import random

import pytest

from panelmill.operators import profile as Q

SHARES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


def by_sorting(values, share):
    kept = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return kept[max(1, math.ceil(len(kept) * share)) - 1]


def columns():
    draw, n = random.Random(5), 4000
    return {
        "even": [draw.random() for _ in range(n)],
        "far": [draw.choice([-1, 1]) * 10 ** draw.uniform(-300, 300) for _ in range(n)],
        "close": [1.7e9 + i * 2e-7 for i in range(n)],
        "few": [float(draw.choice([0, 1, 1, 1, 7])) for _ in range(n)],
        "odd": [draw.choice([None, math.nan, math.inf, -math.inf, 0.0, 5e-324, 1e-323, 1.7e308, -1.7e308, 3.5]) for _ in range(n)],
        "hot": [2.5] * (n - 3) + [1e12, -4.0, 2.5000000001],
        "a.b": [float(i % 97) for i in range(n)],
    }


@pytest.mark.parametrize("few", [0, 10**6])
def test_equal_to_sorting(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW", few)
    data = columns()
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"`{c}` double" for c in data)).repartition(3)
    got = {(r["column_name"], r["share"]): r["value"] for r in Q.quantiles(df, list(data), SHARES).collect()}
    assert len(got) == len(data) * len(SHARES)
    for (c, s), v in got.items():
        want = by_sorting(data[c], s)
        assert v == want or (math.isnan(v) and math.isnan(want)), (c, s)


def test_without_values(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    assert [tuple(r) for r in Q.quantiles(df, ["a", "b"], (0.5,)).collect()] == [("b", 0.5, 1.0)]
    assert Q.quantiles(df.limit(0), ["a", "b"], (0.5,)).count() == 0


def test_a_value_is_looked_up_among_the_ranges_of_its_column(spark, monkeypatch):
    """With many shares, each value was paired with every range of its column."""
    monkeypatch.setattr(Q, "FEW", 5)
    df = spark.range(3000).selectExpr("cast(id as double) / 7 + 1 as a", "if(id % 9 = 0, null, if(id % 9 = 1, double('nan'), -id * 1.0)) as b")
    inside = Q._inside(df, ["a", "b"], {(0, 1.0, 2.0): 0, (0, 3.0, 4.0): 1, (1, -20.0, -0.0): 2})
    assert not [n for n in inside._jdf.queryExecution().executedPlan().toString().split() if n.endswith("Join")]
    assert {r["_range"]: r["count"] for r in inside.groupBy("_range").count().collect()} == {0: 8, 1: 8, 2: 15}
    shares = [k / 20 for k in range(1, 20)]
    rows = sorted(r["a"] for r in df.collect())
    got = {r["share"]: r["value"] for r in Q.quantiles(df, ["a"], shares).collect()}
    assert got == {s: rows[max(1, math.ceil(len(rows) * s)) - 1] for s in shares}
