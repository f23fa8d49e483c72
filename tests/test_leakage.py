from __future__ import annotations

import itertools
import random

import pytest

from panelmill.operators import leakage as K


def brute(rows, features):
    """All maximal runs of neighbouring values with one label."""
    out = []
    for j, f in enumerate(features):
        cells: dict = {}
        for r in rows:
            if r[j] is not None and r[-1] is not None:
                cells.setdefault(r[j], []).append(r[-1])
        ordered = [(v, ys, ys[0] if len(set(ys)) == 1 else -1) for v, ys in sorted(cells.items())]
        for label, run in itertools.groupby(ordered, key=lambda c: c[2]):
            run = list(run)
            if label >= 0:
                out.append((f, label, run[0][0], run[-1][0], sum(len(ys) for _, ys, _ in run)))
    return sorted(out)


@pytest.mark.parametrize("ranges", ["2", "7", "40"])
def test_runs_equal_brute_force_over_any_number_of_ranges(spark, ranges):
    rng = random.Random(4)
    rows = []
    for _ in range(600):
        a, b = float(rng.randrange(60)), float(rng.randrange(400))
        rows.append((a, rng.choice([b, b, None]), 1.0, rng.choice([1, None]) if a < 20 else 0 if a > 45 else rng.randrange(2)))
    names = ["a", "b", "c"]
    df = spark.createDataFrame(rows, "a double, b double, c double, churn_90d int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(tuple(r) for r in K.pure_runs(df, names).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == brute(rows, names)
    best = {(r["feature"], r["label"]): r for r in K.purest_ranges(df, names, least_share=0.1).collect()}
    assert best["a", 0]["high"] == 59.0 and best["a", 0]["low"] <= 46.0 and best["a", 1]["low"] == 0.0
    assert not any(f in ("b", "c") for f, _ in best)


def test_leak_is_found_without_its_name(spark):
    """Rows without history always have label 0; nothing else tells."""
    rng = random.Random(1)
    rows = [(float(n), rng.random(), float(rng.randrange(5)), 0 if n == 0 else rng.randrange(2)) for n in [0, 1, 2, 3] * 100]
    df = spark.createDataFrame(rows, "orders double, noise double, other double, churn_90d int")
    found = K.purest_ranges(df, ["orders", "noise", "other"], least_share=0.1).collect()
    assert [tuple(r) for r in found] == [("orders", 0, 0.0, 0.0, 100)]


def test_empty_table_and_missing_column(spark):
    none = spark.createDataFrame([], "a double, churn_90d int")
    assert K.purest_ranges(none, ["a"]).collect() == []
    with pytest.raises(ValueError):
        K.pure_runs(none, ["b"])
