from __future__ import annotations

import datetime as dt

import pytest

from panelmill.operators import dataset as D
from panelmill.operators import profile as Q


def month_end(i: int) -> dt.date:
    y, m = 2017 + (i + 1) // 12, (i + 1) % 12 + 1
    return dt.date(y, m, 1) - dt.timedelta(days=1)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(f"c{k}", month_end(i), i + 1, k % 2, k % 3) for i in range(13) for k in range(i + 1)]
    return spark.createDataFrame(
        rows,
        "customer_unique_id string, observation_date date, order_count_180d int, churn_90d int,"
        " future_orders_90d int",
    )


@pytest.mark.parametrize("spec", [D.SPLIT_70_15_15, D.SPLIT_60_20_20])
def test_split_positions_use_integer_cut(panel, spec):
    got = D.split_ranges(D.chronological_split(panel, spec)).collect()
    ends = {r["dataset_split"]: r["max_date"] for r in got}
    assert ends["train"] == month_end(int(13 * spec.train_until) - 1)
    assert ends["validation"] == month_end(int(13 * spec.validation_until) - 1)
    assert ends["test"] == month_end(12)
    assert sum(r["rows"] for r in got) == panel.count()


def test_too_few_dates_fail(panel):
    few = panel.where("observation_date < '2017-06-01'")
    with pytest.raises(Exception, match="not enough snapshot dates"):
        D.chronological_split(few, D.SPLIT_60_20_20).collect()
    assert D.chronological_split(few, D.SPLIT_70_15_15).count() == few.count()


def test_single_date_is_all_training(panel):
    one = panel.where("observation_date = '2017-01-31'")
    assert {r[0] for r in D.chronological_split(one, D.SPLIT_70_15_15).select("dataset_split").collect()} == {"train"}


def test_completeness_and_overlap(panel):
    split = D.chronological_split(panel, D.SPLIT_60_20_20)
    assert D.split_completeness(split).first()["complete"] == 1
    D.assert_complete_split(split)
    parts = D.split_frames(split)
    row = D.customer_overlap(split).first()
    assert row["train_test"] == D.overlap_between(parts["train"], parts["test"]).count()
    assert row["train_validation"] == D.overlap_between(parts["train"], parts["validation"]).count()
    assert D.concat_splits(list(parts.values())).count() == panel.count()
    with pytest.raises(ValueError, match="all rows"):
        D.assert_complete_split(split.replace("test", "lost", ["dataset_split"]))


def test_leakage_assertions(panel):
    clean = panel.drop("future_orders_90d")
    D.assert_no_leakage(clean, ["order_count_180d"])
    for df, features, message in [
        (clean.drop("churn_90d"), [], "target column missing"),
        (panel, ["order_count_180d"], "know the future"),
        (clean, ["churn_90d"], "listed as a feature"),
        (clean, ["customer_unique_id"], "identifiers"),
        (clean, ["nothing"], "missing"),
    ]:
        with pytest.raises(ValueError, match=message):
            D.assert_no_leakage(df, features)


def test_model_dataset_drops_future_columns(panel):
    out = D.model_dataset(panel)
    assert out.columns == ["customer_unique_id", "observation_date", "order_count_180d", "churn_90d", "dataset_split"]
    assert D.feature_columns(out) == ["order_count_180d"]
    assert D.numeric_columns(out) == ["order_count_180d", "churn_90d"]
    guarded = D.complete_horizon(panel)
    assert guarded.agg({"observation_date": "max"}).first()[0] <= month_end(12) - dt.timedelta(days=90)


def test_leakage_probe_finds_pure_values(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (1, 1), (2, 1)], "v int, churn_90d int")
    assert [tuple(r) for r in D.leakage_probe(df, "v").collect()] == [("v", 0, 2, 0.0)]


def test_empty_guard(panel):
    D.assert_not_empty(panel)
    with pytest.raises(ValueError, match="empty"):
        D.assert_not_empty(panel.where("false"))


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (0, 2.0), (None, 4.0), (3, 0.0)], "a int, b double")
    got = {r["column_name"]: (r["null_count"], r["zero_count"]) for r in Q.null_zero_counts(df, ["a", "b"]).collect()}
    assert got == {"a": (1, 1), "b": (1, 1)}
    s = {r["column_name"]: r for r in Q.numeric_summary(df, ["a", "b"]).collect()}
    assert (s["b"]["n"], s["b"]["mean"], s["b"]["p50"], s["b"]["max"]) == (3, 2.0, 2.0, 4.0)
    assert [r["data_type"] for r in Q.schema_rows(df).collect()] == ["int", "double"]


def test_quantiles_are_exact_over_ranges_and_hot_values(spark):
    rows = [(float(i % 7), None) for i in range(500)] + [(3.0, float(i)) for i in range(700)] + [(None, None)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    found = {(r["column_name"], r["share"]): r["value"] for r in Q.quantiles(df, ["a", "b"], (0.0, 0.25, 0.5, 0.999, 1.0)).collect()}
    for k, name in enumerate("ab"):
        values = sorted(r[k] for r in rows if r[k] is not None)
        for share in (0.0, 0.25, 0.5, 0.999, 1.0):
            rank = max(1, -(-len(values) * share // 1))
            assert found[name, share] == values[int(rank) - 1]
    empty = Q.numeric_summary(df.where("false"), ["a"]).first()
    assert empty["n"] == 0 and empty["p50"] is None
