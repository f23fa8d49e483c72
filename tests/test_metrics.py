from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelmill.operators import metrics as M


def frame(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def brute_ap(pairs):
    p = sum(y for y, _ in pairs)
    total = 0.0
    for s in {s for _, s in pairs}:
        tp = sum(y for y, t in pairs if t >= s)
        n = sum(1 for _, t in pairs if t >= s)
        total += sum(y for y, t in pairs if t == s) / p * tp / n
    return total


def brute_auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def random_pairs(n, seed, ties):
    rng = random.Random(seed)
    return [
        (rng.random() < 0.7, round(rng.random(), 1) if ties else rng.random() ** 8) for _ in range(n)
    ]


@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_ranking_metrics_match_brute_force(spark, ties, ranges):
    pairs = random_pairs(300, 3, ties)
    row = M.ranking_metrics(frame(spark, pairs), ranges=ranges).first()
    assert row["pr_auc"] == pytest.approx(brute_ap(pairs), abs=1e-12)
    assert row["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.booleans(), st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0])), min_size=2, max_size=30))
def test_ranking_metrics_property(spark, pairs):
    row = M.ranking_metrics(frame(spark, pairs)).first()
    labels = {y for y, _ in pairs}
    if True in labels:
        assert row["pr_auc"] == pytest.approx(brute_ap(pairs), abs=1e-12)
    if len(labels) == 2:
        assert row["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    else:
        assert row["roc_auc"] is None


def test_published_confusion_matrix_gives_published_metrics(spark):
    counts = spark.createDataFrame([(6, 1343, 7, 178116)], "tn long, fp long, fn long, tp long")
    row = M.threshold_metrics(counts).first()
    assert row["precision"] == pytest.approx(0.9925163965028224, abs=1e-12)
    assert row["recall"] == pytest.approx(0.9999607013131375, abs=1e-12)
    assert row["f1"] == pytest.approx(0.9962246421799755, abs=1e-12)
    assert row["specificity"] == pytest.approx(6 / 1349)
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in M.confusion_matrix(counts).collect()}
    assert cells == {(0, 0): 6, (0, 1): 1343, (1, 0): 7, (1, 1): 178116}


def test_undefined_ratios_are_zero(spark):
    df = frame(spark, [(1, 0.1), (0, 0.2)])
    row = M.threshold_metrics(M.confusion_counts(df, 0.9)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("sweep", [M.COARSE_SWEEP, M.FINE_SWEEP])
def test_sweep_matches_direct_counts(spark, sweep):
    start, step, count = sweep
    grid = [start + i * step for i in range(count)]
    rng = random.Random(1)
    scores = [*grid[::3], *[rng.random() for _ in range(50)], 0.0, 1.0, -0.5, 1.5]
    pairs = [(rng.random() < 0.6, s) for s in scores]
    got = {r["threshold"]: r for r in M.threshold_sweep(frame(spark, pairs), sweep).collect()}
    assert sorted(got) == sorted(grid)
    for t in grid:
        tp = sum(y for y, s in pairs if s >= t)
        fp = sum(not y for y, s in pairs if s >= t)
        assert got[t]["precision"] == pytest.approx(tp / (tp + fp) if tp + fp else 0.0)
        assert got[t]["recall"] == pytest.approx(tp / sum(y for y, _ in pairs))


def test_best_threshold_is_the_lowest_of_equals(spark):
    rows = M.threshold_sweep(frame(spark, [(1, 0.8), (0, 0.05)]), M.FINE_SWEEP)
    assert M.best_threshold(rows).first()["threshold"] == pytest.approx(0.06)


def test_cells_and_rows_give_the_same_confusion(spark):
    df = frame(spark, random_pairs(200, 5, True))
    a = M.confusion_counts(df, 0.5).first()
    b = M.confusion_of_cells(M.score_cells(df), 0.5).first()
    assert tuple(a) == tuple(b)


def test_baselines_and_report(spark):
    df = frame(spark, [(1, 0.9)] * 9 + [(0, 0.1)])
    always = {r["baseline"]: r for r in M.baselines(df).collect()}["always_positive"]
    assert (always["precision"], always["recall"], always["specificity"]) == (0.9, 1.0, 0.0)
    report = {r["class"]: r for r in M.classification_report(M.confusion_counts(df, 0.5)).collect()}
    assert report["accuracy"]["f1"] == 1.0 and report["weighted avg"]["support"] == 10


def test_capacity_shares_a_tied_group(spark):
    df = frame(spark, [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.5), (1, 0.1)] * 2)
    row = M.capacity_metrics(df, (0.4,)).first()
    # four places: the two at .9, then two of six tied rows holding two positives
    assert row["places"] == 4
    assert row["precision"] == pytest.approx((2 + 2 * 2 / 6) / 4)


def test_hot_score_holding_most_rows(spark):
    pairs = [(i % 3 == 0, 0.5) for i in range(500)] + random_pairs(100, 9, False)
    row = M.ranking_metrics(frame(spark, pairs)).first()
    assert row["pr_auc"] == pytest.approx(brute_ap(pairs), abs=1e-12)
