from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from panelmill.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d, seed, spread=0.3):
    rng = random.Random(seed)
    hubs = [[rng.uniform(-1, 1) for _ in range(d)] for _ in range(5)]
    return [[float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(hubs)] for _ in range(n)]


def brute(rows, k, rounds, d, scale=256, seed=2):
    kept = []
    for i, v, _ in rows:
        if v is not None and len(v) == d and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            kept.append((i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]))
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centers = [v for _, v in named[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        of = [place(v)[1] for _, v in kept]
        for j in range(len(centers)):
            own = [v for (_, v), c in zip(kept, of) if c == j]
            if own:
                centers[j] = [sum(col) // len(own) for col in zip(*own)]
    out = [(i, *place(v)[::-1]) for i, v in kept]
    total = sum(r[2] for r in out)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted([(*r, sum(o[2] for o in out if o[1] == r[1]), total, digest[r[1]]) for r in out], key=repr)


def found(spark, rows, extra=False, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "'x' as v", "'x' as cluster", "'x' as distance", "'x' as number")
    return sorted((tuple(r) for r in C.with_inertia(*C.cluster(df, **sizes)).collect()), key=repr)


def test_equals_brute_force_with_odd_rows(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(150, 6, 1))]
    rows += [(0, rows[0][1], 1), (7, rows[3][1], 1), (None, rows[5][1], 1)]  # repeated and missing ids
    rows += [(900, None, 0), (901, [], 0), (902, [0.5] * 5, 0), (903, [None] + [0.5] * 5, 0)]
    rows += [(904, [float("nan")] + [0.5] * 5, 0), (905, [float("-inf")] + [0.5] * 5, 0)]
    sizes = dict(k=9, rounds=4, dimensions=6)
    got = found(spark, rows, extra=True, **sizes)
    assert got == brute(rows, 9, 4, 6) and len(got) == 153


def test_fewer_vectors_than_centroids_and_equal_vectors(spark):
    rows = [(i, [0.25, -0.25], 0) for i in range(5)] + [(9, [1.0, 1.0], 0)]
    assert found(spark, rows, k=8, rounds=2, dimensions=2) == brute(rows, 8, 2, 2)


def test_empty_table_and_too_large_components(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0)]) == []
    with pytest.raises(Exception, match="too large"):
        found(spark, [(1, [1e30, 0.0], 0)], dimensions=2)


@pytest.mark.parametrize("d,k", [(1, 12), (3, 30), (64, 40)])
def test_nearest_is_exact_with_ties(d, k):
    rng = np.random.default_rng(d)
    centers = rng.integers(-6, 7, (k, d))
    x = rng.integers(-7, 8, (400, d))
    all_pairs = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    number, distance = C.Lists(centers).nearest(x)
    assert (number == all_pairs.argmin(axis=1)).all() and (distance == all_pairs.min(axis=1)).all()


def test_the_walk_ends_before_all_centroids_are_met():
    """In few dimensions with clear clusters most centroids are never compared."""
    rng = np.random.default_rng(3)
    centers = rng.integers(-100_000, 100_000, (400, 2))
    lists, compared = C.Lists(centers), []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            compared.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    lists.centroids = centers.view(Counted)
    lists.nearest(centers[rng.integers(0, 400, 50)] + 3)
    assert sum(compared) < 50 * 400 / 5
