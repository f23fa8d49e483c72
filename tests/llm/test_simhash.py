from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from panelmill.llm import simhash as S
from tests.llm.helpers import ODD, documents, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, words=4):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(words, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), seed=42) for i in range(len(w) - n + 1)] if n else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, least):
    """Smallest of ``least`` reachable over links of at most four bits."""
    arr, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 4).tolist():
            root[find(i)] = find(j)
    low: dict = {}
    for i, d in enumerate(least):
        low[find(i)] = min(d, low.get(find(i), d))
    return [low[find(i)] for i in range(len(fps))]


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    named = [i for i, (d, _) in enumerate(rows) if d is not None]
    of = dict(zip(named, brute_components([fps[i] for i in named], [rows[i][0] for i in named])))
    return sorted(((d, f"{fps[i]:016x}", of.get(i)) for i, (d, _) in enumerate(rows)), key=repr)


def flipped(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return fp


def edited(text, edits, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_documents_equal_brute_force(spark):
    base = [prose(i, 400) for i in range(4)]
    texts = [*base, *base[:2], *(edited(base[i % 2], 1 + i % 3, i) for i in range(60)), *(prose(90 + i, 1 + i % 9) for i in range(40))]
    texts += ["One two", "one  TWO", "Ünï çödé wörds hére", "ünï ÇÖdé wörds hére", "a b c", "a b c a b c a b c"]
    rows = list(ODD) + [(1000 - i, t) for i, t in enumerate(texts)]
    got = rows_of(S.near_duplicates(documents(spark, rows, extra=True)))
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(rows) - 20  # near copies are found


def test_long_texts_are_hashed_in_runs(monkeypatch):
    text = prose(3, 500)
    monkeypatch.setattr(S, "RUN", 7)
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("pairs_each,rounds", [(4, 6), (0, 2), (10**6, 0)])
def test_links_connect_all_near_fingerprints(spark, pairs_each, rounds):
    """Random ones, pairs at every distance, chains, a dense ball, and zero."""
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(300)] + [0, 1, (1 << 64) - 1]
    fps += [flipped(rng, fps[i], 1 + i % 6) for i in range(200)]
    for _ in range(40):
        fps.append(flipped(rng, fps[-1], 4))
    ball = rng.getrandbits(64)
    fps += [flipped(rng, ball, rng.randint(1, 5)) for _ in range(150)]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found, groups = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), pairs_each, rounds)
    of = dict(tuple(r) for r in groups.collect())
    assert [of.get(f, f) for f in signed] == brute_components(fps, signed)
    assert all((a ^ b).bit_count() <= 4 for a, b in ((a % 2**64, b % 2**64) for a, b in (tuple(r) for r in found.collect())))


def test_every_pair_of_four_errors_meets_by_a_probe():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    patterns = S.error_patterns()
    sides = []
    for fps in (a, b):
        held: list[dict] = [{} for _ in fps]
        for row, key, probe in zip(*(x.tolist() for x in S.keys_of(fps, patterns))):
            held[row][key] = probe
        sides.append(held)
    assert all(any(k in y and (probe or y[k]) for k, probe in x.items()) for x, y in zip(*sides))


def test_golay_indices_are_the_codewords_nearby():
    patterns = S.error_patterns()
    words = np.arange(4096) << 11
    words |= S._remainders(words)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 23, 200)
    for segment, found in zip(x.tolist(), S.indices(x, patterns)):
        away = np.bitwise_count(words ^ segment)
        least = int(away.argmin())
        wanted = set(np.flatnonzero(away <= 4).tolist()) if away[least] == 3 else {least}
        assert found[0] == least and set(found[found >= 0].tolist()) == wanted


def test_empty_table(spark):
    assert S.near_duplicates(documents(spark, [])).collect() == []


def test_lists_are_never_broadcast(spark, monkeypatch):
    """Spark takes keys to be as few as the fingerprints they are made of, so it sent all hubs through the driver."""
    plans, stage = {}, S.staged

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(S, "staged", noted)
    S.links(stage(spark.range(1000).selectExpr("xxhash64(id) as fp", "id as least"), "classes"))
    assert "Join" in plans["met"] and "Broadcast" not in plans["met"]
