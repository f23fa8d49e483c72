"""Quality, toxicity and language-model scores."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.llm import lmscore as M
from panelmill.llm import quality as Q
from panelmill.llm import toxicity as X
from panelmill.llm.common import held_out, labelled_sample
from panelmill.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD, documents, prose


SF_NEXT = "/root/testdata/sf0.01"


def auc(pairs):
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(1)
    m = Q.FactorisationMachine(np.zeros((len(Q.STATISTICS), Q.BINS - 1)))
    m.w, m.v, m.w0 = rng.normal(size=m.w.shape), rng.normal(size=m.v.shape), 0.3
    at, x = m.vector(np.array([3, 17, 900]), [0.0] * len(Q.STATISTICS))
    pairs = sum(m.v[a] @ m.v[b] * x[i] * x[j] for i, a in enumerate(at) for j, b in enumerate(at) if i < j)
    assert m.margin(at, x) == pytest.approx(0.3 + m.w[at] @ x + pairs)


def test_interactions_are_learnt():
    """Whether two words are both there or both not: no linear model can tell."""
    m = Q.FactorisationMachine(np.zeros((len(Q.STATISTICS), Q.BINS - 1)))
    cases = [([1, 2], 1), ([3, 4], 1), ([1, 4], 0), ([3, 2], 0)] * 60
    vectors = [(np.array(w), np.ones(2)) for w, _ in cases]
    m.fit(vectors, np.array([y for _, y in cases], float))
    for _ in range(3):
        m.fit(vectors, np.array([y for _, y in cases], float))
    assert all((m.margin(*v) > 0) == bool(y) for v, (_, y) in zip(vectors, cases))


# toxic texts are too few in the smallest tables to learn from
@pytest.mark.parametrize("name, label, sf", [("op3_quality_classifier", "quality", SF_SMALL), ("op4_toxicity", "toxic", SF_NEXT)])
def test_held_out_rows_are_told_apart(spark, name, label, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    found = QUERIES[name](spark, sf)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels, "doc_id").where("held_out").select("score", "y").collect()
    assert auc([tuple(r) for r in rows]) > 0.8
    assert found.where("score < 0 or score > 1").isEmpty()


def test_learning_rows_are_never_held_out(spark):
    rows = labelled_sample(spark, SF_SMALL, "quality", 4, 2, 10_000)
    ids = spark.createDataFrame([(r["doc_id"],) for r in rows], "doc_id long")
    assert rows and ids.where(held_out(4, 2)).isEmpty()


@pytest.mark.parametrize("module", [Q, X])
def test_odd_texts_score(spark, module):
    rows = [{"text": prose(i, 30) + " ###" * (i % 2), "y": i % 2, "n_chars": None} for i in range(40)]
    docs = documents(spark, ODD, extra=True)
    for model in (module.fit(rows), module.fit([])):
        found = module.score(docs, model).collect()
        assert len(found) == len(ODD) and all(0.0 <= r["score"] <= 1.0 for r in found)
    assert {round(r["score"], 9) for r in found} == {0.5}  # nothing learnt
    assert module.score(documents(spark, []), model).collect() == []


def test_misspelt_words_share_vectors():
    insult = (" ", " blockhead ")
    rows = [{"text": insult[i % 2].join(prose(1000 * k + i, 30) for k in range(4)), "y": i % 2} for i in range(400)]
    scorer = X.Scorer(X.fit(rows))
    clean, right, wrong = (
        np.array(scorer([f" {w} ".join(prose(5000 * k + i, 30) for k in range(4)).encode() for i in range(1, 21)]))
        for w in ("", "blockhead", "blokhead")
    )
    assert np.mean(clean < 0.3) >= 0.9 and np.mean(right > 0.5) >= 0.9 and np.mean(wrong > 0.5) >= 0.4
    assert scorer([b"or or or or or or or or or or or or"])[0] < right.min()


def test_subwords_of_a_batch_equal_those_of_each_word():
    words = [b"a", b"heather", "ßü".encode(), b"heather", b"xy"]
    buckets, starts = X.subwords(words)
    for i, (w, start) in enumerate(zip(words, starts)):
        end = starts[i + 1] if i + 1 < len(starts) else len(buckets)
        assert buckets[start:end].tolist() == X.subwords([w])[0].tolist()


# --- language models --------------------------------------------------------------------------


def brute_losses(texts, target):
    """Both models by dictionaries over the same buckets."""
    out = []
    found = [M.buckets(t.encode()) for t in texts]
    vocabulary = len({w for t in texts for w in t.lower().split()}) + 1
    for chosen in (target, range(len(texts))):
        words, before, pairs = Counter(), Counter(), Counter()
        for i in chosen:
            words.update(found[i][0].tolist())
            before.update(found[i][1].tolist())
            pairs.update(found[i][2].tolist())
        n = sum(words.values())
        out.append(
            [
                [
                    -math.log((pairs[p] + M.PRIOR * (words[w] + 1) / (n + vocabulary)) / (before[b] + M.PRIOR))
                    for w, b, p in zip(*(x.tolist() for x in f))
                ]
                for f in found
            ]
        )
    return [tuple(np.mean(x) if x else None for x in pair) for pair in zip(*out)]


def test_losses_equal_brute_force(spark):
    texts = [prose(i, 40) for i in range(12)] + ["", "the same again", "the same again", "w" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, None), (None, "no id here")]
    docs = documents(spark, rows, extra=True)
    ids = spark.createDataFrame([(i,) for i in (0, 2, 4, 13, 13, 999)], "doc_id long")
    found = {r["doc_id"]: r for r in M.score(docs, *M.fit(docs, ids)).collect()}
    expected = brute_losses([t or "" for _, t in rows], [0, 2, 4, 13])
    for (doc, text), (target, background) in zip(rows, expected):
        r = found[doc]
        assert r["n_tokens"] == len((text or "").split())
        if target is None:
            assert r["score"] is None and r["target_loss"] is None
        else:
            assert (r["target_loss"], r["background_loss"]) == pytest.approx((target, background), rel=1e-4)
            assert r["score"] == pytest.approx(target - background, abs=1e-3)


def test_no_target_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long")
    docs = documents(spark, [(1, "a b c")])
    assert M.score(docs, *M.fit(docs, none)).first()["score"] > 0
    empty = documents(spark, [])
    assert M.score(empty, *M.fit(empty, none)).collect() == []


def exact_losses(texts, target):
    """Both models by dictionaries over the words themselves."""
    out, split = [], [t.lower().split() for t in texts]
    pairs_of = [list(zip([None, *w], w)) for w in split]
    vocabulary = len({x for w in split for x in w}) + 1
    for chosen in (target, range(len(texts))):
        words, before, pairs = Counter(), Counter(), Counter()
        for i in chosen:
            words.update(split[i])
            before.update(b for b, _ in pairs_of[i])
            pairs.update(pairs_of[i])
        n = sum(words.values())
        loss = [[-math.log((pairs[b, w] + M.PRIOR * (words[w] + 1) / (n + vocabulary)) / (before[b] + M.PRIOR)) for b, w in p] for p in pairs_of]
        out.append([np.mean(x) if x else None for x in loss])
    return list(zip(*out))


@pytest.mark.parametrize("chunk_bytes, range_keys", [(8_000_000, 1 << 21), (500_000, 60_000)])
def test_words_and_bigrams_are_never_merged(spark, monkeypatch, chunk_bytes, range_keys):
    """More distinct words and bigrams than any table of fixed size would hold apart."""
    monkeypatch.setattr(M, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(M, "RANGE_KEYS", range_keys)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 400_000, 8_000)) for _ in range(120)] + [prose(i, 50) for i in range(20)] + [""]
    docs = documents(spark, list(enumerate(texts)))
    ids = spark.createDataFrame([(i,) for i in range(0, 140, 3)], "doc_id long")
    found = {r["doc_id"]: r for r in M.score(docs, *M.fit(docs, ids)).collect()}
    assert len({w for t in texts for w in t.split()}) > 250_000
    for i, expected in enumerate(exact_losses(texts, range(0, 140, 3))):
        assert (found[i]["target_loss"], found[i]["background_loss"]) == (expected if expected[0] is None else pytest.approx(expected, rel=1e-9))


def test_other_documents_are_scored_but_not_counted(spark):
    docs = documents(spark, [(i, prose(i, 40)) for i in range(10)])
    fitted = M.fit(docs, spark.createDataFrame([(1,), (2,)], "doc_id long"))
    own = {r["doc_id"]: r["score"] for r in M.score(docs, *fitted).collect()}
    other = {r["doc_id"]: r["score"] for r in M.score(docs.where("doc_id < 3"), *fitted).collect()}
    assert other == {i: pytest.approx(own[i], rel=1e-9) for i in range(3)}
