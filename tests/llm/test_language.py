from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.llm import language as L
from panelmill.llm.common import held_out
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD, documents


@pytest.fixture(scope="module")
def model():
    counts = [Counter({"heather": 3, "thing": 5, "anther": 2}), Counter({"ünglich": 4, "schein": 5, "ung": 2})]
    return L.LanguageModel(["de", "en"][::-1], L.vocabulary()).fit(counts)


@pytest.mark.parametrize("word", ["heather", "ünglich", "☃x", "a", "thethe", "entertainment", "straßenbahn"])
def test_forward_sums_all_segmentations(model, word):
    numbers = {p: i for i, p in enumerate(L.vocabulary(), 2)}
    whole = "▁" + word

    def total(at, k):
        if at == len(whole):
            return 1.0
        out = 0.0
        for n in range(1, len(whole) - at + 1):
            piece = whole[at : at + n]
            p = model.p[numbers[piece], k] if piece in numbers else (L.UNKNOWN if n == 1 else 0.0)
            out += p * total(at + n, k) if p else 0.0
        return out

    assert model.word_scores([word])[0] == pytest.approx([math.log(total(0, k)) for k in range(2)])


def test_long_words_have_the_same_sums(model):
    word = "heatherung" * 5
    codes = np.frombuffer(("▁" + word).encode("utf-32-le"), np.uint32).reshape(1, -1)
    assert model._long(codes)[0] == pytest.approx(model.word_scores([word])[0])
    assert np.isfinite(model.word_scores(["x" * 3000])).all()


def test_long_words_are_learnt_from():
    """Languages without spaces: their words are whole sentences."""
    counts = [Counter({"thingheather" * 30: 2, "thingthing" * 4: 1}), Counter({"ungscheinlich" * 30: 2, "lichung" * 5: 1})]
    m = L.LanguageModel(["en", "de"], L.vocabulary()).fit(counts)
    assert m.p[2:].sum(axis=0) == pytest.approx([1.0, 1.0])
    scores = m.word_scores(["heatherthing" * 12, "scheinung" * 12])
    assert scores[0, 0] > scores[0, 1] and scores[1, 1] > scores[1, 0]


def test_one_round_on_a_long_word_equals_plain_sums():
    """Forward and backward sums without scales, which a word of 60 letters still allows."""
    pieces, word = ["▁", "☃", "☃☃", "☃☃☃"], "▁" + "☃" * 60
    p = dict.fromkeys(pieces, 1 / 6)
    ahead, back = [1.0] + [0.0] * len(word), [0.0] * len(word) + [1.0]
    steps = [(i, j, word[i:j]) for i in range(len(word)) for j in range(i + 1, min(i + 3, len(word)) + 1) if word[i:j] in p]
    for i, j, x in sorted(steps, key=lambda s: s[1]):
        ahead[j] += ahead[i] * p[x]
    for i, j, x in sorted(steps, key=lambda s: -s[0]):
        back[i] += p[x] * back[j]
    expected = dict.fromkeys(pieces, 0.01)
    for i, j, x in steps:
        expected[x] += 2 * ahead[i] * p[x] * back[j] / back[0]
    total = sum(expected.values())
    m = L.LanguageModel(["x"], pieces).fit([Counter({"☃" * 60: 2})], rounds=1)
    assert m.p[2:, 0] == pytest.approx([expected[x] / total for x in pieces], rel=1e-6)


def test_expectation_maximisation_raises_the_likelihood():
    counts = [Counter({"heather": 3, "thing": 5, "anther": 2, "there": 4})]

    def likelihood(rounds):
        m = L.LanguageModel(["en"], L.vocabulary()).fit(counts, rounds)
        words = sorted(counts[0])
        return sum(counts[0][w] * s for w, s in zip(words, m.word_scores(words)[:, 0]))

    assert likelihood(1) < likelihood(2) < likelihood(5)


def test_probabilities_are_of_one_sum(model):
    assert model.p[2:].sum(axis=0) == pytest.approx([1.0, 1.0])


def test_odd_texts_and_clashing_names(spark, model):
    docs = documents(spark, [*ODD, (30, "heather thing heather"), (31, "ünglich schein")], extra=True)
    found = L.identify(docs, model)
    assert found.columns == [c for c in docs.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 4, 30, 31)] == ["und"] * 4 + ["en", "de"]
    assert all(0.0 <= r["score"] <= 1.0 for r in rows.values()) and found.count() == len(ODD) + 2
    assert L.identify(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some words", None), (2, None, "en")])
    assert [r["lang_pred"] for r in L.identify(docs, L.fit(docs, F.lit(True))).collect()] == ["und", "und"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = L.identify(docs, L.fit(docs, ~held_out(3, 1))).where(held_out(3, 1))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
