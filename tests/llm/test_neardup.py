from __future__ import annotations

import random
import re

import pytest

from panelmill.llm import neardup as N
from tests.llm.helpers import ODD, documents, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, words):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(words, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(texts, words):
    sets = [(d, shingle_set(t, words)) for d, t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (di, a) in enumerate(sets):
        for j, (dj, b) in enumerate(sets[:i]):
            if a and b and di is not None and dj is not None and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, s) in enumerate(sets):
        component = None if d is None else least[find(i)]
        out.append((d, len(s), component, d is None or d == component))
    return sorted(out, key=repr)


def edited(text, edits, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def chain(n):
    """Each text is close to the next only."""
    words = prose(99, 100 + 6 * n).split()
    return [" ".join(words[6 * i : 6 * i + 100]) for i in range(n)]


def corpus():
    out, rng = list(ODD), random.Random(5)
    base, passage = [prose(i, 120) for i in range(6)], prose(77, 60)
    texts = [*base, *base[:3]]
    texts += [edited(base[0], rng.randint(1, 6), i) for i in range(40)]  # a large group of near copies
    texts += [f"{prose(200 + i, 25)} {passage}" for i in range(40)]  # mostly one passage, seldom linked
    texts += [f"{passage} {prose(300 + i, 4)}" for i in range(10)]  # linked through it
    texts += chain(12)
    texts += ["Tiny Text", "tiny text", "tiny", "tiny text here now", "a b c d e f g h i j", "A b c d e f g h i j K"]
    rng.shuffle(texts)
    return out + [(100 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words", [4, 5])
def test_components_equal_brute_force(spark, words):
    rows = corpus()
    found = N.near_duplicates(documents(spark, rows, extra=True), words=words)
    assert rows_of(found) == brute(rows, words)


def test_small_sketches_still_find_sure_links(spark):
    """Only texts with whole sketches and exact copies: the rule is exact for any k."""
    rows = [(i, t) for i, t in enumerate(["a b c d e", "a b c d e", "A B C D E", "b c d e f g", "x y", "X y"])]
    assert rows_of(N.near_duplicates(documents(spark, rows), words=4, k=16, shared=8)) == brute(rows, 4)


def test_drawn_hubs_are_only_a_short_cut(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(N, "DRAWN_ROUNDS", 0)
    assert rows_of(N.near_duplicates(documents(spark, rows), words=4)) == brute(rows, 4)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(20, 60)]
    star = [(3, i) for i in range(100, 130)]
    expected = dict.fromkeys(range(21, 61), 20) | dict.fromkeys(range(100, 130), 3)
    for most in (1000, 7):
        found = N.components(spark.createDataFrame(path + star, "a long, b long"), most).collect()
        assert dict(tuple(r) for r in found) == expected and len(found) == len(expected)
    assert N.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    kept = N.deduplicated(documents(spark, rows, extra=True), words=5)
    assert kept.columns == documents(spark, [], extra=True).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted({r[0] for r in brute(rows, 5) if r[3]}, key=repr)


def test_empty_table(spark):
    assert N.near_duplicates(documents(spark, [])).collect() == []
    assert N.deduplicated(documents(spark, [(1, None), (2, "")])).count() == 2


def test_texts_of_a_repeated_id_are_judged_each(spark):
    a, b = prose(1, 80), prose(2, 80)
    rows = [(3, a), (5, a), (5, b), (5, b), (7, edited(b, 1, 1)), (8, "tiny"), (8, ""), (8, None), (None, a), (None, a)]
    kept = N.deduplicated(documents(spark, rows), words=5)
    assert rows_of(kept.select("doc_id", "text")) == sorted(
        [(3, a), (5, b), (8, "tiny"), (8, ""), (8, None), (None, a), (None, a)], key=repr
    )


def test_pairs_of_open_lists_meet_once(spark, monkeypatch):
    """A line that a third of the texts have, and close texts that are not linked: pairs are far fewer than in all lists."""
    line = prose(50, 30)
    base = prose(51, 200)
    rows = [(i, f"{prose(400 + i, 70)} {line}") for i in range(60)]
    rows += [(200 + i, edited(base, 3, i)) for i in range(50)]  # most pairs fall just short of a link
    rows += [(300 + i, prose(600 + i, 90)) for i in range(60)]
    made: list[int] = []
    pairs_of = N._all_pairs

    def counted(members, rule):
        pairs = pairs_of(members, rule)
        seen = pairs.collect()
        made.append(len(seen))
        assert len(set(seen)) == len(seen)
        return pairs

    monkeypatch.setattr(N, "_all_pairs", counted)
    monkeypatch.setattr(N, "DRAWN_ROUNDS", 0)
    assert rows_of(N.near_duplicates(documents(spark, rows), words=4)) == brute(rows, 4)
    assert made and made[0] <= 50 * 49 / 2
