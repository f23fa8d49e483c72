from __future__ import annotations

import re
from collections import Counter

from panelmill.llm import rules as R
from panelmill.llm.common import bounded_sample
from tests.llm.helpers import ODD, documents, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    *ODD,
    (20, prose(2, 200)),
    (21, "\n".join(["one line of words"] * 30)),
    (22, " ".join(f"{w}###" for w in prose(3, 80).split())),
    (23, prose(4, 100).upper()),
    (24, "a b c d " * 5 + prose(5, 60)),
    (25, "eins zwei\n\n \neins zwei\nEins zwei\n" + prose(6, 60)),
    (26, "ß é ü " * 4),
]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)} if len(words) < 2000 else None
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), again


def test_counts_equal_brute_force(spark):
    found = R.cascade(documents(spark, TEXTS, extra=True), counts=True)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(TEXTS)
    for doc, text in TEXTS:
        r, (n, chars, symbols, dup, again) = by_id[doc], brute(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (n, chars, symbols, dup)
        if again is not None:
            assert r["n_repeat_words"] == len(again)
            assert r["base_failed"] == (n < 50 or 100 * len(again) > 50 * n)
        assert not (r["base_failed"] and r["kept"])
    assert by_id[20]["kept"] and not by_id[22]["kept"] and not by_id[23]["kept"]


def test_order_changes_no_verdict(spark):
    docs = documents(spark, TEXTS)
    one = rows_of(R.cascade(docs, order=list(R.RULES)).select("doc_id", "kept"))
    assert one == rows_of(R.cascade(docs, order=list(R.RULES)[::-1]).select("doc_id", "kept"))
    assert one == rows_of(R.cascade(docs).select("doc_id", "kept"))


def test_order_is_by_rejections_per_cost():
    slow = {"slow": lambda t: sum(range(200_000)) >= 0, "never": lambda t: False, "quick": lambda t: True}
    assert R.measured_order([b"a b"] * 20, slow) == ["quick", "slow", "never"]
    assert R.measured_order([], slow) == list(slow)


def test_empty_table(spark):
    assert R.cascade(documents(spark, []), counts=True).collect() == []


def test_samples_are_bounded_whatever_the_ids(spark):
    """Rows without an id, rows of one id, and copies of a row do not pass together."""
    rows = [(None, f"without an id {i}", "en") for i in range(1500)] + [(5, f"one id {i}", "de") for i in range(1500)]
    rows += [(None, "a copy", "en")] * 500 + [(i, f"an id {i}", "en") for i in range(10, 1000)]
    docs = documents(spark, rows)
    texts = R.sample_texts(docs, rows=100)
    assert 50 <= len(texts) <= 100 and len(set(texts)) == len(texts)
    kinds = {" ".join(t.decode().split()[:2]) for t in texts}
    assert {"without an", "one id", "an id"} <= kinds
    by = Counter(r["lang"] for r in bounded_sample(docs, 100, by="lang").collect())
    assert set(by) == {"en", "de"} and all(50 <= n <= 100 for n in by.values())
    few = documents(spark, rows[:20])
    assert len(R.sample_texts(few, rows=100)) == 20 and R.sample_texts(documents(spark, []), rows=100) == []
