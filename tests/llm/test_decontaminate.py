from __future__ import annotations

import re

import pytest

from panelmill.llm import decontaminate as D
from tests.llm.helpers import ODD, documents, prose, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = prose(50, 30)
ITEMS = [(1, LONG), (2, "only four words here"), (3, None), (4, "..."), (None, "an item without id"), (5, LONG), (6, "Fôo bar")]
TEXTS = [
    (10, f"before {LONG} after"),
    (11, " ".join(LONG.split()[3:14]).upper() + ", and more"),
    (12, " ".join(LONG.split()[:9])),
    (13, "Only FOUR,words--here; again only four words here"),
    (14, "an item with id"),
    (15, "x an item without id x fôo bar"),
    *[(100 + (r[0] or 0), *r[1:]) for r in ODD],
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(texts, items):
    out = []
    for doc, text in texts:
        words, hit, found = WORD.findall(lower(text or "")), set(), set()
        for item, t in items:
            iw = WORD.findall(lower(t or ""))
            n = min(10, len(iw))
            windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add("null" if item is None else str(item))
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 20])
def test_scan_equals_brute_force(spark, block_words):
    found = D.scan(documents(spark, TEXTS, extra=True), benchmark(spark, ITEMS), block_words=block_words)
    assert rows_of(found.select("doc_id", "n_words", "n_hit", "items")) == brute(TEXTS, ITEMS)


@pytest.mark.parametrize("items, texts", [([], TEXTS[:3]), (ITEMS, [])])
def test_empty_tables(spark, items, texts):
    found = D.scan(documents(spark, texts), benchmark(spark, items))
    assert rows_of(found.select("doc_id", "n_words", "n_hit", "items")) == brute(texts, items)


def test_spans_are_cut_and_the_rest_stays(spark):
    texts = [*TEXTS, (20, "clean text, untouched.\n Really"), (21, LONG)]
    cleaned = D.decontaminate(documents(spark, texts, extra=True), benchmark(spark, ITEMS))
    assert cleaned.columns == documents(spark, [], extra=True).columns
    left = {r["doc_id"]: r for r in cleaned.collect()}
    assert left[20]["text"] == texts[-2][1]
    assert left[10]["text"] == "before after" and left[10]["n_chars"] == len("before after")
    assert left[13]["text"].strip() == "; again" or "four" not in left[13]["text"].lower()
    assert 21 not in left  # nothing but a passage
    assert all(n == 0 for _, _, n, _ in brute([(r["doc_id"], r["text"]) for r in left.values()], ITEMS))
    assert {101, 102, 107} <= set(left)  # empty texts aren't contaminated


def test_spans_over_blocks_are_joined(spark):
    docs, items = documents(spark, TEXTS), benchmark(spark, ITEMS)
    one, several = (D.scan(docs, items, block_words=n).select("doc_id", "n_words", "n_hit", "spans", "items") for n in (10**6, 10))
    assert rows_of(one) == rows_of(several)


def test_documents_mode_over_blocks(spark):
    docs, items = documents(spark, TEXTS), benchmark(spark, ITEMS)
    one, several = (D.decontaminate(docs, items, remove="documents", block_words=n) for n in (10**6, 10))
    assert rows_of(one) == rows_of(several)


def test_documents_mode_drops_only_hit_documents(spark):
    kept = D.decontaminate(documents(spark, TEXTS), benchmark(spark, ITEMS), remove="documents")
    clean = [d for d, _, n, _ in brute(TEXTS, ITEMS) if n == 0]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(clean, key=repr)
    with pytest.raises(ValueError):
        D.decontaminate(documents(spark, []), benchmark(spark, []), remove="lines")


def test_blocks_cut_what_one_block_cuts(spark):
    a, b = prose(60, 12).split(), prose(61, 12).split()
    over = " ".join(f"w{i}" for i in range(1, 16)).split()
    items = [(1, " ".join(over[:10])), (2, " ".join(over[5:])), (3, " ".join(a)), (4, " ".join(b))]
    nested = " ".join([*a[:5], *b, *a[5:]])  # a is whole only when b is cut
    texts = [
        (1, "before " + " ".join(over) + " after"),
        (2, f"x {nested} y"),
        (3, nested),
        (4, "untouched, Text"),
        (5, None),
        (5, " ".join([*b[:6], *a, *b[6:], "end"])),
        (None, " ".join(over[:10])),
    ]
    docs = documents(spark, texts, extra=True)
    one, several = (D.decontaminate(docs, benchmark(spark, items), block_words=n) for n in (D.BLOCK_WORDS, 10))
    assert several.columns == docs.columns
    assert rows_of(several) == rows_of(one)
    assert {r["doc_id"]: r["text"] for r in several.collect()}[1] == "before after"
