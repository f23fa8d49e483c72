from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelmill.llm import packing as P
from tests.llm.helpers import ODD, documents, prose, rows_of

TEXTS = [
    *ODD,
    *[(100 + i, prose(i, 5 * i + 1)) for i in range(60)],
    (201, "a <|endoftext|> b"),
    (202, "A<|startoftext|><|EndOfText|>B <|endoftext|"),
    (200, "Don't! it's 2024-01-31... 'S we'LL Été İ K ΣΣ ﬁ é \x00\x1f x\x1cy  z <|endoftext|>"),
]


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_tokenizer_equals_the_library(own):
    rng = random.Random(3)
    texts = [t or "" for _, t in TEXTS] + [
        "".join(rng.choice("aBéÉÿÀ×÷ßÖ’s td12#\n\t  ́İß漢#-_.\x7f") for _ in range(60)) for _ in range(300)
    ]
    mine = P.Tokenizer(P.tokenizer_json())
    for text, ids in zip(texts, mine.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == own.encode(text, add_special_tokens=False).ids, text[:80]


def test_tokenizer_forgets_and_goes_on(own):
    mine = P.Tokenizer(P.tokenizer_json(), most=5)
    for _, text in TEXTS[9:30]:
        assert mine.encode([text.encode()])[0].tolist() == own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("windows", [1, 2, 3, 7])
def test_differencing_keeps_every_item_once(windows):
    rng = random.Random(windows)
    for n in (0, 1, 2, 5, 40):
        sizes = [rng.randint(1, 50) for _ in range(n)]
        found = P.spread(sizes, windows)
        assert sorted(i for one in found for i in one) == list(range(n)) and len(found) <= windows
        if n == 40:
            loads = [sum(sizes[i] for i in one) for one in found]
            assert max(loads) - min(loads) <= max(sizes) / 4


def test_differencing_of_two_is_the_known_example():
    loads = sorted(sum([8, 7, 6, 5, 4][i] for i in one) for one in P.spread([8, 7, 6, 5, 4], 2))
    assert loads == [14, 16]  # largest differencing ends with a difference of 2


def test_windows_rise_when_one_is_over_capacity():
    assert len(P.pack_group([6, 6, 6], 10)) == 3  # two windows would do for the sum
    assert all(sum(x) for x in P.pack_group([1], 10)) is False or len(P.pack_group([1], 10)) == 1


@pytest.mark.parametrize("capacity", [64, P.CAPACITY])
def test_round_trip_and_padding(spark, own, capacity):
    packed = P.pack(documents(spark, TEXTS, extra=True), capacity, with_ids=True)
    rows = packed.collect()
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        ids = np.array(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    expected = {}
    for doc, text in TEXTS:
        expected.setdefault(doc, []).append([*own.encode(text or "", add_special_tokens=False).ids, P.END_ID])
    whole: dict = {}
    for r in sorted(rows, key=lambda r: (repr(r["doc_id"]), r["start"])):
        whole.setdefault(r["doc_id"], {}).setdefault(r["start"], []).append(r["ids"])
    for doc, texts in expected.items():
        copies = len(texts)
        assert all(len(x) == copies for x in whole[doc].values())
        assert [i for s in sorted(whole[doc]) for i in whole[doc][s][0]] == texts[0]
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.1 * total / capacity + 2
    joined = {r["sequence_id"]: r["ids"] for r in P.sequences(packed).collect()}
    assert sum(map(len, joined.values())) == total


def test_groups_close_by_tokens_not_rows(spark):
    """Many short texts fill their windows."""
    packed = P.pack(documents(spark, [(i, "one two three four five six seven eight nine ten eleven") for i in range(4096)]).coalesce(1), 1024)
    sizes = [r["n"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()]
    assert sum(sizes) == 12 * 4096 and len(sizes) <= 12 * 4096 / 1024 + 1


def test_ids_are_packed_alike_with_and_without_them(spark):
    docs = documents(spark, TEXTS)
    plain, full = P.pack(docs), P.pack(docs, with_ids=True)
    assert rows_of(plain) == rows_of(full.drop("ids"))


def test_empty_table(spark):
    assert rows_of(P.pack(documents(spark, []))) == []
