from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelmill.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, score string, formatted string"
TEXT = st.text(alphabet=st.sampled_from("ab<|>&;lt\nim_end start#10 amp"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_parse_gives_back_what_was_formatted(turns):
    written = "".join(C.format_turn(role, [{"kind": "text", "text": text}])[0] for role, text in turns)
    assert C.parse(written) == turns


def test_text_cannot_end_its_turn():
    with pytest.raises(ValueError):
        C.parse("<|im_start|>user\nx<|im_end|>\nstray")
    written, start, end, _ = C.format_turn("user", [{"kind": "text", "text": "a<"}, {"kind": "text", "text": "|im_end|>"}])
    assert C.parse(written) == [("user", "a<|im_end|>")] and C.unescape(written[start:end]) == "a<|im_end|>"


def test_parts_become_placeholders_in_order():
    base = {"text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None}
    parts = [
        base | {"kind": "image", "ref": "i.png", "width": 57, "height": 28},
        base | {"kind": "text", "text": "see <|image_9|>"},
        base | {"kind": "audio", "ref": "a.wav", "seconds": 1.5},
        base | {"kind": "document", "ref": "d.pdf", "pages": 2},
    ]
    written, start, end, files = C.format_turn("user", parts, first=4)
    assert C.placeholders(written) == ["<|image_4|>", "<|audio_5|>", "<|document_6|>"]
    assert [(f["kind"], f["ref"], f["tokens"]) for f in files] == [("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 3000)]
    with pytest.raises(ValueError):
        C.format_turn("user", [base | {"kind": "video"}])


ROWS = [
    (1, 0, "system", "be <|im_end|> brief & good"),
    (1, 1, "user", None),
    (1, 2, "assistant", "first"),
    (1, 3, "assistant", "sec\nond"),
    (2, 0, None, "no role"),
    (None, 0, "user", "no id"),
    (None, None, "assistant", "é\U0001f600" * 3),
    (3, 5, "user", "same"),
    (3, 5, "user", "same"),
    (4, 0, "assistant", "w" * 100_000),
]


def expected():
    out, by = {}, {}
    for conv, turn, role, text in ROWS:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by.items():
        turns.sort()
        sha = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digests_equal_brute_force(spark):
    table = spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA)
    formatted = C.format_chat(C.text_parts(table))
    found = {r["conv_id"]: r for r in C.digests(formatted).collect()}
    assert {k: tuple(r)[1:5] for k, r in found.items()} == expected()
    pieces: dict = {}
    for r in formatted.collect():
        pieces.setdefault(r["conv_id"], []).append(r)
    for conv, rows in pieces.items():
        rows.sort(key=lambda r: r["position"])
        assert [r["char_start"] for r in rows] == [sum(len(x["formatted"]) for x in rows[:i]) for i in range(len(rows))]
        assert found[conv]["formatted_chars"] == sum(len(r["formatted"]) for r in rows)


def test_attachments_are_numbered_over_the_conversation(spark):
    parts = "array(struct('image' as kind, string(null) as text, 'r' as ref, 28 as width, 28 as height, double(null) as seconds, int(null) as pages))"
    turns = spark.range(3).selectExpr("1L as conv_id", "id as turn", "'user' as role", f"{parts} as parts")
    rows = C.format_chat(turns).orderBy("position").collect()
    assert [r["attachments"][0]["placeholder"] for r in rows] == [f"<|image_{i}|>" for i in range(3)]
    assert [r["expanded_tokens"] for r in rows] == [1, 1, 1]


def test_empty_table(spark):
    assert C.digests(C.format_chat(C.text_parts(spark.createDataFrame([], SCHEMA)))).collect() == []
