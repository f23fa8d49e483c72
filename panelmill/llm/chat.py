"""Chat formatting with typed content parts.

A message is a role and a list of parts of kind text, image, audio or document. A visitor goes
through the parts in order: text is escaped, every other part becomes a placeholder, and its
reference, its place and the tokens it expands to are recorded. The template marks turns as
``<|im_start|>role`` newline ``content<|im_end|>`` newline. In texts and roles ``&`` and ``<``
are written as entities, and in roles the newline too, so no text can hold a control string
and ``parse`` gives back exactly what was formatted.

Turns of a conversation are brought together by one shuffle and sorted there; a task streams
through them and gives one row per turn with its place in the conversation, so a conversation of
any length needs no more memory than one turn.

Defined cases: a null text or role is empty, null parts are none; a null conv_id is a
conversation of its own; turns that are equal or null are ordered by role and text; an unknown
kind of part is an error; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import small_batches

PARTS = "array<struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document)_\d+\|>")
#: Tokens that other parts expand to: a picture's tiles of 28 x 28 points, 25 a second of sound, 1500 a page.
TILE, SOUND_RATE, PAGE_TOKENS = 28, 25, 1500


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def unescape(text: str) -> str:
    return text.replace("&lt;", "<").replace("&amp;", "&")


@dataclass
class PartVisitor:
    """Flattens the parts of one message."""

    first: int = 0
    content: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        handler = getattr(self, f"visit_{part['kind']}", None)
        if handler is None:
            raise ValueError(f"unknown kind of content part: {part['kind']}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        self.content.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        tiles = math.ceil((part["width"] or TILE) / TILE) * math.ceil((part["height"] or TILE) / TILE)
        self._attach(part, tiles)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0.0) * SOUND_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 1) * PAGE_TOKENS)

    def _attach(self, part: dict, tokens: int) -> None:
        placeholder = f"<|{part['kind']}_{self.first + len(self.attachments)}|>"
        self.attachments.append({"placeholder": placeholder, "kind": part["kind"], "ref": part["ref"], "tokens": tokens})
        self.content.append(placeholder)


def format_turn(role: str, parts: list[dict], first: int = 0) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, start and end of its content in it, its attachments."""
    visitor = PartVisitor(first)
    for part in parts:
        visitor.visit(part)
    content = "".join(visitor.content)
    head = "<|im_start|>" + escape(role).replace("\n", "&#10;") + "\n"
    return f"{head}{content}<|im_end|>\n", len(head), len(head) + len(content), visitor.attachments


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of formatted text; placeholders of other parts stay in the text."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        turns.append((unescape(m[1].replace("&#10;", "\n")), unescape(m[2])))
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation, from character {at}")
    return turns


def text_parts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, parts of a table with one text per turn."""
    part = F.array(
        F.struct(
            F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        )
    )
    return conversations.select("conv_id", "turn", "role", part.cast(PARTS).alias("parts"))


_SCHEMA = (
    "conv_id bigint, position bigint, char_start bigint, formatted string, loss_start bigint, loss_end bigint, "
    "attachments array<struct<placeholder: string, kind: string, ref: string, tokens: bigint>>, expanded_tokens bigint"
)


def _sorted_turns(turns: DataFrame, *order) -> DataFrame:
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_chat(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn, from messages with conv_id, turn, role and parts.

    A conversation is the ``formatted`` texts of its rows by ``position``. The loss mask covers
    ``loss_start`` to ``loss_end`` of a row's text (both null if nothing of it is learnt);
    ``char_start`` is where the row starts in its conversation.
    """
    turns = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, position, chars, attached = object(), 0, 0, 0
        for batch in batches:
            out = []
            for conv, role, parts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "parts")), strict=True):
                if conv != known:
                    known, position, chars, attached = conv, 0, 0, 0
                text, start, end, files = format_turn(role, parts or [], attached)
                learn = role in loss_roles
                out.append((conv, position, chars, text, start if learn else None, end if learn else None, files, sum(f["tokens"] for f in files)))
                position, chars, attached = position + 1, chars + len(text), attached + len(files)
            columns = zip(*out, strict=True) if out else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    small_batches(messages.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(_SCHEMA))
    return _sorted_turns(turns, "turn", "role", F.to_json("parts")).mapInArrow(run, _SCHEMA)


class _Digest:
    """What is read back of one conversation, kept as running hashes."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        for role, text in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            text = unescape(formatted[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """What parsing the formatted conversations gives back, one row for each.

    The rows of a conversation lie together and in order, as ``format_chat`` leaves them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                for conv, text, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    if now is None or conv != now.conv:
                        done += [now.row()] if now else []
                        now = _Digest(conv)
                    now.add(text, start, end)
            elif now:
                done.append(now.row())
            if done:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done = []

    names = [x.split()[0] for x in _DIGEST.split(", ")]
    return formatted.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, _DIGEST)


def placeholders(formatted: str) -> list[str]:
    return _PLACEHOLDER.findall(formatted)
