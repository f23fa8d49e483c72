"""Quality rules as a short-circuit cascade, cheapest rejection first.

Each rule looks at features of a text that are worked out when first asked for. On a
sample the cost and the rejections of each rule are measured alone; rules run in order of
rejections per second, and a document stops at the first that rejects it. The order
changes the cost and never the verdict, so it may differ between runs.

Words are runs without space and the controls 9 to 13. Defined cases: a null or empty text
has no words and fails the rule on length; repeated rows get equal verdicts; an empty sample
keeps the given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from panelmill.llm.common import WordCache, bounded_sample, map_texts, ngram_hashes, remembered, utf8

#: Documents, about, on which cost and selectivity are measured.
SAMPLE_ROWS = 400

_NOT_COUNTED = bytes([*range(0x80, 0xC0), 0x20, *range(0x09, 0x0E)])  # trailing bytes of a code point, white space
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_hashes = WordCache(xxhash.xxh64_intdigest)
remembered(_hashes.clear)


class Text:
    """Features of one text, each worked out once and only if a rule asks for it."""

    def __init__(self, text: bytes):
        self.text = text

    def _count(self, characters: bytes) -> int:
        return len(self.text) - len(self.text.translate(None, characters))

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(None, _NOT_COUNTED))

    @cached_property
    def n_symbols(self) -> int:
        return self._count(_SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside three-word windows that the text holds at least twice."""
        windows = ngram_hashes(_hashes.array(self.words, np.uint64), 3)
        ordered = np.sort(windows)
        again = np.zeros(len(windows) + 2, bool)
        starts = np.flatnonzero(np.isin(windows, ordered[1:][ordered[1:] == ordered[:-1]]))
        for i in range(3):
            again[starts + i] = True
        return int(again.sum())

    @cached_property
    def n_upper(self) -> int:
        return self._count(_UPPER)

    @cached_property
    def n_lower(self) -> int:
        return self._count(_LOWER)


#: What each rule rejects. The first two are the base rules.
RULES: dict[str, Callable[[Text], bool]] = {
    "few_words": lambda t: t.n_words < 50,
    "repeated_words": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "repeated_lines": lambda t: 10 * t.n_dup_lines > 3 * len(t.lines),
    "symbols": lambda t: 10 * t.n_symbols > 3 * t.n_words,
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 14 * t.n_words,
    "capitals": lambda t: t.n_upper > t.n_lower,
}
BASE = ("few_words", "repeated_words")


def measured_order(texts: list[bytes], rules: dict[str, Callable[[Text], bool]] = RULES) -> list[str]:
    """Rules by rejections per second on a sample; a rule starts from the bare text."""
    gain = {}
    for name, rejects in rules.items():
        start = time.perf_counter()
        rejected = sum(rejects(Text(t)) for t in texts)
        gain[name] = rejected / max(time.perf_counter() - start, 1e-9)
    return sorted(rules, key=lambda name: -gain[name])


def sample_texts(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[bytes]:
    """About ``rows`` texts, and never more, chosen by a hash of id and text."""
    return [(r["text"] or "").encode() for r in bounded_sample(docs.select("doc_id", "text"), rows).collect()]


def cascade(docs: DataFrame, order: list[str] | None = None, counts: bool = False) -> DataFrame:
    """doc_id, kept and rejected_by (null if kept) of every document.

    With ``counts`` also the features behind the base rules, which then are worked out for all
    documents. ``order`` is measured on a sample of the documents unless given.
    """
    order = order or measured_order(sample_texts(docs))
    features = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") if counts else ()

    def work():
        def verdict(text: Text) -> str | None:
            return next((name for name in order if RULES[name](text)), None)

        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            texts = [Text(t) for t in utf8(rows.column("text"))]
            verdicts = [verdict(t) for t in texts]
            columns = {f: pa.array([getattr(t, f) for t in texts], pa.int64()) for f in features}
            if counts:
                columns["base_failed"] = pa.array([any(RULES[r](t) for r in BASE) for t in texts], pa.bool_())
            columns |= {"kept": pa.array([v is None for v in verdicts], pa.bool_()), "rejected_by": pa.array(verdicts, pa.string())}
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns.values()], ["doc_id", *columns])

        return do

    extra = "".join(f"{f} bigint, " for f in features) + ("base_failed boolean, " if counts else "")
    return map_texts(docs.select("doc_id", "text"), work, f"doc_id bigint, {extra}kept boolean, rejected_by string")
