"""Small tables with the cases that every operator on documents has to define."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, syllables: str = "an ter ing ou shor blen ea whin dor") -> str:
    rng, parts = random.Random(seed), syllables.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def documents(spark, rows, extra: bool = False):
    """Documents from (doc_id, text[, lang]); with ``extra`` also columns whose names clash with results."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        clash = ("score", "kept", "spans", "sketch", "n_words", "ids", "lang_pred", "row_hash", "text_hash", "length")
        df = df.selectExpr("*", *[f"'x' as {c}" for c in clash])
    return df


#: Null, empty, white space, no letters, very long word, very long text, repeated rows, null id.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "### 12 !! \U0001f600"),
    (5, "x" * 30_000),
    (6, prose(1, 15_000)),
    (7, "the same words here"),
    (7, "the same words here"),
    (None, "a row without an id"),
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
