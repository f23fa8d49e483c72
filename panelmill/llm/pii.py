"""Personal data: exact patterns, and a character-level BiLSTM with CRF transitions that adds to them.

The patterns find e-mail addresses, IPv4 addresses, card numbers and telephone numbers; their
matches always stay. A small bidirectional LSTM reads windows of characters and a CRF over B/I
tags decodes them (Viterbi). It is trained in numpy on labelled spans: the patterns' matches in a
bounded sample of documents, some of them rewritten so that the patterns miss them (numbers
without country code, other separators, spaces about ``@`` and dots), with their labels.

Windows overlap by half. What all windows of a text decode is reconciled over the text: a span
cut by a window's edge gives way to the window that has it whole, spans of one kind that meet are
joined, and of different kinds the longer stays. An added span must hold what its kind is made
of (``plausible``: an ``@`` or digits) and may not touch a pattern's match. So a window without
a digit or ``@`` can add nothing and isn't decoded; that is most of them.

Defined cases: a null text is empty and has no spans; offsets count code points, ends are
exclusive; with no labelled span to learn from only the patterns are used; repeated rows get
equal spans.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import bounded_sample, map_texts, strings

KINDS = ("email", "ip", "card", "phone")
#: Bounds of fitting: documents, about, whose spans the model is trained on, and windows of them (``TRAIN_MOST`` below).
SAMPLE_ROWS = 1500
WINDOW, STRIDE = 128, 64
HIDDEN, EPOCHS, BATCH, RATE = 16, 12, 48, 0.02
TRAIN_WINDOW, TRAIN_MOST = 80, 2400

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that fails from the first digit of a run fails from its others too, and matches end with a run.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, by start and then kind."""
    found: list[Span] = []
    at = text.find("@")
    least = 0
    while at >= 0:
        start = at
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            least = m.end()
        at = text.find("@", max(at + 1, least))
    if _DIGITS.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if len(m[0]) >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def plausible(kind: str, span: str) -> bool:
    """Whether a decoded span holds what its kind is made of."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == "email":
        head, at, tail = span.partition("@")
        return bool(at and any(c.isalnum() for c in head) and re.search(r"[A-Za-z0-9] ?\. ?[A-Za-z]", tail))
    if any(c.isalpha() for c in span):
        return False
    if kind == "ip":
        parts = [p for p in _NOT_DIGIT.split(span) if p]
        return len(parts) == 4 and all(map(_byte, parts))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15 and not digits == span


# --- the model -----------------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_CHARS = 131


def char_ids(text: str) -> np.ndarray:
    """ASCII as it is; further letters, further white space and all else as one each."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(codes < 128, codes, np.where(codes < 0x2000, 128, np.where(codes < 0x2070, 129, 130))).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Tagger:
    """BiLSTM with CRF; ``p`` has the parameters. Character embedding and input weights are one table."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 7):
        rng, h = np.random.default_rng(seed), hidden
        self.hidden = h
        self.p = {
            **{f"x{d}": rng.normal(0, 0.3, (_CHARS + 1, 4 * h)) for d in "fb"},  # the last row is outside of the text
            **{f"h{d}": rng.normal(0, 0.5 / np.sqrt(h), (h, 4 * h)) for d in "fb"},
            "out": rng.normal(0, 0.3, (2 * h, TAGS)),
            "bias": np.zeros(TAGS),
            "move": rng.normal(0, 0.1, (TAGS, TAGS)),
        }
        for d in "fb":
            self.p[f"x{d}"][:, h : 2 * h] += 1.0  # forget gates start open

    def _lstm(self, ids: np.ndarray, d: str, keep: bool):
        """States of one direction, time first; with ``keep`` what the way back needs."""
        h, (n, steps) = self.hidden, ids.shape
        x, w = self.p[f"x{d}"], self.p[f"h{d}"]
        state, cell = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
        out, tape = np.zeros((steps, n, h), x.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = x[ids[:, t]] + state @ w
            gates = _sigmoid(z[:, : 3 * h])
            new = np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, cell = cell, f * cell + i * new
            squashed = np.tanh(cell)
            if keep:
                tape.append((t, state, before, i, f, o, new, squashed))
            state = o * squashed
            out[t] = state
        return out, tape

    def emissions(self, ids: np.ndarray, keep: bool = False):
        """Scores of the tags, time first."""
        forward, tape_f = self._lstm(ids, "f", keep)
        backward, tape_b = self._lstm(ids, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, tape_f, tape_b

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tags of each window."""
        scores, *_ = self.emissions(ids)
        steps, n, _ = scores.shape
        best, back = scores[0], np.zeros((steps, n, TAGS), np.int8)
        for t in range(1, steps):
            ways = best[:, :, None] + self.p["move"]
            back[t] = ways.argmax(axis=1)
            best = np.take_along_axis(ways, back[t][:, None, :].astype(np.int64), axis=1)[:, 0] + scores[t]
        tags = np.zeros((n, steps), np.int8)
        now = best.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            tags[:, t] = now
            now = back[t][np.arange(n), now] if t else now
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean CRF loss of windows with known tags, and its gradients."""
        scores, both, tape_f, tape_b = self.emissions(ids, keep=True)
        steps, n, _ = scores.shape
        move, rows = self.p["move"], np.arange(n)
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + move, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        d_scores = np.exp(alpha + beta - total[:, None]) / n
        d_move = np.zeros_like(move)
        gold = np.zeros(n)
        for t in range(steps):
            gold += scores[t][rows, tags[:, t]]
            d_scores[t][rows, tags[:, t]] -= 1.0 / n
            if t:
                joint = alpha[t - 1][:, :, None] + move + (scores[t] + beta[t] - total[:, None])[:, None, :]
                d_move += np.exp(joint).sum(axis=0) / n
                np.add.at(d_move, (tags[:, t - 1], tags[:, t]), -1.0 / n)
                gold += move[tags[:, t - 1], tags[:, t]]
        flat = d_scores.reshape(-1, TAGS)
        grads = {"out": both.reshape(-1, both.shape[2]).T @ flat, "bias": flat.sum(axis=0), "move": d_move}
        d_both = d_scores @ self.p["out"].T
        h = self.hidden
        for d, tape, d_out in (("f", tape_f, d_both[:, :, :h]), ("b", tape_b, d_both[:, :, h:])):
            w = self.p[f"h{d}"]
            d_x, d_w = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(w)
            d_state, d_cell = np.zeros((n, h)), np.zeros((n, h))
            for t, state, before, i, f, o, new, squashed in reversed(tape):
                d_state = d_state + d_out[t]
                d_cell = d_cell + d_state * o * (1 - squashed**2)
                dz = np.concatenate(
                    [d_cell * new * i * (1 - i), d_cell * before * f * (1 - f), d_state * squashed * o * (1 - o), d_cell * i * (1 - new**2)], axis=1
                )
                d_w += state.T @ dz
                np.add.at(d_x, ids[:, t], dz)
                d_state, d_cell = dz @ w.T, d_cell * f
            grads[f"x{d}"], grads[f"h{d}"] = d_x, d_w
        return float((total - gold).mean()), grads

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Tagger:
        """Adam on batches of windows."""
        rng, step = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            for batch in np.array_split(rng.permutation(len(ids)), -(-len(ids) // BATCH)):
                step += 1
                _, grads = self.gradients(ids[batch], tags[batch])
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g**2 - second[k])
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def compact(self) -> Tagger:
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def tag_runs(tags: np.ndarray) -> list[Span]:
    """Spans of a tag sequence: B or a change of kind begins one."""
    spans: list[list] = []
    for i in np.flatnonzero(tags).tolist():
        kind = KINDS[(int(tags[i]) - 1) // 2]
        if spans and spans[-1][2] == i and spans[-1][0] == kind and tags[i] % 2 == 0:
            spans[-1][2] = i + 1
        else:
            spans.append([kind, i, i + 1])
    return [tuple(s) for s in spans]


# --- training data -----------------------------------------------------------------------------


def rewritten(kind: str, span: str, rng: np.random.Generator) -> str:
    """The same datum in a form that the patterns miss."""
    if kind == "phone":
        rest = span.lstrip("+0123456789").strip(" -.") if not span[1:].isdigit() else span[1:]
        return rest if rng.random() < 0.5 else re.sub(r"[() .-]+", "-", rest).strip("-")
    if kind == "email":
        return span.replace("@", " @ ") if rng.random() < 0.5 else span.replace("@", " @").replace(".", " . ", 1)
    if kind == "ip":
        return span.replace(".", " . " if rng.random() < 0.5 else "-")
    digits, mark = _NOT_DIGIT.sub("", span), "./"[int(rng.random() < 0.5)]
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def training_windows(texts: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Character ids and tags of windows about labelled spans, and about other digits and ``@``."""
    rng, windows = np.random.default_rng(seed), []
    half = TRAIN_WINDOW // 2
    for text in texts:
        spans, end = [], 0
        for kind, a, b in base_spans(text):
            if a >= end:
                spans.append((kind, a, b))
                end = b
        out, labels, at = [], [], 0
        for kind, a, b in spans:
            new = rewritten(kind, text[a:b], rng) if rng.random() < 0.5 else text[a:b]
            out += [text[at:a], new]
            labels += [np.zeros(a - at, np.int8), np.full(len(new), 2 + 2 * KINDS.index(kind), np.int8)]
            if new:
                labels[-1][0] -= 1
            at = b
        whole = "".join([*out, text[at:]])
        tags = np.concatenate([np.zeros(0, np.int8), *labels, np.zeros(len(text) - at, np.int8)])
        ids = char_ids(whole)
        marks = np.flatnonzero((ids == 64) | (ids >= 48) & (ids <= 57))
        starts = np.flatnonzero(tags % 2 == 1)
        other = marks[tags[marks] == 0] if len(marks) else marks
        for centre in [*starts[:8], *rng.permutation(other)[:2]]:
            first = int(centre) - int(rng.integers(0, TRAIN_WINDOW - 8)) if rng.random() < 0.7 else int(centre) - half
            x, y = np.full(TRAIN_WINDOW, _CHARS, np.int64), np.zeros(TRAIN_WINDOW, np.int8)
            a, b = max(0, first), min(len(ids), first + TRAIN_WINDOW)
            if b > a:
                x[a - first : b - first], y[a - first : b - first] = ids[a:b], tags[a:b]
                windows.append((x, y))
    windows = [windows[i] for i in rng.permutation(len(windows))[:TRAIN_MOST]]
    shape = (len(windows), TRAIN_WINDOW)
    return np.array([w[0] for w in windows], np.int64).reshape(shape), np.array([w[1] for w in windows], np.int64).reshape(shape)


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Tagger | None:
    """A tagger from the patterns' matches in about ``rows`` documents, and never more; nothing, if there are no matches."""
    some = docs.select("doc_id", "text").where(F.col("text").rlike(r"[0-9.]{7}|[0-9]-[0-9]{3}|@"))
    texts = [r["text"] for r in bounded_sample(some, rows).collect()]
    if not any(base_spans(t) for t in texts):
        return None
    return Tagger().fit(*training_windows(sorted(texts))).compact()


# --- application --------------------------------------------------------------------------------


def reconciled(found: list[tuple[Span, bool]]) -> list[Span]:
    """Spans of all windows of a text put together; the flag says that a window's edge cuts the span."""
    whole = [s for s, cut in found if not cut]
    spans = list(whole)
    for s, cut in found:
        if cut and not any(a < s[2] and s[1] < b for _, a, b in whole):
            spans.append(s)
    joined: list[list] = []
    for kind, a, b in sorted(set(spans), key=lambda s: (s[0], s[1])):
        if joined and joined[-1][0] == kind and a <= joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], b)
        else:
            joined.append([kind, a, b])
    kept: list[Span] = []
    for kind, a, b in sorted(joined, key=lambda s: (s[1] - s[2], s[1], s[0])):
        if all(b <= x or y <= a for _, x, y in kept):
            kept.append((kind, a, b))
    return kept


def all_spans(texts: list[str], model: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(patterns' spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    windows, places = [], []
    for i, text in enumerate(texts):
        if "@" not in text and not _DIGITS.search(text):
            continue
        ids = char_ids(text)
        marks = np.flatnonzero((ids == 64) | (ids >= 48) & (ids <= 57)) // STRIDE
        for k in np.unique(np.r_[marks, marks - 1]).tolist():
            if k < 0 and len(ids) > STRIDE:  # the window from 0 has it whole
                continue
            first = max(0, k * STRIDE)
            part = ids[first : first + WINDOW]
            windows.append(np.r_[part, np.full(WINDOW - len(part), _CHARS)])
            places.append((i, first, len(ids)))
    found: dict[int, list] = {}
    for at in range(0, len(windows), 1024):
        tags = model.decode(np.array(windows[at : at + 1024]))
        for row in np.flatnonzero(tags.any(axis=1)).tolist():
            i, first, size = places[at + row]
            for kind, a, b in tag_runs(tags[row]):
                cut = a == 0 and first > 0 or b == WINDOW and first + WINDOW < size
                if first + a < size:
                    found.setdefault(i, []).append(((kind, first + a, min(size, first + b)), cut))
    out = [(b, b) for b in base]
    for i, spans in found.items():
        added = []
        for kind, a, b in reconciled(spans):
            a, b = _trimmed(texts[i], a, b)
            if b > a and plausible(kind, texts[i][a:b]) and all(b <= x or y <= a for _, x, y in base[i]):
                added.append((kind, a, b))
        if added:
            out[i] = (base[i], sorted([*base[i], *added], key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SQL = "array<struct<kind: string, start: bigint, end: bigint>>"


def find(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """doc_id, base_spans and spans (kind, start, end) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def column(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in one] for one in spans], _SPANS)

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = all_spans(strings(rows.column("text")), sent.value)
            columns = [rows.column("doc_id"), column([f[0] for f in found]), column([f[1] for f in found])]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "base_spans", "spans"])

        return do

    return map_texts(docs.select("doc_id", "text"), work, f"doc_id bigint, base_spans {_SPANS_SQL}, spans {_SPANS_SQL}")


def mask_text(text: str, spans: list[Span]) -> str:
    """Each run of overlapping spans becomes the kind of its first, in brackets."""
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, a, b = spans[k]
        while k + 1 < len(spans) and spans[k + 1][1] < b:
            k += 1
            b = max(b, spans[k][2])
        out += [text[at:a], f"[{kind.upper()}]"]
        at, k = b, k + 1
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """The documents with their personal data masked; ``n_chars``, where present, follows the text."""
    sent, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def work():
        def do(rows: pa.RecordBatch) -> pa.RecordBatch:
            texts = rows.column("text").to_pylist()
            new = {i: mask_text(texts[i], f[1]) for i, f in enumerate(all_spans([t or "" for t in texts], sent.value)) if f[1]}
            if not new:
                return rows
            columns = {n: rows.column(n) for n in names}
            columns["text"] = pa.array([new.get(i, t) for i, t in enumerate(texts)], pa.string())
            if "n_chars" in names:
                counts = rows.column("n_chars")
                columns["n_chars"] = pa.array([len(new[i]) if i in new else n for i, n in enumerate(counts.to_pylist())], counts.type)
            return pa.RecordBatch.from_arrays(list(columns.values()), names)

        return do

    return map_texts(docs, work, docs.schema)
