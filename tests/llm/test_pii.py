from __future__ import annotations

import random
import re

import numpy as np
import pytest

from panelmill.llm import pii as P
from tests.llm.helpers import ODD, documents, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and P.luhn(digits(m))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], P.KINDS.index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for i in range(3000):
        text = "".join(rng.choices("a1.@-+ 4()%0258é_", k=40))
        assert P.base_spans(text) == brute(text), text
    known = "x 4111 1111 1111 1111, +1 (743) 555-3824; a.b@c@d.example.com 001.2.3.255 1.2.3.256 1.2.3.4.5"
    assert P.base_spans(known) == brute(known) and len(brute(known)) == 5
    assert P.base_spans("1." * 3000 + "@" + "9" * 6000)[:1] == brute("1." * 300)[:1]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = P.Tagger(hidden=3)
    ids, tags = rng.integers(0, 130, (3, 7)), rng.integers(0, P.TAGS, (3, 7))
    _, grads = model.gradients(ids, tags)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        sides = []
        for step in (1e-5, -2e-5):
            model.p[name][at] += step
            sides.append(model.gradients(ids, tags)[0])
        model.p[name][at] += 1e-5
        assert g[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-4)


def test_decoding_finds_the_best_of_all_taggings():
    import itertools

    model = P.Tagger(hidden=3, seed=3)
    model.p["move"] *= 10
    ids = np.array([[65, 48, 64]])
    scores = model.emissions(ids)[0][:, 0]

    def score(tags):
        return sum(scores[t][k] for t, k in enumerate(tags)) + sum(model.p["move"][a, b] for a, b in zip(tags, tags[1:]))

    best = max(itertools.product(range(P.TAGS), repeat=3), key=score)
    assert tuple(model.decode(ids)[0].tolist()) == best


def private(seed):
    rng = random.Random(seed)
    phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    mail = f"{prose(seed, 1)}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
    ip = ".".join(str(rng.randint(1, 255)) for _ in range(4))
    head = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
    card = next(head + str(d) for d in range(10) if P.luhn(head + str(d)))
    return [phone, mail, ip, card]


@pytest.fixture(scope="module")
def model():
    texts = [" ".join(f"{prose(7 * i + k, 12)} {x}" for k, x in enumerate(private(i))) + " " + prose(i, 9) for i in range(150)]
    return P.Tagger().fit(*P.training_windows(texts)).compact()


def test_forms_that_the_patterns_miss_are_found(model):
    rng, hit, n = np.random.default_rng(4), 0, 0
    for i in range(1000, 1020):
        for datum in private(i):
            (kind, a, b), *_ = P.base_spans(datum)
            new = P.rewritten(kind, datum[a:b], rng)
            text = f"{prose(i, 20)} {new} {prose(i + 1, 20)}"
            spans = P.all_spans([text], model)[0][1]
            at = text.index(new)
            hit += any(s < at + len(new) and at < e for _, s, e in spans)
            n += 1
    assert hit >= 0.7 * n


def test_base_spans_stay_and_clean_texts_have_none(model):
    for i in range(40):
        text = f"{prose(i, 40)} version 2.0 of 2021 {' '.join(private(i))} {prose(i + 7, 400)}"
        base, every = P.all_spans([text], model)[0]
        assert base == P.base_spans(text) and set(base) <= set(every)
    assert all(not every for _, every in P.all_spans([prose(i, 300) for i in range(20)], model))


def test_windows_without_digit_or_at_add_nothing(model):
    """What is left undecoded could only give spans that are refused."""
    text = prose(3, 400)
    ids = P.char_ids(text)
    windows = [ids[i : i + P.WINDOW] for i in range(0, len(ids) - P.WINDOW, P.STRIDE)]
    for k, tags in enumerate(model.decode(np.array(windows))):
        for kind, a, b in P.tag_runs(tags):
            assert not P.plausible(kind, text[k * P.STRIDE + a : k * P.STRIDE + b])


def test_reconciling_windows():
    whole, cut = (("ip", 10, 20), False), (("ip", 15, 20), True)
    assert P.reconciled([whole, cut]) == [("ip", 10, 20)]
    assert P.reconciled([(("ip", 0, 8), True), (("ip", 8, 12), True)]) == [("ip", 0, 12)]
    assert P.reconciled([(("ip", 0, 4), False), (("card", 2, 20), False)]) == [("card", 2, 20)]


def test_tables_and_masks(spark, model):
    text = "mail a.b@c.example.com or +1 (743) 555-3824 \U0001f600 10.1.2.3 end"
    rows = [*ODD, (20, text), (21, text)]
    docs = documents(spark, rows, extra=True)
    found = {r["doc_id"]: r for r in P.find(docs, model).collect()}
    for doc, t in rows:
        assert [tuple(s) for s in found[doc]["base_spans"]] == brute(t or "")
    masked = P.masked(docs, model)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    left = {r["doc_id"]: r for r in masked.collect()}
    assert left[20]["text"] == "mail [EMAIL] or [PHONE] \U0001f600 [IP] end" and left[20]["n_chars"] == len(left[20]["text"])
    assert left[1]["text"] is None and left[5]["text"] == dict(ODD[:8])[5]


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, None), (2, "no data")])
    assert P.fit(docs) is None and P.find(docs, None).count() == 2
    assert P.fit(documents(spark, [])) is None and P.find(documents(spark, []), None).collect() == []


def test_fit_on_documents(spark):
    docs = documents(spark, [(i, f"{prose(i, 20)} {' '.join(private(i))}") for i in range(12)])
    assert isinstance(P.fit(docs), P.Tagger)


def test_long_runs_of_digits_take_linear_time():
    import time

    start = time.perf_counter()
    assert P.base_spans("7" * 2_000_000 + " 10.0.0.1") == [("ip", 2_000_001, 2_000_009)]
    assert time.perf_counter() - start < 20


def test_addresses_equal_the_plain_pattern():
    import random
    import re

    rng, plain = random.Random(4), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(rng.choices("0125.. x", k=rng.randint(1, 40)))
        wanted = [m.span() for m in plain.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
        assert [(a, b) for kind, a, b in P.base_spans(text) if kind == "ip"] == wanted
