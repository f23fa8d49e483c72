from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from panelmill.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
TEXTS = ["a.", "b!", "c", " ", "", "d? ", "e.f", "a.", " ", "\t.\n", "long " * 50 + "end."]


def conversations(seed, n, most=9):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randint(1, most)):
            turn = rng.choice([t, t, t, t + 3, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((c, turn, role, rng.choice([*TEXTS, None])))
    return rows


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if way == 1 else re.sub("[.!?]", "", x) if way == 2 else x
        out += [(c, t, "user" if way == 4 else r, x)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def judge(rows):
    """Rows of a conversation in order, with their faults."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, out = set(), []
    for _, t, r, x in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", x)
        fault = "blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((r, x))
        out.append((t, r, x, fault))
    return out


def cheapest(rows):
    """Least (cost, audit) with what is left, by all choices from each (row, last initial)."""

    @functools.cache
    def best(i, last):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        need = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        name = "user" if need == "u" else "assistant"
        if last == "u" or i == len(rows) and last in ("s", "") or i < len(rows):  # no more inserts than may help
            if last != "a" or i < len(rows):
                found += [(5 + c, "I" + a, ((name, ""), *o)) for c, a, o in inserted(i, need, last)]
        if i < len(rows):
            _, r, x, fault = rows[i]
            found += [(2 + c, "D" + a, o) for c, a, o in [best(i + 1, last)]]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if r[:1] == need or r[:1] == "s" and last == "":
                    c, a, o = best(i + 1, r[:1])
                    found.append((c + extra, "K" + a, ((r, x), *o)))
                c, a, o = best(i + 1, need)
                found.append((1 + extra + c, "R" + a, ((name, x), *o)))
        return min(found)

    def inserted(i, need, last):
        # at most two inserts stand side by side
        if last in ("", "s") and need == "u" and i == len(rows):
            return [(5, "I", (("assistant", ""),))]
        out = []
        if i < len(rows):
            out.append(without_insert(i, need))
            if need == "u":
                c, a, o = without_insert(i, "a")
                out.append((5 + c, "I" + a, (("assistant", ""), *o)))
        elif need == "a":
            out.append((0, "", ()))
        return out

    @functools.cache
    def without_insert(i, last):
        need = {"s": "u", "u": "a", "a": "u"}[last]
        name = "user" if need == "u" else "assistant"
        _, r, x, fault = rows[i]
        c, a, o = best(i + 1, last)
        found = [(2 + c, "D" + a, o)]
        if fault not in ("blank", "duplicate"):
            extra = 5 * (fault == "truncated")
            if r[:1] == need:
                c, a, o = best(i + 1, need)
                found.append((c + extra, "K" + a, ((r, x), *o)))
            c, a, o = best(i + 1, need)
            found.append((1 + extra + c, "R" + a, ((name, x), *o)))
        return min(found)

    return best(0, "")


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = judge(damage([r for r in rows if r[0] == conv]))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = [f for *_, f in own]
        initials = [r[:1] for _, r, _, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, left = cheapest(own)
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest()
        out.append((conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def found(spark, rows, extra=False, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "'x' as pos", "'x' as fault", "'x' as edit", "'x' as block", "'x' as _c", "1 as cost")
    return sorted((tuple(r) for r in R.audited(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("size", [64, 3])
def test_equals_brute_force(spark, size):
    rows = conversations(1, 120) + [(None, 0, "user", "x."), (None, 1, "assistant", None), (None, None, None, "y.")]
    rows += [(500, i, "user" if i % 2 else "assistant", f"t{i % 40}.") for i in range(150)]  # a long one, with repeats
    rows += rows[:10]
    assert found(spark, rows, extra=True, size=size) == brute(rows)


def test_dropped_and_empty(spark):
    gone = next(c for c in itertools.count() if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "x.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert found(spark, []) == []


def test_edits_leave_the_pattern_and_carry_the_cost(spark):
    rows = spark.createDataFrame([(c, t or 0, r or "x", x or "") for c, t, r, x in conversations(5, 60)], SCHEMA)
    by_conv: dict = {}
    for r in R.repair(rows).orderBy("conv_id", "pos", "at").collect():
        by_conv.setdefault(r["conv_id"], []).append(r)
    for edits in by_conv.values():
        left = "".join(r["role"][0] for r in edits if r["edit"] != "D")
        assert re.fullmatch("(s?(ua)+)?", left)
        assert all((r["role"] is None) == (r["edit"] == "D") for r in edits)


@pytest.mark.parametrize("seed", range(4))
def test_prices_are_exact_and_leave_no_arc_undercut(seed):
    rng = random.Random(seed)
    for _ in range(150):
        codes = "".join(rng.choices("suaoSUAOD", k=rng.randint(1, 12)))
        whole = R.Lattice(codes, R.END, True)
        cost = whole.auction(0, R.START)
        for i in range(len(codes) + 1):
            for state in range(4):
                for _, c, j, q in whole.arcs(i, state):
                    assert whole.price[i][state] <= c + whole.price[j][q]
        edits, roles, end, total = R.Lattice(codes, R.END, True).trace(R.START)
        assert total == cost and len(edits) == len(codes) and end in (R.START, R.ASSISTANT)
        rows = [(0, {"s": "system", "u": "user", "a": "assistant", "o": "tool", "d": "user"}[c.lower()], "x", "blank" if c == "D" else "truncated" if c.isupper() else None) for c in codes]
        assert (cost, "".join(edits)) == cheapest(rows)[:2]
        cut = rng.randrange(len(codes))
        if cut:  # prices at the cut carry all that the rest costs
            prices = R.entry_prices(codes[cut:], R.END, True)
            first, _, state, _ = R.traced(codes[:cut], prices, False, R.START)
            rest, *_ = R.traced(codes[cut:], R.END, True, state)
            assert first + rest == edits
