"""Conversation repair against trying every edit sequence and against a plain search row by row."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from terravia.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def fault_rows(rows):
    """Rows of one conversation in order, with fault."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    out, seen = [], set()
    for t, r, x in rows:
        solid = x.rstrip(WHITE)
        fault = "blank" if not solid else "duplicate" if (r, x) in seen else "none" if solid[-1] in ".!?" else "truncated"
        seen.add((r, x))
        out.append((t, r, x, fault))
    return out


def every_sequence(rows):
    """Least (cost, audit) and its lines, by trying all strings of edits with at most three inserts."""
    best = None
    for inserts in range(4):
        for edits in itertools.product("DIKR", repeat=len(rows) + inserts):
            if edits.count("I") != inserts:
                continue
            # Roles of changed and new rows are user or assistant, each is tried.
            free = [i for i, e in enumerate(edits) if e in "IR"]
            for names in itertools.product(("user", "assistant"), repeat=len(free)):
                chosen, at, cost, lines, ok = dict(zip(free, names)), 0, 0, [], True
                for i, e in enumerate(edits):
                    if e == "I":
                        cost += 5
                        lines.append((chosen[i], ""))
                        continue
                    _, role, text, fault = rows[at]
                    at += 1
                    if e == "D":
                        cost += 2
                        continue
                    ok &= fault in ("none", "truncated")
                    cost += (e == "R") + 5 * (fault == "truncated")
                    lines.append((chosen.get(i, role), text))
                if ok and re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in lines)):
                    key = (cost, "".join(edits), lines)
                    best = key if best is None or key < best else best
    return best


def row_by_row(rows):
    """The same from a search over places and states; for conversations of any length."""
    need, to = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
    after = [(0, "", ()) if q in (0, 3) else None for q in range(4)]

    def with_inserts(costs):
        for _ in range(3):
            new = list(costs)
            for q in range(4):
                nxt = costs[to[q]]
                if nxt is not None:
                    got = (nxt[0] + 5, "I" + nxt[1], ((need[q], ""), *nxt[2]))
                    new[q] = got if new[q] is None else min(new[q], got)
            costs = new
        return costs

    after = with_inserts(after)
    for _, role, text, fault in reversed(rows):
        now = []
        for q in range(4):
            options = [(after[q][0] + 2, "D" + after[q][1], after[q][2])]
            if fault in ("none", "truncated"):
                more, nxt = 5 * (fault == "truncated"), after[to[q]]
                options.append((nxt[0] + 1 + more, "R" + nxt[1], ((need[q], text), *nxt[2])))
                if role[:1] == need[q][0]:
                    options.append((nxt[0] + more, "K" + nxt[1], ((role, text), *nxt[2])))
                if q == 0 and role[:1] == "s":
                    options.append((after[1][0] + more, "K" + after[1][1], ((role, text), *after[1][2])))
            now.append(min(options))
        after = with_inserts(now)
    return after[0][0], after[0][1], list(after[0][2])


def plain_report(rows, ids=()):
    """{conv: figures} of rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows} | set(ids):
        mine = fault_rows([r[1:] for r in rows if r[0] == conv])
        turns = {r[0] for r in mine if r[0] is not None}
        cost, audit, lines = row_by_row(mine)
        initials = [r[1][:1] for r in mine]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[sum(r[3] == f for r in mine) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest(),
        )
    return out


def run(spark, rows, ids=None, more=(), parts=3, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).select("*", *more)
    ids = None if ids is None else spark.createDataFrame([(i,) for i in ids], "conv_id long")
    got = cr.report(df, ids, **sizes).collect()
    found = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}
    assert len(found) == len(got)
    return found


ROLES = ["user", "assistant", "system", "tool", "", None, "usr", "u"]
TEXTS = ["Yes.", "no", " \t\n", "", None, "So it is!", "cut of", "Why? \n", "é.", "ends\x0b", "a\nb."]


def cases(n, longest, seed=11):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t // 2, None, t * 3])
            rows.append((conv, turn, rng.choice(ROLES[:3] * 4 + ROLES), rng.choice(TEXTS + [f"w{rng.random()}."] * 12)))
    return rows + rows[: n // 3]


def test_search_equals_every_sequence():
    rng = random.Random(2)
    for _ in range(60):
        rows = fault_rows([(t, rng.choice(ROLES), rng.choice(TEXTS)) for t in range(rng.randint(0, 4))])
        assert row_by_row(rows) == every_sequence(rows)


def test_runs_equal_rows_one_by_one():
    """Powers of a run against the same number of single steps, and unrolled costs against the vector."""
    rng = random.Random(4)
    for _ in range(200):
        symbol, n = rng.choice("xsuaoSUAO"), rng.choice([1, 2, 3, 7, 64, 1000, 5000])
        after = tuple(rng.randint(0, 30) for _ in range(4))
        one = after
        for _ in range(n):
            one = cr._before_run(symbol, 1, one)
        assert cr._before_run(symbol, n, after) == one
        assert cr._apply(cr.piece_matrix(symbol, [n]), after) == one


@pytest.mark.parametrize("sizes", [{}, {"piece_rows": 3, "piece_bytes": 1 << 20}, {"piece_rows": 100, "piece_bytes": 12}, {"piece_rows": 1}])
def test_report_equals_plain(spark, sizes):
    rows = cases(60, 12)
    assert run(spark, rows, ids=[None, 3, 900], **sizes) == plain_report(rows, [None, 3, 900])


def test_long_conversations_over_many_pieces_and_tasks(spark):
    rows = cases(4, 40) + [(77, t, "user" if t % 3 else "assistant", f"t{t}.") for t in range(3000)]
    rows += [(78, None, "user", f"x{t % 700}") for t in range(2500)] + [(79, 1, "user", "same.")] * 6000
    rows += [(80, t, "user", "long " * 30_000 + str(t)) for t in range(6)]
    assert run(spark, rows, parts=5, piece_rows=200, piece_bytes=5000) == plain_report(rows)


def test_repaired_rows_and_audits_of_pieces(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 3, "user", "Who?"), (1, 4, "assistant", " ")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = row_by_row(fault_rows([r[1:] for r in rows]))
    for sizes in ({}, {"piece_rows": 2}):
        done = cr.edited(cr.pieces(df, **sizes))
        assert "".join(r["audit"] for r in done.orderBy("piece").collect()) == want[1]
        assert [(r["role"], r["text"]) for r in cr.repaired_rows(done).orderBy("piece", "place").collect()] == want[2]


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, []) == {}
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, [], ids=[5, 5, None]) == {i: (0, 0, 0, 0, 0, 0, "", empty) for i in (5, None)}
    rows = cases(8, 6)
    more = [F.lit("x").alias(c) for c in ("audit", "piece", "cost", "_conv", "symbols", "last", "conv", "kind", "_n")]
    assert run(spark, rows, more=more) == plain_report(rows)


def test_damage(spark):
    rows = cases(30, 9, seed=5)
    want = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in cr.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
