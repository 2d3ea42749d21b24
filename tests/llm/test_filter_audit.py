"""The filter audit against a plain run of every order."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from terravia.llm import filter_audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    """{(part, order, step): figures}, one document and one order at a time."""
    fails = []
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        got = set()
        got |= {"A"} if len(words) < 50 else set()
        got |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        got |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        got |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        got |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs) else set()
        good = any(j == i and q == 1 for j, q, _ in labels if j is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if j is not None)
        fails.append((source or "", got, good, toxic))
    out = {}
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                out[part, order, step] = [
                    len(left), len(gone), sum(letter in f[1] for f in mine) - len(gone), sum(f[1] == {letter} for f in mine),
                    sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
        for letter in "ABCDE":
            places = [(part, o, o.index(letter) + 1) for o in map("".join, permutations("ABCDE"))]
            total = sum(out[p][1] for p in places)
            for p in places:
                out[p].append(total)
    return out


def run(spark, docs, labels, more=()):
    rows = filter_audit.audit(spark.createDataFrame(docs, DOCS).select("*", *more), spark.createDataFrame(labels, LABELS)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows}
    assert len(found) == len(rows)
    return found


def cases():
    rng = random.Random(7)
    words = ["ab", "Cd", "EFG", "h", "ü", "x#y", "Zz", "q|", "łó"] + [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\n\x0b", "ONE", "a\x0bb\x0cc", "word " * 60, "#" * 10]
    for _ in range(60):
        pool = rng.sample(words, rng.choice([3, 20, 200]))
        texts.append(" ".join(rng.choice(pool) for _ in range(rng.choice([10, 49, 50, 51, 120, 3000]))))
    docs = [(i if rng.random() < 0.9 else None, rng.choice(texts), rng.choice([None, "", "a", "b"])) for i in range(200)]
    docs += docs[:20] + [(5, "same id, other text", "a"), (None, texts[9], "a"), (-3, texts[9], "zz")]
    labels = [(rng.choice([None, *range(220)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(150)]
    return docs, labels


def test_equals_plain_run(spark):
    docs, labels = cases()
    assert run(spark, docs, labels) == plain(docs, labels)


def test_columns_with_names_of_the_result(spark):
    docs, labels = cases()
    docs = docs[:40]
    more = [F.lit(9).alias(c) for c in ("part", "mask", "kept", "step", "n", "_text", "_id", "rank")]
    assert run(spark, docs, labels, more) == plain(docs, labels)


@pytest.mark.parametrize("docs, labels", [([], []), ([], [(1, 1, 1)]), ([(1, None, None)], [])])
def test_empty_tables(spark, docs, labels):
    assert run(spark, docs, labels) == plain(docs, labels)


def test_one_very_common_text(spark):
    """Copies over many ids and sources, and one id with many texts."""
    docs = [(i % 400, "x " * 70, f"s{i % 3}") for i in range(900)] + [(7, f"t{i}", "s0") for i in range(900)]
    assert run(spark, docs, [(7, 1, 0), (9, 1, 1)]) == plain(docs, [(7, 1, 0), (9, 1, 1)])


def test_intervals_cover_each_order_once():
    """Every mask but the empty one is removed once in every order, at the first failing step."""
    sums = {}
    for mask, kind, step, rank, change in filter_audit.intervals(4):
        for r in range(rank, 24):
            sums[mask, kind, step, r] = sums.get((mask, kind, step, r), 0) + change
    for r, order in enumerate(permutations(range(4))):
        for mask in range(1, 16):
            steps = [s for s, f in enumerate(order, 1) if mask >> f & 1]
            assert [s for s in range(1, 5) if sums.get((mask, "removed", s, r))] == steps[:1]
            assert [s for s in range(1, 5) if sums.get((mask, "redundant", s, r))] == steps[1:]
