"""URL rules and nearest vectors against plain versions."""

import math
import random

import numpy as np
import pytest

from terravia.llm import nearest_vectors, url_rules

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"), ("Example.com", "", "block"), ("example.com", "/en/a", "allow"),
    ("a.b.org", "/", "block"), ("a.b.org", "/", "allow"), (None, "/", "block"), ("org", None, "block"), ("", "/", "block"),
]
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate(LOW), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = []
    for h, p, verdict in RULES:
        if h and p is not None:
            h = h.translate(LOW)
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((-len(h + p), -len(h), verdict != "block", h + p, verdict))
    best = min(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_url_rules_against_every_rule(spark):
    chance = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "b.www.Example.com", "xexample.com", "net", "a.net", "a.b.org", "b.org",
             ".com", "com.", "a..com", "ünï.net", "example.com:80", ""]
    paths = ["", "/", "/en/", "/en/a", "/en", "/es/x", "/fr/", "/EN/", "//en/"]
    urls = [f"{chance.choice(['http', 'x', ''])}://{chance.choice(hosts)}{chance.choice(paths)}{chance.choice(['', '?q=/en/', '#://com/'])}" for _ in range(400)]
    urls += [None, "", "foo", "://", "a://b://com/", "http://example.com\n/en/", "http://" + "a." * 3000 + "com/" + "y" * 9000]
    rows = [(i // 2, u) for i, u in enumerate(urls)]
    pages = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    expected = sorted(((i, u, *plain_verdict(u)) for i, u in rows), key=repr)
    for size in (200_000, 7):
        got = url_rules.judge(pages, rules, sweep_rows=size)
        assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
    assert url_rules.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_url_rules_run_without_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES[:3], "host string, path string, verdict string")
    plan = url_rules.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def plain_nearest(rows, asked, k):
    def usable(v):
        return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    good = {(i, tuple(v)) for i, v in rows if i is not None and usable(v)}
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in asked if i is not None and usable(v)}):
        x, best = np.array(v, float), {}
        for i, w in good:
            if i != q and len(w) == len(v):
                y = np.array(w, float)
                s = float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())))
                best[i] = max(s, best.get(i, -9))
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k])]
    return out


@pytest.mark.parametrize("block_bytes, seed_rows", [(1 << 20, 4096), (200, 3), (1 << 20, 0)])
def test_nearest_vectors_against_all_pairs(spark, block_bytes, seed_rows):
    chance = np.random.default_rng(4)
    rows = [(i, chance.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [rows[5], rows[5]]
    rows += [(400, None), (401, [0.0] * 8), (402, [None] + [1.0] * 7), (403, [float("nan")] * 8), (404, [float("inf")] * 8)]
    rows += [(None, rows[0][1]), (405, []), (406, [1.0, 2.0]), (450, [2.0, 4.0]), (9, rows[10][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(5)
    asked = df.filter("vec_id % 50 = 0")
    got = nearest_vectors.nearest_vectors(asked, df, block_bytes=block_bytes, seed_rows=seed_rows)
    got = sorted(tuple(r) for r in got.collect())
    expected = plain_nearest(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], 5)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], rtol=0, atol=1e-12)


def test_nearest_vectors_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1e-200, 0.0]), (2, [0.0, 1e200])], "vec_id int, embedding array<double>")
    got = sorted(tuple(r) for r in nearest_vectors.nearest_vectors(df.filter("vec_id = 0"), df).collect())
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2)] and got[0][3] == pytest.approx(1) and got[1][3] == 0
    assert nearest_vectors.nearest_vectors(df.limit(0), df).count() == 0
    assert nearest_vectors.nearest_vectors(df, df.limit(0)).count() == 0


def test_bounds_hold():
    chance = np.random.default_rng(1)
    a = nearest_vectors.Block(np.arange(50), chance.normal(size=(50, 33)))
    b = nearest_vectors.Block(np.arange(60), chance.standard_cauchy(size=(60, 33)))
    true = a.unit @ b.unit.T
    assert (a.upper(b) >= true).all()
    assert (a.upper(b) - true).max() < 0.2
