"""Line quality: marginals against all labelings, what is learned from, held-out accuracy, edge cases."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravia.llm import line_quality as lq
from terravia.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def random_field(rng):
    field = lq.Field.empty()
    for p in field.parts():
        p += rng.normal(size=p.shape)
    return field


def plain_marginals(field, bins):
    """Sums over every labeling of one document."""
    n, at = len(bins), bins + lq.OFFSET[:-1]
    good = [
        field.own[at[t]].sum()
        + (field.before[at[t - 1]].sum() if t else field.edge[0])
        + (field.after[at[t + 1]].sum() if t < n - 1 else field.edge[1])
        for t in range(n)
    ]
    one, two, total = np.zeros((n, 2)), np.zeros((n, 2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(g for g, l in zip(good, y) if l) + sum(field.step[a, b] for a, b in zip(y, y[1:])))
        total += w
        for t in range(n):
            one[t, y[t]] += w
            if t:
                two[t, y[t - 1], y[t]] += w
    return one / total, two / total


def test_marginals_equal_sums_over_all_labelings():
    rng = np.random.default_rng(3)
    sizes = [1, 7, 2, 1, 9, 5, 1]
    limits = [len(b) + 1 for b in lq.BINS.values()]
    bins = np.stack([rng.integers(0, k, sum(sizes)) for k in limits], 1).astype(np.uint8)
    text = np.repeat([0, 2, 3, 4, 7, 8, 9], sizes)
    field = random_field(rng)
    field.own *= 0.3
    one, two = field.marginals(text, bins)
    for t in np.unique(text):
        want = plain_marginals(field, bins[text == t])
        assert np.allclose(one[text == t], want[0])
        assert np.allclose(two[text == t], want[1])


def test_long_document_equals_recursion():
    """Tens of thousands of lines of one text: same as the sums line by line."""
    rng = np.random.default_rng(5)
    n = 30_000
    bins = np.stack([rng.integers(0, len(b) + 1, n) for b in lq.BINS.values()], 1).astype(np.uint8)
    field = random_field(rng)
    got = field.marginals(np.zeros(n, np.int64), bins)[0]
    first, last = np.arange(n) == 0, np.arange(n) == n - 1
    node = np.clip(field.evidence(bins, first, last), -50, 50)
    node = np.stack((np.exp(np.minimum(-node, 0)), np.exp(np.minimum(node, 0))), 1)
    alpha, beta, m = np.zeros((n, 2)), np.ones((n, 2)), np.exp(field.step)
    alpha[0] = node[0] / node[0].sum()
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ m) * node[t]
        alpha[t] /= alpha[t].sum()
    for t in range(n - 2, -1, -1):
        beta[t] = m @ (node[t + 1] * beta[t + 1])
        beta[t] /= beta[t].sum()
    want = alpha * beta
    assert np.allclose(got, want / want.sum(1, keepdims=True))


def test_measures_of_lines():
    text, length, bins = lq.lines(["Ab cd cd.\n\n \t\nAb cd cd.\nÉÉ##", None, "", "9"])
    assert text.tolist() == [0, 0, 0, 3]
    assert length.tolist() == [9, 9, 4, 1]
    names = list(lq.BINS)
    assert bins[:, names.index("seen before")].tolist() == [0, 1, 0, 0]
    assert bins[:, names.index("ending")].tolist() == [lq.END, lq.END, lq.SYMBOL, lq.DIGIT]
    assert bins[0, names.index("repeated neighbours")] > 0


def test_gradient_raises_the_likelihood_of_made_labels():
    """On a tiny table the fitted field recovers which lines are bad by their looks and neighbours."""
    rows = []
    rng = np.random.default_rng(1)
    for i in range(120):
        body = [" ".join(f"w{rng.integers(500)}" for _ in range(12)) + "." for _ in range(6)]
        if i % 3 == 0:
            body[2:5] = ["BUY!! NOW!! BUY!! NOW!!"] * 3
        _, length, bins = lq.lines(["\n".join(body)])
        rows.append((int(i % 3 != 0), length, bins))
    model = lq.fit(rows)
    good = model.field.marginals(np.zeros(6, np.int64), rows[0][2])[0][:, 1]
    assert (good > 0.5).tolist() == [True, True, False, False, False, True]
    assert model.score(["BUY!! NOW!!\nBUY!! NOW!!"])[0] < 0.5 < model.score(["w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12."])[0]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    rows = QUERIES["op12_line_quality"](spark, SF).join(tables[1], "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert out and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in out) / len(out) >= 0.97
    for q in (0, 1):
        mine = [r for r in out if r["quality"] == q]
        assert sum(r["predicted"] == q for r in mine) / len(mine) >= 0.9


def test_held_out_labels_and_other_columns_do_not_matter(spark, tables):
    docs, labels = tables
    changed = labels.withColumn("quality", F.when(lq.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit(None)).withColumn("source", F.lit("x")).withColumn("score", F.lit(1)).withColumn("held_out", F.lit(3))
    a = {r["doc_id"]: r for r in lq.quality(docs, lq.train(docs, labels)).collect()}
    b = {r["doc_id"]: r for r in lq.quality(other, lq.train(other, changed)).collect()}
    assert a == b


def test_edge_cases(spark, tables):
    model = lq.train(*tables)
    texts = [None, "", " \n\t\n", "a", "\n" * 5000, "word " * 200_000, "One line of text.\n" * 20_000, "퟿ é ü", "a", "a"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "v") for i, t in enumerate(texts)] + [(9, "a", "v")], "doc_id long, text string, predicted string")
    rows = lq.quality(docs, model).collect()
    assert len(rows) == len(texts) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[0] == by[1] == by[2] == by[4] and by[8] == by[9]
    assert lq.quality(docs.limit(0), model).count() == 0
    lines = lq.line_labels(docs.withColumn("line", F.lit(1)), model)
    assert lines.filter("doc_id = 6").count() == 20_000 and lines.filter("doc_id IN (0, 1, 2, 4)").count() == 0
    empty = lq.train(docs.limit(0), tables[1].limit(0))
    assert {r["score"] for r in lq.quality(docs, empty).collect()} == {0.5}
    one_class = lq.train(tables[0], tables[1].filter("quality = 1"))
    assert {r["predicted"] for r in lq.quality(docs, one_class).collect()} == {1}


def test_repeated_ids_and_disagreeing_labels_are_not_learned(spark, tables):
    docs, labels = tables
    more = docs.unionByName(docs.limit(30).withColumn("text", F.lit("other")))
    noisy = labels.unionByName(labels.limit(30).withColumn("quality", 1 - F.col("quality"))).unionByName(
        spark.createDataFrame([(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    )
    model = lq.train(more, noisy)
    assert lq.quality(more, model).count() == more.count()
