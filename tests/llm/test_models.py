"""Language, toxicity and language-model scores: brute force and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravia.llm import language, lm_score, toxicity
from terravia.llm.words import Words

SF = "/root/testdata/sf0.01"


def test_language_of_rows_with_a_wrong_or_no_declaration(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", F.col("source").alias("host"))
    asked = docs.withColumn("true", F.col("lang")).withColumn(
        "lang", F.when(F.col("doc_id") % 10 == 0, "fr").when(F.col("doc_id") % 10 == 1, "xx").when(F.col("doc_id") % 10 > 2, F.col("lang"))
    )
    got = language.identify(asked).collect()
    assert len(got) == asked.count()
    held = [r for r in got if r["doc_id"] % 10 <= 2 and r["n_trigrams"] > 30]
    assert np.mean([r["language"] == r["true"] for r in held]) > 0.97
    assert np.mean([r["accepted"] for r in got]) > 0.99


def test_host_and_suffix_decide_where_the_text_does_not(spark):
    base = {"de": "der die das und nicht ist ein von zu mit", "fr": "le la les des que pas est une dans pour"}
    chance = random.Random(1)
    rows = []
    for lang, words in base.items():
        for i in range(40):
            text = " ".join(chance.choices(words.split(), k=30))
            rows.append((text, lang, f"h{i % 4}.site.{lang}"))
    rows += [("", None, "h1.site.de"), (None, None, "new.site.fr"), (None, None, "other.fr"), (None, None, None), ("le la les", "de", "h0.site.fr")]
    df = spark.createDataFrame(rows, "text string, lang string, host string").withColumn("posterior", F.lit(1))
    got = {(r["host"], r["lang"], r["n_trigrams"]): r for r in language.identify(df, languages=("de", "fr")).collect()}
    assert got["h1.site.de", None, 0]["language"] == "de" and not got["h1.site.de", None, 0]["accepted"]
    assert got["new.site.fr", None, 0]["language"] == "fr"
    assert got["other.fr", None, 0]["language"] == "fr"
    assert got[None, None, 0]["posterior"] < 0.9
    assert got["h0.site.fr", "de", 7]["language"] == "fr"
    assert language.identify(df.limit(0), languages=("de", "fr")).count() == 0
    one = language.identify(df, languages=("de",)).collect()
    assert {r["language"] for r in one} == {"de"}


def test_pages_give_text_and_declaration(spark):
    html = '<!DOCTYPE html><HTML class="x" lang="FR-ca"><style>p{}</style><!-- the --><p>le <b>chat</b><script>var a="</p>"</script>'
    df = spark.createDataFrame([(html,), (None,), ("no tags",)], "html string")
    rows = df.select(language.page_text(F.col("html")).alias("t"), language.page_declares(F.col("html")).alias("d")).collect()
    assert rows[0]["t"].split() == ["le", "chat"] and rows[0]["d"] == "fr"
    assert rows[1]["t"] is None and rows[1]["d"] is None and rows[2]["t"] == "no tags" and rows[2]["d"] is None


def test_rejected_documents_go(spark):
    rows = [(1, "the cat and the dog " * 9, "en", "a"), (1, "the cat and the dog " * 9, "en", "a"), (2, "", "en", "a"), (3, None, None, None), (None, "the dog", "en", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("accepted", F.lit("old"))
    kept = language.accepted_documents(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 1]
    assert language.accepted_documents(df.limit(0)).count() == 0


def test_toxic_documents_that_were_not_fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted = labels.filter("doc_id % 3 != 0")
    model = toxicity.train(docs, fitted)
    said = toxicity.severity(docs, model).withColumnRenamed("toxic", "said")
    rows = said.join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert np.mean([r["said"] for r in toxic]) > 0.9
    assert np.mean([r["said"] for r in clean]) < 0.02
    assert np.mean([r["severity"] for r in toxic]) > 3 * np.mean([r["severity"] for r in clean])
    assert (np.diff(model.threshold) > 0).all()


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "bad awful " + "word " * (i % 7) if i % 2 else "fine word " * (1 + i % 5)) for i in range(80)]
    rows += [(100, None), (101, ""), (None, "bad awful"), (1, "bad awful"), (102, "x " * 200_000 + "bad awful")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, severity int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(2, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.severity(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == len(rows)
    said = {r["doc_id"]: r["toxic"] for r in got}
    assert said[None] and said[102] and not said[100] and not said[101] and said[3] and not said[4]
    none = toxicity.train(docs, labels.limit(0))
    assert not any(r["toxic"] for r in toxicity.severity(docs, none).collect())
    assert toxicity.severity(docs.limit(0), none).count() == 0


def plain_lm(docs, targets, size, classes):
    """Means by document from plain counts of every bigram; ``docs`` may repeat a document."""
    def split(t):
        return Words([t]).hash.tolist()

    every = Counter(w for _, t in docs for w in split(t))
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    vocabulary = set(sorted(every, key=lambda w: (-every[w], signed(w)))[:size])
    name = lambda w: (w, True) if w in vocabulary else ((w >> 20) % classes, False)
    out = {}
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    for d, t in docs:
        own = [name(w) for w in split(t)]
        for m in (0, 1) if d in targets else (1,):
            uni[m].update(own)
            bi[m].update(zip([(0, False), *own], own))
    for d, t in docs:
        own = [name(w) for w in split(t)]
        loss = [0.0, 0.0]
        for v, w in zip([(0, False), *own], own):
            for m in (0, 1):
                p = (uni[m][w] + 1) / (sum(uni[m].values()) + len(vocabulary) + classes)
                loss[m] -= math.log2((bi[m][v, w] + lm_score.MASS * p) / (uni[m][v] + lm_score.MASS))
        out[d, t] = (len(own), loss[0] / len(own) if own else None, loss[1] / len(own) if own else None)
    return out


@pytest.mark.parametrize("size, classes, rare, bucket", [(1000, 1, 0.0, 1 << 22), (8, 1, 0.01, 100), (8, 5, 2.0, 50), (0, 64, 2.0, 300), (20, 1 << 18, 0.003, 1)])
def test_scores_against_plain_models(spark, monkeypatch, size, classes, rare, bucket):
    monkeypatch.setattr(lm_score, "HELD", 100)
    chance = random.Random(size)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(chance.choices(words, range(1, 31), k=chance.randrange(0, 50)))) for i in range(50)]
    docs += [(50, None), (51, ""), (52, "w1 w2 " * 400), (7, "w1 w9"), (None, "w3 w4 w5"), (None, None)] + docs[:4] * 2
    df = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, score int").repartition(4)
    wanted = set(range(0, 50, 3)) | {52}
    targets = spark.createDataFrame([(i,) for i in wanted] + [(None,), (3,), (999,)], "doc_id long")
    for few in (lm_score.FEW_TARGETS, 0):
        monkeypatch.setattr(lm_score, "FEW_TARGETS", few)
        trained = lm_score.train(df, targets, vocabulary=size, classes=classes, rare=rare, bucket=bucket)
        got = lm_score.score(df.withColumn("key", F.lit(1)), trained).collect()
        expected = plain_lm(docs, wanted, size, classes)
        assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in docs)
        means = sorted((r["doc_id"] or -1, r["n_tokens"], r["target_bits"] or 0, r["background_bits"] or 0, r["score"] or 0) for r in got)
        plain = sorted((d or -1, n, t or 0, b or 0, (t or 0) - (b or 0)) for (d, _), (n, t, b) in ((r, expected[r]) for r in docs))
        assert np.allclose(np.array(means), np.array(plain), rtol=1e-9, atol=1e-9)
        assert all((r["score"] is None) == (r["n_tokens"] == 0) for r in got)
    none = lm_score.train(df.limit(0), targets)
    assert lm_score.score(df.limit(0), none).count() == 0
    assert lm_score.score(df, none).count() == len(docs)


@pytest.mark.parametrize("others", [100, 3000])
def test_a_bigram_of_the_target_counts_however_large_the_corpus(spark, others):
    """Ten wanted texts share a pair of words; the pair is in the models at every size."""
    chance = random.Random(others)
    words = [f"x{i}" for i in range(200)]
    docs = [(i, "rare pair " + " ".join(chance.choices(words, k=8))) for i in range(10)]
    docs += [(10 + i, " ".join(chance.choices(words, k=60))) for i in range(others)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    trained = lm_score.train(df, df.filter("doc_id < 10"))
    asked = spark.createDataFrame([(1, "rare pair"), (2, "pair rare")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score(asked, trained).collect()}
    assert got[1]["target_bits"] < got[2]["target_bits"] - 1
    held = [np.cumsum(lm_score._unpack(r["items"], np.int64)) for r in trained.bigrams.collect()]
    assert sum(len(x) for x in held) == len({b for _, t in docs for b in zip([None, *t.split()], t.split())})


def test_wanted_text_scores_lower(spark):
    chance = random.Random(9)
    kind = {0: "alpha beta gamma delta".split(), 1: "one two three four".split()}
    docs = [(i, " ".join(chance.choices(kind[i % 2], k=60))) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = lm_score.train(df, df.filter("doc_id % 2 = 0 and doc_id < 100"))
    rows = {r["doc_id"]: r["score"] for r in lm_score.score(df, model).collect()}
    assert max(rows[i] for i in range(100, 200, 2)) < min(rows[i] for i in range(101, 200, 2))
