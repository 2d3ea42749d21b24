"""Toxicity as an ordered severity, by cumulative-link regression on sparse text features.

P(grade > k) = 1 / (1 + exp(threshold_k - score)) with one score, a weighted sum of the text's features, for all
thresholds, which rise. The expected severity of a text is the sum of these probabilities.

Features are words and word beginnings of four bytes, as 32-bit numbers, valued log(1 + times). The labels only say
toxic or not, so the grades of the training rows are made: 0 is not toxic, and toxic rows are cut in three at the
terciles of how many of their words and beginnings go with toxic rows.

The fit takes at most ``TRAIN`` labelled documents of each class, those with the least hash of their id. That bounded
sample is all that reaches the driver; every document is scored where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravia.llm.words import U, Words, mix, text_chunks

#: Labelled rows of each class that are fitted, grades, beginning in bytes, evidence (z) that a feature needs.
TRAIN, GRADES, BEGIN, EVIDENCE = 5000, 4, 4, 5.0
ROUNDS, RATE, DECAY = 400, 0.05, 1e-3


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning."""
    owner = words.owner()
    data = np.frombuffer(words.data, np.uint8)
    begin = np.zeros(len(owner), np.uint64)
    for j in range(BEGIN):
        at = words.start + j
        inside = at < words.end
        begin = begin * U(257) + np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.uint64) + U(1), U(0))
    both = np.concatenate((words.hash, mix(begin + U(0x5851F42D4C957F2D))))
    return np.concatenate((owner, owner)), (both >> U(32)).astype(np.int64)


def _valued(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, feature) with value log(1 + times)."""
    pair, times = np.unique((owner.astype(np.int64) << 32) | feature, return_counts=True)
    return pair >> 32, pair & 0xFFFFFFFF, np.log1p(times)


@dataclass
class Model:
    feature: np.ndarray
    weight: np.ndarray
    threshold: np.ndarray

    def severity(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Expected severity and P(grade > 0) of each text."""
        owner, feature = features(Words(texts))
        at = np.searchsorted(self.feature, feature)
        at[at == len(self.feature)] = 0
        known = self.feature[at] == feature if len(self.feature) else np.zeros(len(feature), bool)
        text, place, value = _valued(owner[known], at[known])
        score = np.bincount(text, self.weight[place] * value, len(texts))
        above = 1 / (1 + np.exp(np.clip(self.threshold[:, None] - score, -500, 500)))
        return above.sum(0), above[0]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """From (toxic, features, times) of labelled rows. Without rows of both classes every severity is near 0."""
    toxic = np.array([r[0] for r in rows], bool)
    never = Model(np.empty(0, np.int64), np.empty(0), np.arange(GRADES - 1) + 10.0)
    if not toxic.any() or toxic.all():
        return never
    sizes = np.array([len(r[1]) for r in rows])
    text = np.repeat(np.arange(len(rows)), sizes)
    names, place = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    times = np.concatenate([r[2] for r in rows]).astype(np.float64)
    # Features whose share of toxic rows is far from that of all rows.
    with_it = np.bincount(place, minlength=len(names))
    bad = np.bincount(place, toxic[text], len(names))
    share = toxic.mean()
    z = (bad - with_it * share) / np.sqrt(with_it * share * (1 - share))
    keep = np.abs(z) >= EVIDENCE
    if not keep.any():
        return never
    index = np.cumsum(keep) - 1
    on = keep[place]
    text, feature, value = text[on], index[place[on]], np.log1p(times[on])
    marks = np.bincount(text, times[on] * (z[keep][feature] > 0), len(rows))
    cuts = np.quantile(marks[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(toxic, 1 + np.searchsorted(cuts, marks, side="left"), 0)

    # Full-gradient Adam; the thresholds are a first one and the logarithms of the steps between them.
    weight, base = np.zeros(int(keep.sum())), np.concatenate(([np.log((1 - share) / share)], np.zeros(GRADES - 2)))
    state = [np.zeros(len(weight) + len(base)) for _ in range(2)]
    row_weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    for turn in range(1, ROUNDS + 1):
        threshold = np.concatenate((base[:1], base[0] + np.cumsum(np.exp(base[1:]))))
        score = np.bincount(text, weight[feature] * value, len(rows))
        below = 1 / (1 + np.exp(-np.clip(np.concatenate(([-50.0], threshold, [50.0]))[:, None] - score, -40, 40)))
        r = np.arange(len(rows))
        upper, lower = below[grade + 1, r], below[grade, r]
        p = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / p * row_weight, lower * (1 - lower) / p * row_weight
        g_threshold = np.array([low[grade == k + 1].sum() - up[grade == k].sum() for k in range(GRADES - 1)])
        g_weight = np.bincount(feature, (up - low)[text] * value, len(weight)) + DECAY * weight / len(weight)
        g_base = np.concatenate(([g_threshold.sum()], [g_threshold[k:].sum() * np.exp(base[k]) for k in range(1, GRADES - 1)]))
        g = np.concatenate((g_weight, g_base))
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        step = RATE * (state[0] / (1 - 0.9**turn)) / (np.sqrt(state[1] / (1 - 0.999**turn)) + 1e-10)
        weight, base = weight - step[: len(weight)], base - step[len(weight) :]
    threshold = np.concatenate((base[:1], base[0] + np.cumsum(np.exp(base[1:]))))
    return Model(names[keep], weight, threshold)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN) -> Model:
    """Fit on at most ``rows`` labelled documents of each class. Null ids and labels, and ids whose labels disagree, are left out."""
    said = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_toxic")).dropna()
    said = said.groupBy("_id").agg(F.min("_toxic").alias("_toxic"), F.max("_toxic").alias("_most")).filter("_toxic = _most")
    order = [F.xxhash64("_id"), "_id"]
    picked = said.filter("_toxic = 1").orderBy(*order).limit(rows).unionByName(said.filter("_toxic = 0").orderBy(*order).limit(rows))
    # At most 2 * rows ids, so they go to every task.
    sample = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked.select("_id", "_toxic")), "_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                t, f, times = _valued(*features(Words(texts)))
                times = np.rint(np.expm1(times)).astype(np.int64)
                cuts = np.searchsorted(t, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(f)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(times)),
                    ],
                    ["toxic", "feature", "times"],
                )

    got = sample.select("_toxic", "_text").mapInArrow(work, "toxic int, feature array<long>, times array<long>").toArrow()
    found = [
        (t, f.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False))
        for t, f, n in zip(got.column(0).to_pylist(), got.column(1), got.column(2), strict=True)
    ]
    return fit(found)


def severity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``severity`` (expected grade, 0 to 3), ``grade`` (nearest) and ``toxic``.

    ``toxic`` says that a grade above 0 is more likely than not. Null and empty texts have the score 0 of no features.
    Equal rows each get their own row.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                value, any_grade = held.value.severity(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(value), pa.array(np.rint(value).astype(np.int32)), pa.array(any_grade > 0.5)],
                    [doc_id, "severity", "grade", "toxic"],
                )

    return docs.select(doc_id, text).mapInArrow(work, f"{doc_id} {kind}, severity double, grade int, toxic boolean")
