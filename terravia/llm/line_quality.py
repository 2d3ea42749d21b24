"""Quality of documents from their lines, by a linear-chain conditional random field.

Each line of a document is good or bad. Its evidence is how it looks (length, words, repeats, capitals, symbols, digits,
ending, whether it occurred before) and how the lines before and after it look; neighbours also prefer certain labels by
a transition weight. Forward-backward gives each line's probability of being good, and the mean of these, weighted by
line length, the document's. A logistic curve makes that a probability of the label.

Only documents are labelled, so the line labels of the fit are made: all lines of a good document are good; of a bad one
those that a model of single lines, and then the field itself, finds good are good, but at least one line is bad.

The sums along a document are products of 2 x 2 matrices, done for all lines of a batch at once by doubling.

The fit takes at most ``TRAIN`` labelled documents of each class, those with the least hash of their id, of at most
``TRAIN_BYTES`` each; only ten small numbers a line of them reach the driver. Every document is scored whole where it
lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravia.llm.rows import without
from terravia.llm.words import U, Words, mix, text_chunks

#: Labelled documents of each class that are fitted, and their greatest size.
TRAIN, TRAIN_BYTES = 3000, 1 << 16
ROUNDS, RATE, DECAY = 150, 0.1, 1e-3
#: The least and most that a document's mean counts in the curve.
EDGE = 0.01

SPACE, UPPER, LOWER, DIGIT, END, PLAIN, SYMBOL, INNER = range(8)


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 0x80:
        return INNER if b < 0xC0 else LOWER
    if c == " " or 9 <= b <= 13:
        return SPACE
    if c.isalpha():
        return UPPER if c.isupper() else LOWER
    return DIGIT if c.isdigit() else END if c in ".!?" else PLAIN if c in ",;:'\"()-" else SYMBOL


KINDS = np.array([_kind(b) for b in range(256)], np.uint8)
#: Upper ends of the bins of each measure of a line; the last four are whole numbers as they are.
BINS = {
    "characters": 2.0 ** np.arange(1, 12),
    "words": 2.0 ** np.arange(0, 9),
    "word length": np.array([1e-9, 2, 3, 4, 5, 6, 8, 10, 14]),
    "distinct words": np.array([1e-9, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95]),
    "repeated neighbours": np.array([1e-9, 0.05, 0.2, 0.5]),
    "capitals": np.array([1e-9, 0.05, 0.15, 0.4, 0.8]),
    "symbols a word": np.array([1e-9, 0.02, 0.1, 0.3, 0.6]),
    "digits": np.array([1e-9, 0.05, 0.2, 0.5]),
    "ending": np.arange(0.5, 7),
    "seen before": np.array([0.5]),
}
OFFSET = np.concatenate(([0], np.cumsum([len(b) + 1 for b in BINS.values()])))
SHAPES = int(OFFSET[-1])


def lines(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, length in characters, bins) of every line that is not blank; bins has a column per measure."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    words = Words(texts)
    kind = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    stop = np.flatnonzero(kind == 10)
    kind = KINDS[kind]
    start = np.concatenate(([0], stop[:-1] + 1))
    text = np.searchsorted(words.base, start, side="right") - 1
    n = [np.add.reduceat((kind == k).view(np.uint8), start, dtype=np.int64) for k in range(8)]
    characters = stop + 1 - start - n[INNER] - 1
    solid = np.flatnonzero(kind != SPACE)
    last = np.searchsorted(solid, stop) - 1
    ending = kind[solid[np.maximum(last, 0)]] if len(solid) else np.zeros(len(start), np.uint8)

    line = np.searchsorted(start, words.start, side="right") - 1
    n_words = np.bincount(line, minlength=len(start))
    one_word = np.maximum(n_words, 1)
    size = np.bincount(line, words.end - words.start, len(start)) / one_word
    by_line = np.sort(mix(words.hash + mix(line.astype(np.uint64))) & U(0xFFFFFFFF) | line.astype(np.uint64) << U(32))
    new = np.concatenate((by_line[:1] == by_line[:1], by_line[1:] != by_line[:-1]))
    distinct = np.bincount((by_line[new] >> U(32)).astype(np.int64), minlength=len(start)) / one_word
    same = (words.hash[1:] == words.hash[:-1]) & (line[1:] == line[:-1])
    again = np.bincount(line[1:][same], minlength=len(start)) / one_word

    # A line's words in their order as one number; lines without words are never the same line.
    first = np.searchsorted(line, np.arange(len(start)))
    with_words = n_words > 0
    whole = np.zeros(len(start), np.uint64)
    if len(line):
        spot = (np.arange(len(line)) - first[line]).astype(np.uint64)
        whole[with_words] = np.add.reduceat(mix(words.hash ^ mix(spot + U(1))), first[with_words])
    names = mix(whole + mix(text.astype(np.uint64)))
    seen = np.ones(len(start), bool)
    seen[np.unique(names, return_index=True)[1]] = False
    seen &= with_words

    letters = np.maximum(n[UPPER] + n[LOWER], 1)
    visible = np.maximum(n[UPPER] + n[LOWER] + n[DIGIT] + n[END] + n[PLAIN] + n[SYMBOL], 1)
    measures = (
        characters, n_words, size, distinct, again, n[UPPER] / letters, n[SYMBOL] / one_word, n[DIGIT] / visible, ending, seen,
    )
    bins = np.stack([np.searchsorted(b, m, side="right") for b, m in zip(BINS.values(), measures, strict=True)], 1)
    kept = n[SPACE] < stop + 1 - start
    return text[kept], characters[kept], bins[kept].astype(np.uint8)


def _products(m: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Products of each row's 2 x 2 matrix with all those before it in its document, up to a factor.

    ``number`` counts the rows of a document from 0. Each turn doubles the rows that a product covers.
    """
    m, d = m.copy(), 1
    while len(number) and d <= number.max():
        at = np.flatnonzero(number >= d)
        got = np.einsum("nij,njk->nik", m[at - d], m[at])
        m[at] = got / got.max((1, 2), keepdims=True)
        d *= 2
    return m


@dataclass
class Field:
    """Weights for a good line of its own, the line before and the line after; of a label change; of no neighbour."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    edge: np.ndarray
    step: np.ndarray

    @staticmethod
    def empty() -> Field:
        return Field(np.zeros(SHAPES), np.zeros(SHAPES), np.zeros(SHAPES), np.zeros(2), np.zeros((2, 2)))

    def parts(self) -> list[np.ndarray]:
        return [self.own, self.before, self.after, self.edge, self.step]

    def evidence(self, bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log odds of good of each line, without the transitions."""
        at = bins + OFFSET[:-1]
        before, after = self.before[at].sum(1), self.after[at].sum(1)
        total = self.own[at].sum(1)
        total[1:] += np.where(first[1:], self.edge[0], before[:-1])
        total[:-1] += np.where(last[:-1], self.edge[1], after[1:])
        if len(total):
            total[0] += self.edge[0]
            total[-1] += self.edge[1]
        return total

    def marginals(self, text: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label) of each line, and of each pair of a line and the one before it (zero for first lines)."""
        n = len(text)
        first = np.ones(n, bool)
        first[1:] = text[1:] != text[:-1]
        last = np.roll(first, -1)
        good = np.clip(self.evidence(bins, first, last), -50, 50)
        node = np.stack((np.exp(np.minimum(-good, 0)), np.exp(np.minimum(good, 0))), 1)
        m = np.exp(self.step)[None] * node[:, None, :]
        m[first] = node[first][:, None, :]
        where = np.arange(n)
        number = where - np.maximum.accumulate(np.where(first, where, 0))
        alpha = _products(m, number)[:, 0, :]
        # The same from the end: a line's matrix is then that of the line after it, and factors stand the other way.
        later = np.ones((n, 2, 2))
        later[:-1] = m[1:]
        later[last] = np.eye(2)
        to_end = where - np.maximum.accumulate(np.where(last[::-1], where, 0))
        beta = _products(later[::-1].transpose(0, 2, 1), to_end)[::-1].transpose(0, 2, 1).sum(2)
        one = alpha * beta
        one /= one.sum(1, keepdims=True)
        two = np.zeros((n, 2, 2))
        inner = np.flatnonzero(~first)
        two[inner] = alpha[inner - 1][:, :, None] * m[inner] * beta[inner][:, None, :]
        two[inner] /= two[inner].sum((1, 2), keepdims=True)
        return one, two


def _fit_field(text: np.ndarray, bins: np.ndarray, good: np.ndarray, weight: np.ndarray, alone: bool) -> Field:
    """Greatest likelihood of the line labels with a small penalty; ``alone`` leaves out neighbours and transitions."""
    n = len(text)
    first = np.ones(n, bool)
    first[1:] = text[1:] != text[:-1]
    last = np.roll(first, -1)
    at = bins + OFFSET[:-1]
    pairs = np.zeros((n, 2, 2))
    inner = np.flatnonzero(~first)
    pairs[inner, good[inner - 1].astype(int), good[inner].astype(int)] = 1
    field = Field.empty()
    moment = [[np.zeros_like(p) for p in field.parts()] for _ in range(2)]
    total = weight.sum()
    for turn in range(1, ROUNDS + 1):
        one, two = field.marginals(text, bins)
        miss = (good - one[:, 1]) * weight / total
        from_before, from_after = np.append(miss[1:], 0), np.append(0, miss[:-1])
        gradient = [
            np.bincount(at.ravel(), np.repeat(miss, at.shape[1]), SHAPES),
            np.bincount(at.ravel(), np.repeat(np.where(last, 0, from_before), at.shape[1]), SHAPES),
            np.bincount(at.ravel(), np.repeat(np.where(first, 0, from_after), at.shape[1]), SHAPES),
            np.array([miss[first].sum(), miss[last].sum()]),
            ((pairs - two) * weight[:, None, None]).sum(0) / total,
        ]
        for k, (p, g) in enumerate(zip(field.parts(), gradient, strict=True)):
            if alone and k:
                continue
            g = g - DECAY * p
            moment[0][k] = 0.9 * moment[0][k] + 0.1 * g
            moment[1][k] = 0.99 * moment[1][k] + 0.01 * g * g
            p += RATE * (moment[0][k] / (1 - 0.9**turn)) / (np.sqrt(moment[1][k] / (1 - 0.99**turn)) + 1e-9)
    return field


def _means(n: int, text: np.ndarray, length: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Mean of ``good`` of each of ``n`` texts, weighted by length; 0 for a text without lines."""
    return np.bincount(text, length * good, n) / np.maximum(np.bincount(text, length, n), 1)


@dataclass
class Model:
    field: Field | None
    intercept: float
    slope: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability that each text is good."""
        mean = np.zeros(len(texts))
        if self.field is not None:
            text, length, bins = lines(texts)
            if len(text):
                mean = _means(len(texts), text, length, self.field.marginals(text, bins)[0][:, 1])
        return _curve(self.intercept, self.slope, mean)


def _odds(mean: np.ndarray) -> np.ndarray:
    return np.log((mean + EDGE) / (1 - mean + EDGE))


def _curve(intercept: float, slope: float, mean: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(intercept + slope * _odds(mean), -50, 50)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], shares: tuple[float, float] = (0.5, 0.5)) -> Model:
    """From (quality, line lengths, line bins) of labelled documents; ``shares`` are those of the labels 0 and 1.

    Without documents of both classes the score of every text is the share of label 1.
    """
    quality = np.array([r[0] for r in rows], np.int64)
    if len(set(quality.tolist())) < 2 or not sum(len(r[1]) for r in rows):
        share = np.clip(shares[1] / max(sum(shares), 1e-9), 1e-9, 1 - 1e-9)
        return Model(None, float(np.log(share / (1 - share))), 0.0)
    text = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    length, bins = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    of_bad = quality[text] == 0
    # Both classes weigh the same, and so do the documents of a class.
    per = np.bincount(quality, minlength=2)
    weight = 1.0 / (per[quality] * np.maximum(np.bincount(text, minlength=len(rows)), 1))[text]

    def labels(p_good: np.ndarray) -> np.ndarray:
        good = ~of_bad | (p_good > 0.5)
        least = np.lexsort((np.arange(len(text)), p_good, text))
        least = least[np.concatenate(([True], text[least][1:] != text[least][:-1]))]
        good[least[of_bad[least]]] = False
        return good

    good = labels(_fit_field(text, bins, ~of_bad, weight, alone=True).marginals(text, bins)[0][:, 1])
    field = _fit_field(text, bins, good, weight, alone=False)
    field = _fit_field(text, bins, labels(field.marginals(text, bins)[0][:, 1]), weight, alone=False)

    # Newton steps for the curve, with the classes as common as the labels say.
    mean = _means(len(rows), text, length, field.marginals(text, bins)[0][:, 1])
    x = np.stack((np.ones(len(rows)), _odds(mean)), 1)
    w = np.asarray(shares)[quality] / per[quality]
    w = w / w.sum() * len(rows)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (w * (quality - p)) - 1.0 * b
        b = b + np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
    return Model(field, float(b[0]), float(b[1]))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN) -> Model:
    """Fit on at most ``rows`` labelled documents of each class.

    Left out are held-out ids, null ids and labels, ids whose labels disagree, ids of more than one document, and
    documents of more than ``TRAIN_BYTES``.
    """
    said = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).dropna().filter("_label IN (0, 1)")
    said = said.filter(~held_out(F.col("_id")))
    said = said.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).filter("_label = _most")
    shares = dict(said.groupBy("_label").count().collect())
    here = docs.select(F.col(doc_id).alias("_id"), F.octet_length(text).alias("_bytes")).filter("_id IS NOT NULL")
    here = here.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows"), F.max("_bytes").alias("_bytes"))
    usable = said.join(here.filter(f"_rows = 1 AND _bytes <= {TRAIN_BYTES}"), "_id").select("_id", "_label")
    order = [F.xxhash64("_id"), "_id"]
    picked = usable.filter("_label = 1").orderBy(*order).limit(rows).unionByName(usable.filter("_label = 0").orderBy(*order).limit(rows))
    # At most 2 * rows ids, so they go to every task.
    sample = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                of, length, bins = lines(texts)
                cuts = np.searchsorted(of, np.arange(b - a + 1))
                size = bins.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(length)),
                        pa.ListArray.from_arrays(pa.array(cuts * size, pa.int32()), pa.array(bins.ravel().astype(np.int8))),
                    ],
                    ["label", "length", "bins"],
                )

    got = sample.select("_label", "_text").mapInArrow(work, "label int, length array<long>, bins array<byte>").toArrow()
    found = [
        (q, n.values.to_numpy(zero_copy_only=False), b.values.to_numpy(zero_copy_only=False).astype(np.uint8).reshape(-1, len(BINS)))
        for q, n, b in zip(got.column(0).to_pylist(), got.column(1), got.column(2), strict=True)
    ]
    found.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    return fit(found, (shares.get(0, 0), shares.get(1, 0)) if shares else (0.5, 0.5))


def quality(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5).

    Null, empty and blank texts have no line and with it the score of a text whose lines are all bad. A null id is not
    held out. Equal rows each get their own row; no documents give no rows. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                value = held.value.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(value), pa.array((value >= 0.5).astype(np.int32))], [doc_id, "score", "predicted"]
                )

    scored = docs.select(doc_id, text).mapInArrow(work, f"{doc_id} {kind}, score double, predicted int")
    return scored.select(doc_id, held_out(F.col(doc_id)).alias("held_out"), "score", "predicted")


def line_labels(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line that is not blank: ``doc_id``, ``line`` (its number among those, from 0), ``length``, ``p_good``.

    A model without a field gives no line evidence: every ``p_good`` is then 0.5.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = without(docs, "line", "length", "p_good")
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(1)):
                of, length, bins = lines(texts)
                field = held.value.field or Field.empty()
                good = field.marginals(of, bins)[0][:, 1] if len(of) else np.empty(0)
                number = np.arange(len(of)) - np.searchsorted(of, of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(of)), pa.array(number), pa.array(length), pa.array(good)],
                    [doc_id, "line", "length", "p_good"],
                )

    return docs.select(doc_id, text).mapInArrow(work, f"{doc_id} {kind}, line long, length long, p_good double")
