"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a row's language are multiplied:

* the text: byte trigrams under a model of each language. Neighbouring trigrams are not independent, so n of them count
  as n * E / (n + E) with E = ``EVIDENCE``;
* the declared markup language, by how often each declaration goes with each language over all rows;
* the address suffix and the host: a prior per host that is smoothed towards that of its domain, that one towards its
  suffix's and that one towards all rows'. The levels are grouped aggregations of the languages that text and
  declaration give; a row's own share is taken out of its host before it is judged.

The trigram models are counted over all rows with a declared language of the inventory. What the driver holds is
bounded by the inventory: trigram counts (languages x 2**15), the table of declarations and one row of priors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.llm.rows import KEY, append, with_key
from terravia.llm.url_rules import url_host
from terravia.llm.words import FOLD, SEPARATOR, text_chunks
from terravia.session import cut_lineage

LANGUAGES = ("de", "en", "es", "fr")
#: Bits of a trigram's number, weight of a parent level in rows, evidence of a text in trigrams, least posterior.
BITS, SMOOTH, EVIDENCE, CERTAIN = 15, 10.0, 200.0, 0.5
#: How much worse than evenly spread trigrams a text may fit, per trigram: numbers and codes among words are no reason.
SLACK = 1.0
PIECE = 1 << 18


def _trigrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, number) of the trigrams round every byte of a word, a piece at a time."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer((b" " + b"  ".join(raw) + b" ").translate(FOLD), np.uint8)
    starts = np.cumsum([0] + [len(r) + 2 for r in raw])
    for at in range(0, len(data) - 2, PIECE):
        part = data[at : at + PIECE + 2].astype(np.uint32)
        mid = np.flatnonzero(part[1:-1] != SEPARATOR)
        number = (part[mid] * np.uint32(0x9E3779B1)) ^ (part[mid + 1] * np.uint32(0x85EBCA6B)) ^ (part[mid + 2] * np.uint32(0xC2B2AE35))
        number = ((number ^ (number >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
        yield np.searchsorted(starts, mid + at, side="right") - 1, number.astype(np.int64)


def trigram_models(rows: DataFrame, text: str, declared: str, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Log probabilities [trigram, language] from all rows whose declared language is in the inventory."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) << BITS, np.int64)
        place = {v: i for i, v in enumerate(languages)}
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(0), PIECE):
                language = np.array([place.get(v, -1) for v in batch.column(1).slice(a, b - a).to_pylist()], np.int64)
                for owner, number in _trigrams(texts):
                    known = language[owner] >= 0
                    total += np.bincount((language[owner][known] << BITS) + number[known], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    counted = rows.filter(F.col(declared).isin(*languages)).select(text, declared).mapInArrow(count, "cell long, n long")
    got = counted.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.full(len(languages) << BITS, 0.5)
    table[got["cell"].to_numpy(np.int64)] += got["n"].to_numpy(np.float64)
    table = table.reshape(len(languages), -1)
    return np.log(table / table.sum(1, keepdims=True)).T.astype(np.float32)


def _fused(rows: DataFrame, name: str, parts: list[Column]) -> DataFrame:
    """Add the array ``name``: exp of the sums of log evidence (arrays by language), normalised."""
    total = parts[0]
    for part in parts[1:]:
        total = F.zip_with(total, part, lambda x, y: x + y)
    rows = rows.withColumn("_lsum", total).withColumn("_ltop", F.array_max("_lsum"))
    rows = rows.withColumn("_lexp", F.transform("_lsum", lambda x: F.exp(x - F.col("_ltop"))))
    rows = rows.withColumn("_lall", F.aggregate("_lexp", F.lit(0.0), lambda x, y: x + y))
    return rows.withColumn(name, F.transform("_lexp", lambda x: x / F.col("_lall"))).drop("_lsum", "_ltop", "_lexp", "_lall")


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _labels(host: Column) -> tuple[Column, Column]:
    """Suffix and domain: the last label and the last two; a host of one label has no suffix."""
    parts = F.split(host, r"\.")
    suffix = F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(F.lit(""))
    return suffix, F.substring_index(host, ".", -2)


def identify(
    rows: DataFrame,
    text: str = "text",
    declared: str = "lang",
    host: str = "host",
    languages: tuple[str, ...] = LANGUAGES,
    certain: float = CERTAIN,
) -> DataFrame:
    """The input's other columns with ``language``, ``posterior``, ``accepted`` and ``n_trigrams``.

    Equal posteriors go to the language that comes first in the inventory. Rejected are rows without letters or digits
    (null and empty texts too; their language is what the other evidence says), rows below ``certain``, and texts that
    fit every language much worse than evenly spread trigrams would. A null or unknown declaration is evidence of its own
    kind; a null host has the prior of all rows. Equal rows are judged alike. No rows give no rows. Input columns
    named like a result, or beginning with ``_l``, are not carried over.
    """
    languages = tuple(languages)
    results = ("language", "posterior", "accepted", "n_trigrams", "_declared", "_host", "_suffix", "_domain")
    kept = [c for c in rows.columns if c not in (text, *results) and not c.startswith("_l")]
    spark = rows.sparkSession
    models = spark.sparkContext.broadcast(trigram_models(rows, text, declared, languages))
    n = len(languages)
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = models.value
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(0), PIECE):
                total, size = np.zeros((n, b - a)), np.zeros(b - a, np.int64)
                for owner, number in _trigrams(texts):
                    size += np.bincount(owner, minlength=b - a)
                    logs = model[number]
                    for i in range(n):
                        total[i] += np.bincount(owner, logs[:, i], b - a)
                part = batch.slice(a, b - a)
                logs = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, n), pa.int32()), pa.array(total.T.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(size), logs], schema.names)

    unknown, none = "*", ""
    says = F.when(F.col(declared).isNull(), none).when(F.col(declared).isin(*languages), F.col(declared)).otherwise(unknown)
    shape = rows.select(F.col(text).alias("_text"), *kept, says.alias("_declared"), F.lower(host).alias("_host"))
    schema = append(shape.drop("_text").schema, ("n_trigrams", T.LongType()), ("_l", T.ArrayType(T.DoubleType())))
    scored = cut_lineage(shape.mapInArrow(score, schema), "language-scores")

    def sums(column: str) -> list[Column]:
        return [F.sum(F.col(column)[i]).alias(f"_l{i}") for i in range(n)]

    by_text = F.transform("_l", lambda x: x * (EVIDENCE / (F.col("n_trigrams") + EVIDENCE)))
    # How often each declaration goes with each language, by the texts alone.
    kinds = [*languages, unknown, none]
    table = np.ones((len(kinds), n))
    alone = _fused(scored.filter("n_trigrams > 0"), "_lq", [by_text])
    for r in alone.groupBy("_declared").agg(*sums("_lq")).collect():
        table[kinds.index(r["_declared"])] += [r[f"_l{i}"] for i in range(n)]
    share = np.log(table / table.sum(0))
    overall = table.sum(0) / table.sum()
    said = F.element_at(F.create_map(*(x for k, row in zip(kinds, share) for x in (F.lit(k), _array(row)))), F.col("_declared"))
    judged = _fused(scored, "_lq", [by_text, said, _array(np.log(overall))])

    # Sums of languages per host, domain and suffix; a hot host is one row after the partial sums.
    suffix, domain = _labels(F.col("_host"))
    counts = F.array(*[f"_l{i}" for i in range(n)])
    hosts = judged.filter(F.col("_host").isNotNull()).groupBy("_host").agg(*sums("_lq"))
    hosts = cut_lineage(hosts.select("_host", counts.alias("_lc"), suffix.alias("_suffix"), domain.alias("_domain")), "hosts")

    def smoothed(own: Column, parent: Column) -> Column:
        size = F.aggregate(own, F.lit(0.0), lambda x, y: x + y)
        return F.zip_with(own, parent, lambda c, p: (c + SMOOTH * p) / (size + SMOOTH))

    suffixes = hosts.groupBy("_suffix").agg(*sums("_lc"))
    suffixes = suffixes.select("_suffix", smoothed(counts, _array(overall)).alias("_ls"))
    domains = hosts.groupBy("_domain", "_suffix").agg(*sums("_lc")).join(suffixes, "_suffix")
    domains = domains.select("_domain", smoothed(counts, F.col("_ls")).alias("_ld"))
    priors = cut_lineage(hosts.join(domains, "_domain").select("_host", "_lc", "_ld"), "host-priors")

    joined = judged.join(priors, "_host", "left")
    rest = F.zip_with("_lc", "_lq", lambda c, q: F.greatest(c - q, F.lit(0.0)))
    prior = F.coalesce(smoothed(rest, F.col("_ld")), _array(overall))
    fused = _fused(joined, "_lp", [by_text, said, F.transform(prior, lambda p: F.log(p))])
    best = F.array_max("_lp")
    names = F.array(*[F.lit(v) for v in languages])
    fits = F.array_max("_l") > F.col("n_trigrams") * -(math.log(1 << BITS) + SLACK)
    return fused.select(
        *kept,
        F.get(names, (F.array_position("_lp", best) - 1).cast("int")).alias("language"),
        best.alias("posterior"),
        ((F.col("n_trigrams") > 0) & (best >= certain) & fits).alias("accepted"),
        "n_trigrams",
    )


def page_text(html: Column) -> Column:
    """The text of a page: no comments, scripts, styles or tags."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")


def page_declares(html: Column) -> Column:
    """The two-letter language in the html tag, null without one."""
    found = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2})\b""", 1))
    return F.when(found != "", found)


def identify_all(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents (declared: ``lang``, host: ``source``) and pages (html tag, url) judged together."""
    docs = documents.select(
        "doc_id", F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"), "text",
        F.col("lang").alias("declared"), F.col("source").alias("host"),
    )
    host = url_host(F.col("url"))
    web = pages.select(
        F.lit(None).cast(documents.schema["doc_id"].dataType).alias("doc_id"), "page_id", page_text(F.col("html")).alias("text"),
        page_declares(F.col("html")).alias("declared"), F.when(host != "", host).alias("host"),
    )
    return identify(docs.unionByName(web), "text", "declared", "host")


def accepted_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """The documents, with their own columns, that are not rejected."""
    keyed = with_key(docs.select(F.struct("*").alias("_row"), doc_id, text, F.col(declared).alias("_says"), F.col(host).alias("_from")), doc_id, text)
    judged = identify(keyed.select(KEY, text, "_says", "_from"), text, "_says", "_from")
    rejected = cut_lineage(judged.filter(~F.col("accepted")).select(KEY).distinct(), "rejected")
    return keyed.join(rejected, KEY, "left_anti").select("_row.*")
