"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravia.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    filter_audit,
    language,
    line_quality,
    lm_score,
    near_duplicates,
    nearest_vectors,
    passages,
    toxicity,
    training_order,
    url_rules,
)
from terravia.llm.rows import KEY, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TRAINING_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: host, path, verdict
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and page."""
    return language.identify_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")).drop("declared")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under a model of the documents labelled as good and one of all."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return lm_score.score(docs, lm_score.train(docs, good))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS t(host, path, verdict)")
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = """
WITH p AS (
  SELECT page_id, row_number() OVER () AS u,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(h, p, verdict) AS (VALUES """ + ", ".join(map(str, URL_RULES)) + """)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM (
  SELECT p.*, r.h || r.p AS rule, r.verdict AS v,
         row_number() OVER (PARTITION BY u ORDER BY length(r.h || r.p) DESC NULLS LAST) AS n
  FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)) WHERE n = 1
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest_vectors.nearest_vectors(rows.filter(F.col("vec_id") % 50 == 0), rows)


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(table(spark, sf_dir, "documents"), TRAINING_RANKS, public_tokenizers.PATTERN)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents")).drop(KEY)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents")).drop(KEY)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage, with the cheapest edits that repair it."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(rows), rows)


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return line_quality.quality(docs, line_quality.train(docs, table(spark, sf_dir, "labels")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in each of their 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_lm_score, op3_decontamination, op4_url_filter, op5_toxicity, op6_nearest_vectors,
        op7_training_order, op8_byte_bpe, op9_passages, op10_near_duplicates, op11_conversation_repair,
        op12_line_quality, op13_filter_audit, pipeline,
    )
}
ORACLES = {
    "op3_decontamination": decontaminate.REPORT_SQL,
    "op4_url_filter": OP4_SQL,
    "op11_conversation_repair": conversation_repair.REPORT_SQL,
    "op13_filter_audit": filter_audit.AUDIT_SQL,
}
