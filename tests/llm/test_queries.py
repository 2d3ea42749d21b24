"""The registered queries: SQL where there is some, and shape on a small scale for all."""

import duckdb
import pytest

from terravia.llm.queries import ORACLES, QUERIES
from tools.check import table_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLES[name])
    mine = table_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine == table_of([c[0] for c in found.description], found.fetchall())


def test_one_query_per_operator():
    assert sorted(QUERIES, key=lambda n: (n == "pipeline", len(n), n))[-1] == "pipeline"
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name, per", [("op2_lm_score", "documents"), ("op5_toxicity", "documents"), ("op8_byte_bpe", "documents"), ("op10_near_duplicates", "documents")])
def test_one_row_per_document(spark, name, per):
    ids = [r["doc_id"] for r in QUERIES[name](spark, SF).select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/{per}.parquet").select("doc_id").collect())
