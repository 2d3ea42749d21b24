"""Row keys, column names and lineage shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that have the name of a result column: the result's meaning wins."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def with_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add the long ``_key`` by which an operator refers to a document.

    It is the id itself where every row has its own non-null integer id, which one narrow grouping of the ids shows.
    Otherwise it is a 64-bit hash of id and text: rows equal in both are then one document, and rows that share only
    the id stay apart.
    """
    docs = without(docs, KEY)
    whole = isinstance(docs.schema[doc_id].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if whole and docs.groupBy(doc_id).count().filter(F.col(doc_id).isNull() | (F.col("count") > 1)).isEmpty():
        return docs.withColumn(KEY, F.col(doc_id).cast("long"))
    return docs.withColumn(KEY, F.xxhash64(F.lit(1), F.col(doc_id), F.lit(2), F.col(text)))


def append(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(n, t) for n, t in fields])


def one_per_key(keyed: DataFrame) -> DataFrame:
    """Rows equal in key once; ids that are unique need no shuffle of the rows for it."""
    if keyed.groupBy(KEY).count().filter("count > 1").isEmpty():
        return keyed
    return keyed.dropDuplicates([KEY])
