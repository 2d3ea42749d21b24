"""Left join to a keyed table that holds up when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravia.session import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
ROWS_PER_SALT = 100_000
NULL_SALTS = 1 << 20  # rows without a key meet nothing; they only have to be spread


def fits_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Has the table at most so many rows and, as text, bytes?"""
    text = F.to_json(F.struct("*"))
    n, held = table.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    return n <= rows and (held or 0) <= size


def salted_join(big: DataFrame, small: DataFrame, on, rows_per_salt: int = 100_000) -> DataFrame:
    """Inner join in which a key with many rows of ``big`` becomes as many join keys as it needs.

    ``big`` is written, then counted per key; a key is dealt to ``rows / rows_per_salt`` salts, and
    the rows of ``small`` with that key are copied to each. There is no upper limit to the salts.
    """
    on = [on] if isinstance(on, str) else list(on)
    stored = cut_lineage(big, "salted")
    salts = F.ceil(F.col("_n") / rows_per_salt).cast("int")
    counted = stored.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_salt)
    hot = cut_lineage(counted.select(*on, salts.alias("_salts")), "hot-keys")
    if hot.isEmpty():
        return stored.join(small, on)
    spread = stored.join(hot, on, "left").withColumns({"_salts": F.coalesce("_salts", F.lit(1))})
    # the table is written, so the position of a row stays the same when a task is run again
    spread = spread.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int"))
    copies = small.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return spread.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"]).drop("_salt")


def lookup_join(
    df: DataFrame, on: Column, table: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """``df`` left joined to ``table`` (one row per ``key``) on ``on == key``.

    A table of measured small size is broadcast. Otherwise both are shuffled, and a key of ``df`` with many rows becomes
    as many join keys as it needs: its rows are dealt to salts and the one row of ``table`` is copied to each. There is
    no limit to such keys or their salts; their table is written and joined like any other.
    """
    if fits_broadcast(table, broadcast_rows):
        return df.join(F.broadcast(table), on == F.col(key), "left")
    counted = df.where(on.isNotNull()).groupBy(on.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    salts = F.ceil(F.col("_n") / rows_per_salt).cast("int")
    hot = cut_lineage(counted.where(F.col("_n") > rows_per_salt).select("_k", salts.alias("_salts")), "hot-keys")
    # the rows are written, so the number of a row stays the same when a task is run again
    stored = cut_lineage(df.withColumn("_k", on), "lookup")
    number = F.monotonically_increasing_id()
    marked = stored.withColumn("_n", number).join(hot, "_k", "left")
    salt = F.when(F.col("_k").isNull(), F.pmod("_n", F.lit(NULL_SALTS))).otherwise(F.pmod("_n", F.coalesce("_salts", F.lit(1))))
    spread = marked.withColumn("_salt", salt.cast("int")).drop("_salts", "_n")
    copies = table.join(hot, F.col(key) == F.col("_k"), "left").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_k", "_salts")
    joined = spread.join(copies, (F.col("_k") == F.col(key)) & (F.col("_salt") == F.col("_copy")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{c}`") for c in table.columns])
