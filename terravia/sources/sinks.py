"""Write layers and publish views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravia.errors import LayerError
from terravia.functions.text import this_year


def write_layer(df: DataFrame, path: str, overwrite: bool = False, fmt: str = "parquet") -> DataFrame:
    """Write a layer and read it back; without ``overwrite`` an existing one is an error."""
    df.write.format(fmt).mode("overwrite" if overwrite else "errorifexists").save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


# fixed values: the signs Spark writes as %XX in the folder name of a partition value
ESCAPED = "\"#%'*/:=?\\{}[]^"


def _folder(name: str, value) -> str:
    """Folder of one partition value, named as Spark names it."""
    if value is None:
        return f"{name}=__HIVE_DEFAULT_PARTITION__"
    return f"{name}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in str(value))


def write_partition(df: DataFrame, path: str, values: dict, overwrite: bool = True) -> DataFrame:
    """Write ``df`` as the one partition that ``values`` names; a rerun replaces it.

    The folder itself is overwritten, so a rerun or a first run without rows leaves an empty
    partition; without ``overwrite`` an existing one is an error. Returns that partition, read back with the types that were written.
    """
    plain = df.drop(*values)
    folder = "/".join([path.rstrip("/"), *[_folder(n, v) for n, v in values.items()]])
    plain.write.mode("overwrite" if overwrite else "errorifexists").parquet(folder)
    stored = df.sparkSession.read.schema(plain.schema).parquet(folder)
    return stored.withColumns({n: F.lit(v) for n, v in values.items()})


def write_partitions(df: DataFrame, path: str, partition_by) -> DataFrame:
    """Write by partition columns; a rerun replaces only the partitions it holds rows of.

    Rows are rebalanced by partition value first: Spark merges small partitions, so there are few
    files, and splits one that holds most of the rows over several tasks. Read back with the types
    that were written: a code like '01' stays a string.
    """
    names = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    (
        df.hint("rebalance", *[F.col(n) for n in names])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*names)
        .parquet(path)
    )
    return read_partitions(df.sparkSession, path, df.schema)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], wanted: DataFrame, overwrite: bool = True) -> DataFrame:
    """Write by partition columns; every partition that ``wanted`` names is replaced, also one without rows.

    One write for all of them. A partition of ``wanted`` that got no rows is emptied after it; without
    ``overwrite`` an existing one of ``wanted`` is an error before anything is written.
    """
    spark, names = df.sparkSession, list(partition_by)
    # the partitions themselves: as many as there are folders
    asked = [tuple(r) for r in wanted.select(*names).distinct().collect()]
    folders = {a: "/".join([path.rstrip("/"), *[_folder(n, v) for n, v in zip(names, a)]]) for a in asked}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def held(folder: str) -> set[str] | None:
        """Names of the files in a folder, None where there is none."""
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return {f.getPath().getName() for f in files.listStatus(place)} if files.exists(place) else None

    before = {a: names_of for a in asked if (names_of := held(folders[a])) is not None}
    if before and not overwrite:
        raise LayerError(f"partitions exist: {sorted(map(str, before))}")
    write_partitions(df, path, names)
    for a, old in before.items():
        # a partition that this run wrote has other files than before
        if old and held(folders[a]) == old:
            df.drop(*names).limit(0).write.mode("overwrite").parquet(folders[a])
    return read_partitions(spark, path, df.schema)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All partitions below a folder, with the given types also for the partition columns."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def with_vintage(df: DataFrame, year: int | None = None) -> DataFrame:
    """Add the vintage column ``millesime``: the given year or the current one."""
    return df.withColumn("millesime", F.lit(year or this_year()))


def catalog_name(name: str) -> str:
    """A name the session catalog accepts: other signs become ``_``, a leading digit gets a letter."""
    safe = re.sub(r"\W", "_", name)
    return f"s{safe}" if safe[:1].isdigit() else safe


def publish_view(df: DataFrame, table: str) -> str:
    """Create or replace the view ``<table>_view`` over a layer and return its name."""
    view = f"{catalog_name(table)}_view"
    df.createOrReplaceTempView(view)
    return view


def save_table(df: DataFrame, schema: str, table: str, overwrite: bool = False) -> str:
    """Save as a catalog table with statistics; returns the full name."""
    spark: SparkSession = df.sparkSession
    full = f"{catalog_name(schema)}.{catalog_name(table)}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {catalog_name(schema)}")
    df.write.mode("overwrite" if overwrite else "errorifexists").saveAsTable(full)
    refresh_statistics(spark, full)
    return full


def register_table(spark: SparkSession, schema: str, table: str, path: str, columns: T.StructType | None = None) -> str:
    """Register what lies at ``path`` as a catalog table with statistics; returns the full name.

    ``columns``, where they are known and none is in the folder names, spare the reading of every file for them.

    The table is external: registering again or dropping it leaves the files alone.
    """
    full = f"{catalog_name(schema)}.{catalog_name(table)}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {catalog_name(schema)}")
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.catalog.createTable(full, path=path, source="parquet", schema=columns)
    if columns is None and any(c.isPartition for c in spark.catalog.listColumns(full)):
        spark.catalog.recoverPartitions(full)
    refresh_statistics(spark, full)
    return full


def refresh_statistics(spark: SparkSession, table: str) -> None:
    """Row count and column statistics of a saved table, for the optimizer."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType)
    plain = [f"`{f.name}`" for f in spark.table(table).schema if not isinstance(f.dataType, nested)]
    columns = f" FOR COLUMNS {', '.join(plain)}" if plain else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{columns}")


def write_jdbc(df: DataFrame, url: str, table: str, overwrite: bool = False, **properties) -> None:
    """Write attributes to an external database; a geometry column must be exported as text first."""
    if "geom" in df.columns and df.schema["geom"].dataType.typeName() == "struct":
        raise LayerError("convert geom with to_wkt before writing to a database")
    df.write.jdbc(url, table, mode="overwrite" if overwrite else "error", properties=properties)
