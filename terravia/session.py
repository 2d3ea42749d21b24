"""Session helpers: a builder for local runs and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from terravia.errors import LayerError


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("terravia")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TERRAVIA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session on one machine (master ``local``) may go without that setting: it gets a fresh
    local folder. On a cluster the lack of it is an error, as executors do not share their disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise LayerError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="run-terravia-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """New unique path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a restart point that survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_all_cores(df: DataFrame) -> DataFrame:
    """Spread an input that has fewer partitions than half the cores, as one small file does.

    For a layer as it is read, before work that multiplies rows: counting the partitions of a plain
    scan runs no job. An input of many files, the normal case at scale, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df
