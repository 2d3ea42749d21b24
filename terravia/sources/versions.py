"""Layers in versions: a run writes beside what is there and then makes it the current one.

A version is a folder of its own. It becomes visible by one small file, its marker, which is created under the next
number and only if no other run has taken that number. Readers take the folder that the greatest marker names. A run
that fails before its marker leaves the layer as it was, and no run ever deletes what another may be reading; old
versions go when ``drop_old_versions`` is asked to.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from terravia.errors import LayerError

MARKERS = "_versions"


def _place(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Number and folder of every version that was finished, in order; one small file each."""
    path = path.rstrip("/")
    place, files = _place(spark, f"{path}/{MARKERS}")
    if not files.exists(place):
        return {}
    names = sorted(f.getPath().getName() for f in files.listStatus(place))
    found = {int(n): _text(spark, f"{path}/{MARKERS}/{n}") for n in names if n.isdigit()}
    # a marker is whole when it ends its line; one that is being written does not count yet
    return {n: f"{path}/{t.strip()}" for n, t in found.items() if t.endswith("\n")}


def write_version(df: DataFrame, path: str, base: int | None = None) -> DataFrame:
    """Write ``df`` as the next version and read it back.

    ``base`` is the version that the rows were made from (by default the current one when the run begins): if another
    run has finished a version since, this one is an error and changes nothing that readers see.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    number = (max(versions(spark, path), default=0) if base is None else base) + 1
    folder = f"data-{number:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    marker, files = _place(spark, f"{path}/{MARKERS}/{number:08d}")
    taken = LayerError(f"version {number} of {path} was written by another run")
    if files.exists(marker):
        raise taken
    try:
        stream = files.create(marker, False)
    except Exception as error:  # py4j hands on what the file system raised
        raise (taken if files.exists(marker) else error) from error
    try:
        stream.write(bytearray(f"{folder}\n".encode()))
    finally:
        stream.close()
    return spark.read.schema(df.schema).parquet(f"{path}/{folder}")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version of a layer, or the one of that number."""
    found = versions(spark, path)
    if not found or (version is not None and version not in found):
        raise LayerError(f"{path} has no version {'' if version is None else version}".rstrip())
    folder = found[max(found) if version is None else version]
    try:
        return spark.read.parquet(folder)
    except PySparkException as error:
        raise LayerError(f"version {version} of {path} was dropped") from error


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete the data of all but the last ``keep`` versions, and of none that is current; their numbers.

    Folders without a marker are left: a run may be writing one.
    """
    found = versions(spark, path)
    old = sorted(found)[: -max(1, keep)]
    for number in old:
        place, files = _place(spark, found[number])
        files.delete(place, True)
        marker, _ = _place(spark, f"{path.rstrip('/')}/{MARKERS}/{number:08d}")
        files.delete(marker, False)
    return old
