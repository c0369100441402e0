"""Versioned sinks (S12, S14): a write goes to a folder of its own, then one rename swaps the pointer to it.

``path/versions/<version>`` holds the data, ``path/_current`` the name of the version that readers see. A failed write
leaves the pointer, and so the older version, as it was; readers that have begun keep the files they began with. Only
Hadoop's file system interface is used, so the path may be on any store that Spark reads and that renames a file in one
step. Old versions stay until ``forget`` takes them away.
"""

from __future__ import annotations

import time
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

POINTER, WRITTEN = "_current", "_written"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _swap(spark: SparkSession, path: str, version: str) -> None:
    jvm = spark._jvm
    fs, fresh = _fs(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(version.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), how)


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that readers see; None before the first write."""
    fs, where = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    name = bytes(stream.readNBytes(256)).decode()
    stream.close()
    return f"{path}/versions/{name}"


def write_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Lets ``write`` fill the folder of a new version, makes it the current one and returns it."""
    version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/versions/{version}"
    write(folder)
    fs, mark = _fs(spark, f"{folder}/{WRITTEN}")
    fs.create(mark).close()
    _swap(spark, path, version)
    return folder


def write_version(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options) -> str:
    """Writes rows as a new version, makes it the current one and returns its folder."""
    save = lambda folder: df.write.mode("errorifexists").format(fmt).options(**options).partitionBy(*partition_by).save(folder)
    return write_folder(df.sparkSession, path, save)


def read_current(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing written to {path}")
    return spark.read.format(fmt).options(**options).load(folder)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of all versions, oldest first, those of failed writes included."""
    fs, where = _fs(spark, f"{path}/versions")
    return sorted(f"{path}/versions/{s.getPath().getName()}" for s in fs.listStatus(where)) if fs.exists(where) else []


def forget(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes what is older than the current version, but for the ``keep`` - 1 whole versions before it; returns what
    went. Newer folders (a write that goes on, or failed last) stay."""
    now = current(spark, path)
    old = [v for v in versions(spark, path) if now is not None and v < now]
    whole = [v for v in old if _fs(spark, v)[0].exists(_fs(spark, f"{v}/{WRITTEN}")[1])]
    kept = whole[max(0, len(whole) - keep + 1):]
    gone = [v for v in old if v not in kept]
    for v in gone:
        fs, where = _fs(spark, v)
        fs.delete(where, True)
    return gone
