"""The folder that driver and executors share, for tables and files between the steps of a job."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, as a URI that Spark and pyarrow.fs both open; it goes when the application ends.

    Only a local master may do without that setting: there one machine holds all workers, and a temporary folder takes its place."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.environ.setdefault("LUMENMILL_SHARED", tempfile.mkdtemp(prefix="lumenmill-"))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/lumenmill/{name}-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    full = system.makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write a table once to shared storage and read it again: lineage ends there, and a lost executor costs no recomputation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """What the writes in here shuffle goes from the disks when each has ended; else it stays until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """The table, written once in a workspace of its own."""
    with no_shuffles_left(df.sparkSession):
        return staged(df, f"{workspace(df.sparkSession, name)}/rows")


def parted(df: DataFrame, path: str, *by: str) -> str:
    """The table under ``path``, with a folder for each value of some columns."""
    with no_shuffles_left(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Files or folders that nothing reads any more go."""
    for x in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(x)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def done_with(*tables: DataFrame) -> None:
    """Durable tables that nothing reads any more go from the shared folder."""
    for df in tables:
        remove(df.sparkSession, *{f.rpartition("/")[0] for f in df.inputFiles()})
