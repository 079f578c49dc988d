"""Session helpers: working folders and file listings on the cluster's shared storage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which an execution removes its shuffle files at its end.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables, from ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    Where neither is set a local session, and no other, gets a folder of its own: it is named in the
    session's setting then, so that all later steps agree on it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        known = spark._jsc.sc().getCheckpointDir()
        shared = known.get() if known.isDefined() else None
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="cliplake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the working folder that no run has used before."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str) -> None:
    """Write a table.  The shuffle files of the write are removed when it ends: nothing else reads
    them, and left to the garbage collection of the driver they would pile up from step to step."""
    conf = df.sparkSession.conf
    before = conf.get(FILE_CLEANUP, None)
    conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(FILE_CLEANUP) if before is None else conf.set(FILE_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Steps that read their input several times, each on top of the other, would run the whole plan
    below them again and again; a written table ends that, and outlives lost executors.
    """
    path = fresh_dir(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Working tables of one operator, deleted together when its result is written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_dir(self.spark, name)
        self.paths.append(path)
        _write(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self, *names: str) -> None:
        """Delete the tables of these names, whose last reader has ended."""
        gone = [path for path in self.paths if path.rsplit("/", 1)[1].rsplit("-", 1)[0] in names]
        for path in gone:
            hadoop_path, fs = _hadoop_path(self.spark, path)
            fs.delete(hadoop_path, True)
            self.paths.remove(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names, whose last reader has ended, and shuffle files of ended
        steps, which Spark removes once nothing on the driver refers to them any more."""
        self.delete(*names)
        gc.collect()
        self.spark._jvm.System.gc()

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """Write the result, then delete the tables that led to it."""
        out = staged(df, name)
        self.drop(*[path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in self.paths])
        return out


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any path that a pattern fits, is there."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return bool(fs.globStatus(hadoop_path))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The folders and files that a path or pattern fits; none when nothing is there."""
    hadoop_path, fs = _hadoop_path(spark, pattern)
    return sorted(str(status.getPath()) for status in fs.globStatus(hadoop_path) or [])


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.create(hadoop_path, False).close()


def file_count(spark: SparkSession, path: str) -> int:
    """Number of files at or below a path."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return int(fs.getContentSummary(hadoop_path).getFileCount())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below a folder; none when it does not exist."""
    hadoop_path, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))
