"""File sources: binary, image and WAV files, several folders, optional JSON, manifest lines."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cliplake.functions import audio
from cliplake.runtime import file_count, matching_paths, path_exists
from cliplake.sources import listing

log = logging.getLogger(__name__)


def spread(df: DataFrame, path: str, key: str) -> DataFrame:
    """Spread the rows of a table in fewer files than there are cores over all cores.

    Meant for heavy per-row work on small inputs, where one file can mean one busy task.  A large
    table has more files and stays as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if file_count(spark, path) >= cores:
        return df
    return df.repartition(cores, F.xxhash64(key))


def _existing(spark: SparkSession, folders: list[str]) -> list[str]:
    return [folder for folder in folders if path_exists(spark, folder)]


def binary_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Whole files directly in the folders: path, modificationTime, length, content.

    Missing folders are skipped and empty ones add nothing.  Leave ``content`` out of the select
    and no file is opened.
    """
    found = _existing(spark, folders)
    if not found:
        schema = "path string, modificationTime timestamp, length bigint, content binary"
        return spark.createDataFrame([], schema)
    scan = spark.read.format("binaryFile").load(found)
    return scan.select("path", "modificationTime", "length", "content")


def media_files(spark: SparkSession, folders: list[str], recursive: bool = False) -> DataFrame:
    """Path and length of every file, empty ones included; contents are not read.

    Folders may be given as patterns.  The tasks list the folders.
    """
    found = [folder for pattern in folders for folder in matching_paths(spark, pattern)]
    return listing.listed(spark, found, recursive).select("path", "length")


def images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded pixels of all images below a folder, in BGR order.

    A file that is no image is a row with nulls and an ``error``.
    """
    loaded = (
        spark.read.format("image")
        .option("dropInvalid", "false")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    # The reader marks such files by sizes below zero.
    good = F.coalesce(F.col("image.height") >= 0, F.lit(False))
    return loaded.select(
        F.col("image.origin").alias("origin"),
        F.when(good, F.col("image.height")).alias("height"),
        F.when(good, F.col("image.width")).alias("width"),
        F.when(good, F.col("image.nChannels")).alias("n_channels"),
        F.when(good, F.col("image.data")).alias("data"),
        F.when(~good, F.lit("not an image")).alias("error"),
    )


def wav_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Clip records of the WAV files in the folders."""
    found = binary_files(spark, folders).select(
        F.col("path").alias("filename"), audio.clip_record(F.col("content")).alias("clip")
    )
    return found.select("filename", "clip.*")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_folders(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    """JSON rows of several folders as one table; missing folders are skipped."""
    found = _existing(spark, folders)
    return spark.read.schema(schema).json(found) if found else spark.createDataFrame([], schema)


def optional_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows, or no rows and a warning when the path cannot be read."""
    try:
        return json_lines(spark, path, schema)
    except AnalysisException as problem:
        log.warning("no rows from %s: %s", path, problem.getCondition())
        return spark.createDataFrame([], schema)


def _placed_lines(spark: SparkSession, path: str, headers: bool) -> DataFrame:
    """(line_no, line): lines of text files, files by name, without the first line of each if asked.

    Numbers come from the position in each read split plus the line counts of the splits before
    it, so no task sees more than its own split.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    skipped = F.when(F.col("_block") == 0, 1).otherwise(0) if headers else F.lit(0)
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per read split, far fewer than the lines.
    starts = (
        lines.groupBy("_file", "_block")
        .agg(F.count(F.lit(1)).alias("_lines"), F.min("_id").alias("_first"))
        .withColumn("_skip", skipped)
        .withColumn("_start", F.coalesce(F.sum(F.col("_lines") - F.col("_skip")).over(before), F.lit(0)))
    )
    place = F.col("_id") - F.col("_first") - F.col("_skip")
    numbered = lines.join(starts, ["_file", "_block"]).where(place >= 0)
    return numbered.select((F.col("_start") + place).alias("line_no"), "line")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their 0-based number over all files, files in order of name."""
    return _placed_lines(spark, path, headers=False)


def manifest_lines(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Data lines of manifests, each with a header, numbered from 0; at most ``max_rows``."""
    numbered = _placed_lines(spark, path, headers=True).withColumnRenamed("line_no", "idx")
    return numbered if max_rows is None else numbered.where(F.col("idx") < max_rows)
