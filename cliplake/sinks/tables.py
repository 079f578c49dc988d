"""Sinks: JSON, quality tiers, named collections, files per row and the HTML report."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliplake.functions import html
from cliplake.operators import documents
from cliplake.params import QualityParams
from cliplake.runtime import child_names, touch

# The ASCII record separator, which ends every record of a container file.
RECORD_END = "\x1e"


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_tiers(
    checked: DataFrame, path: str, fmt: str = "parquet", params: QualityParams = QualityParams()
) -> None:
    """Write the high, medium and low rows to one partition each, in a single pass."""
    tiers = checked.where(F.col("quality_score") >= params.low)
    tiers.write.mode("overwrite").format(fmt).partitionBy("quality_level").save(path)


class Collections:
    """Named document collections below one folder.

    Each write is a new version ``v<n>``; an empty file ``current-<n>`` is created when it is
    complete and names it.  Numbers are never used twice, so a failed write leaves nothing that
    could be taken for data.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def _numbers(self, name: str, prefix: str) -> list[int]:
        entries = child_names(self.spark, f"{self.root}/{name}")
        tails = (n.removeprefix(prefix) for n in entries if n.startswith(prefix))
        return sorted(int(tail) for tail in tails if tail.isdigit())

    def _versions(self, name: str) -> list[int]:
        """Versions whose write was completed."""
        return self._numbers(name, "current-")

    def overwrite(self, df: DataFrame, name: str) -> DataFrame:
        """Replace a collection.  The new version is written beside the old one, which stays
        readable until the write is complete."""
        number = max([0, *self._numbers(name, "v"), *self._versions(name)]) + 1
        df.write.format(self.fmt).save(f"{self.root}/{name}/v{number}")
        touch(self.spark, f"{self.root}/{name}/current-{number}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        versions = self._versions(name)
        if not versions:
            raise ValueError(f"no collection {name!r} in {self.root}")
        return self.spark.read.format(self.fmt).load(f"{self.root}/{name}/v{versions[-1]}")

    def upsert(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Merge rows by key: the given fields win, other fields survive, new keys are added."""
        if not self._versions(name):
            return self.overwrite(df, name)
        return self.overwrite(documents.upsert(self.read(name), df, key), name)


class KeyedCollection:
    """A collection of rows with a key, in buckets of the key's hash.

    An upsert reads and writes only the buckets that its keys fall into.  Version ``n`` writes these
    to ``data-<n>/bucket=<b>`` and a table ``manifest-<n>`` that tells for every bucket which version
    holds it; an empty file ``current-<n>`` completes it.  Files of other buckets stay as they are.
    The number of buckets follows the rows of the first write, up to ``MOST_BUCKETS``, and then stays:
    every bucket is a file of each version that touches it, and these files are listed, moved and opened
    one by one, so beyond that number buckets hold more rows instead.
    """

    MOST_BUCKETS = 1024

    def __init__(self, spark: SparkSession, root: str, key: str, rows_per_bucket: int = 100_000):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.rows_per_bucket = rows_per_bucket

    def _numbers(self, prefix: str) -> list[int]:
        tails = [n.removeprefix(prefix) for n in child_names(self.spark, self.root) if n.startswith(prefix)]
        return sorted(int(tail) for tail in tails if tail.isdigit())

    def _manifest(self) -> tuple[dict[int, int], T.StructType, int] | None:
        """Version of every bucket with rows, the schema and the number of buckets, of the last version."""
        versions = self._numbers("current-")
        if not versions:
            return None
        rows = self.spark.read.parquet(f"{self.root}/manifest-{versions[-1]}").collect()
        schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
        return {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}, schema, rows[0]["buckets"]

    def _rows(self, versions: dict[int, int], schema: T.StructType) -> DataFrame:
        paths = [f"{self.root}/data-{version}/bucket={bucket}" for bucket, version in sorted(versions.items())]
        # Columns that an older bucket does not have yet read as null.
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def read(self) -> DataFrame:
        known = self._manifest()
        if known is None:
            raise ValueError(f"no collection in {self.root}")
        return self._rows(*known[:2])

    def upsert(self, df: DataFrame) -> DataFrame:
        """Merge rows by key: the given fields win, other fields survive, new keys are added.

        ``df`` has one row per key.  Gives the collection as it is then.
        """
        known = self._manifest()
        if known is None:
            versions, buckets = {}, min(self.MOST_BUCKETS, max(1, -(-df.count() // self.rows_per_bucket)))
            merged = df
        else:
            versions, schema, buckets = known
            met = {row[0] for row in df.select(self._bucket(buckets)).distinct().collect()}
            old = self._rows({b: v for b, v in versions.items() if b in met}, schema)
            merged = documents.upsert(old, df, self.key)
        number = max([0, *self._numbers("data-"), *self._numbers("current-")]) + 1
        # A given number, as adaptive execution would leave the files of all buckets to few tasks.
        context = self.spark.sparkContext
        tasks = min(buckets, max(context.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        placed = merged.withColumn("bucket", self._bucket(buckets)).repartition(tasks, "bucket")
        placed.write.partitionBy("bucket").parquet(f"{self.root}/data-{number}")
        written = child_names(self.spark, f"{self.root}/data-{number}")
        versions |= {int(n.removeprefix("bucket=")): number for n in written if n.startswith("bucket=")}
        text = json.dumps(merged.schema.jsonValue())
        rows = [(bucket, version, text, buckets) for bucket, version in versions.items()] or [(None, None, text, buckets)]
        manifest = self.spark.createDataFrame(rows, "bucket int, version int, schema string, buckets int")
        manifest.coalesce(1).write.parquet(f"{self.root}/manifest-{number}")
        touch(self.spark, f"{self.root}/current-{number}")
        return self.read()


def write_records(lines: DataFrame, path: str, per_file: int = 1000) -> None:
    """Write one text column as container files of at most ``per_file`` records."""
    lines.write.mode("overwrite").option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", per_file
    ).text(path)


def write_files(df: DataFrame, name: str, content: str, path: str) -> None:
    """Write one file per row below ``path/<name>=<value>/``, followed by a line break."""
    raw = F.col(content).cast("string")
    df.select(name, raw.alias("value")).write.mode("overwrite").partitionBy(name).text(path)


def report_cards(summaries: DataFrame) -> DataFrame:
    """One HTML card per final summary."""
    fields = ["num_keyframes", "duration_seconds", "sentiment", "text_summary", "keywords"]
    return summaries.select(
        "video_name", html.card(F.col("video_name"), *map(F.col, fields)).alias("card")
    )


def write_html_report(summaries: DataFrame, path: str) -> None:
    """Write the report as ordered text parts: head, cards by video name, foot."""
    spark = summaries.sparkSession
    cards = report_cards(summaries).select(F.lit(1).alias("_at"), "video_name", "card")
    frame = spark.createDataFrame(
        [(0, "", html.HEAD), (2, "", html.FOOT)], "_at int, video_name string, card string"
    )
    page = cards.unionByName(frame).orderBy("_at", "video_name")
    page.select(F.col("card").alias("value")).write.mode("overwrite").text(path)
