"""Frames with their pixels, laid out so that pixels of a few chosen frames cost a few files.

Runs of neighbouring frames of a video share a bucket, a bucket is one folder, and a folder holds
about ``FRAMES_PER_BUCKET`` frames in order.  Jobs read the narrow columns of all frames; the pixels
of chosen frames are fetched last, from the buckets that hold one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frames of a bucket, and neighbouring frames of a video that stay together.
FRAMES_PER_BUCKET, FRAMES_PER_RUN = 1024, 64
#: Chosen frames up to which their keys are broadcast, so that no pixels are shuffled.
BROADCAST_FRAMES = 1_000_000
KEYS = ["video_name", "frame_number"]


class FrameStore:
    """A folder of frames; ``write`` makes one, the constructor opens it."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = spark.read.parquet(f"{self.root}/layout").first()["buckets"]

    @staticmethod
    def write(frames: DataFrame, root: str, per_bucket: int = FRAMES_PER_BUCKET) -> FrameStore:
        """Write frames (video_name, frame_number and any columns) and open the store.

        The number of buckets follows the number of frames.  Frames are shuffled once, by bucket.
        """
        spark, root = frames.sparkSession, root.rstrip("/")
        buckets = max(1, -(-frames.count() // per_bucket))
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{root}/layout")
        placed = frames.withColumn("bucket", _bucket(buckets))
        ordered = placed.repartition("bucket").sortWithinPartitions("bucket", *KEYS)
        ordered.write.partitionBy("bucket").parquet(f"{root}/frames")
        return FrameStore(spark, root)

    def frames(self) -> DataFrame:
        """All frames; only the columns that are used are read."""
        return self.spark.read.parquet(f"{self.root}/frames").drop("bucket")

    def fetch(self, chosen: DataFrame, *columns: str) -> DataFrame:
        """The chosen rows with further columns of their frames, null where a frame is not there.

        Only buckets with a chosen frame are opened.  Their numbers, fewer than the files that the
        scan lists anyway, pass through the driver; frames that were not chosen are dropped before
        any shuffle when the keys can be broadcast.
        """
        keyed = chosen.withColumn("bucket", _bucket(self.buckets))
        needed = [row[0] for row in keyed.select("bucket").distinct().collect()]
        stored = self.spark.read.parquet(f"{self.root}/frames")
        if len(needed) < self.buckets:
            stored = stored.where(F.col("bucket").isin(needed)) if needed else stored.limit(0)
        keys = keyed.select("bucket", *KEYS)
        few = keys.count() <= BROADCAST_FRAMES
        held = stored.join(F.broadcast(keys) if few else keys, ["bucket", *KEYS], "left_semi")
        return keyed.join(held.select("bucket", *KEYS, *columns), ["bucket", *KEYS], "left").select(
            *chosen.columns, *columns
        )


def _bucket(buckets: int) -> Column:
    run = F.floor(F.col("frame_number") / FRAMES_PER_RUN)
    return F.pmod(F.xxhash64("video_name", run), F.lit(buckets)).cast("int")
