"""Standardising and keyframe selection over feature vectors; K-means is in ``kmeans``."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake.functions import vectors
from cliplake.operators import ordered, skew
from cliplake.params import ClusterParams
from cliplake.runtime import Scratch, staged


def standardize(df: DataFrame, features: str, output: str = "scaled_features") -> DataFrame:
    """Scale each dimension to mean 0 and sample deviation 1; constant dimensions give 0."""
    as_vectors = df.withColumn("_vector", array_to_vector(F.col(features)))
    scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True, withStd=True)
    scaled = scaler.fit(as_vectors).transform(as_vectors)
    return scaled.withColumn(output, vector_to_array("_scaled")).drop("_vector", "_scaled")


def cluster_count(rows: Column, params: ClusterParams = ClusterParams()) -> Column:
    """max(floor, int(ratio * rows)) clusters."""
    share = F.floor(rows * F.lit(params.ratio)).cast("bigint")
    return F.greatest(F.lit(params.floor).cast("bigint"), share)


def distance_to_mean(
    df: DataFrame,
    keys: list[str],
    features: str = "features",
) -> DataFrame:
    """Distance of each row to the mean vector of its given cluster.

    The means are written once and joined by cluster, hot clusters spread; small ones are
    broadcast by Spark itself.
    """
    narrow = df.withColumn(features, vectors.as_doubles(F.col(features)))
    centers = staged(
        narrow.groupBy("cluster").agg(
            vector_to_array(Summarizer.mean(array_to_vector(F.col(features)))).alias("center")
        ),
        "centers",
    )
    paired = skew.salted_join(narrow, centers, "cluster", keys)
    return paired.select(
        *df.columns,
        F.round(vectors.euclid_distance(F.col(features), F.col("center")), 6).alias("distance"),
    )


def select_keyframes(assigned: DataFrame) -> DataFrame:
    """The frame nearest to each cluster centre; ties by video, then frame.

    The rank filter keeps one frame per cluster in every task before the shuffle.
    """
    nearest = Window.partitionBy("cluster").orderBy("distance", "video_name", "frame_number")
    return (
        assigned.withColumn("_rank", F.row_number().over(nearest))
        .where("_rank = 1")
        .drop("_rank")
    )


def ordered_keyframes(keyframes: DataFrame) -> DataFrame:
    """Keyframes by video and time, with the caption and the ``position`` of each frame."""
    captioned = keyframes.withColumn("caption", F.format_string("t=%.1fs", "timestamp"))
    order = ["video_name", "timestamp", "frame_number"]
    scratch = Scratch(keyframes.sparkSession)
    return ordered.with_position(captioned, order, "position", scratch).orderBy("position")


def in_parts(
    keyframes: DataFrame, rows_per_part: int, slice_seconds: int = 4096
) -> DataFrame:
    """Number the keyframes of a video in time and cut them into parts of bounded size."""
    numbered = ordered.number_rows(
        keyframes,
        ["video_name"],
        ["timestamp", "frame_number"],
        ordered.slice_of(F.col("timestamp"), slice_seconds),
        "_position",
    )
    return numbered.withColumn("part", F.floor(F.col("_position") / rows_per_part))


def keyframe_figures(frames: DataFrame, keyframes: DataFrame) -> DataFrame:
    """Keyframe count, first and last time and compression ratio, one row per video.

    Videos without a keyframe drop out.
    """
    frame_counts = frames.groupBy("video_name").agg(
        F.count(F.lit(1)).alias("original_frame_count")
    )
    totals = keyframes.groupBy("video_name").agg(
        F.count(F.lit(1)).alias("num_keyframes"),
        F.min("timestamp").alias("first_keyframe_time"),
        F.max("timestamp").alias("last_keyframe_time"),
    )
    ratio = F.col("original_frame_count") / F.col("num_keyframes")
    return totals.join(frame_counts, "video_name").withColumn("compression_ratio", ratio)


def keyframe_stats(
    frames: DataFrame, keyframes: DataFrame, rows_per_part: int = 10000
) -> DataFrame:
    """The figures of each video (``keyframe_figures``) with the clusters of its keyframes.

    The cluster list of a video with more than ``rows_per_part`` keyframes goes on in further rows
    (``part`` 1, 2, ...) that repeat the figures; lists and figures meet by (video, part), so that
    one video's lists never gather in one task.
    """
    lists = (
        in_parts(keyframes, rows_per_part)
        .groupBy("video_name", "part")
        .agg(F.sort_array(F.collect_list("cluster")).alias("clusters_represented"))
    )
    last = F.floor((F.col("num_keyframes") - 1) / rows_per_part)
    figures = keyframe_figures(frames, keyframes)
    for_each = figures.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return lists.join(for_each, ["video_name", "part"])


def overall_ratio(frames: DataFrame, keyframes: DataFrame) -> DataFrame:
    """Frames per keyframe and frames per video over the whole catalogue; null without any."""
    per_video = frames.groupBy("video_name").agg(F.count(F.lit(1)).alias("frames"))
    totals = per_video.agg(
        F.coalesce(F.sum("frames"), F.lit(0)).alias("total_frames"),
        F.count(F.lit(1)).alias("videos"),
    )
    kept = keyframes.agg(F.count(F.lit(1))).scalar()
    return totals.withColumn("keyframes", kept).select(
        "*",
        F.try_divide("total_frames", "keyframes").alias("compression"),
        F.try_divide("total_frames", "videos").alias("frames_per_video"),
    )
