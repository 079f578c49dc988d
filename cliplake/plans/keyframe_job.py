"""Keyframe job: features, smoothing, scaling, clustering and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.functions import images
from cliplake.operators import cluster, kmeans, series
from cliplake.params import ClusterParams
from cliplake.runtime import staged
from cliplake.sources.frame_store import FrameStore


def extract_features(images_df: DataFrame) -> DataFrame:
    """Add the feature vector of each image (height, width, channels, data)."""
    return images_df.withColumn(
        "features",
        images.frame_features(
            F.col("height"), F.col("width"), F.col("channels"), F.col("data")
        ),
    )


def assign_clusters(
    frames: DataFrame, features: str = "features", params: ClusterParams = ClusterParams()
) -> DataFrame:
    """Frames with smoothed features, their cluster and the distance to its centre."""
    narrow = frames.select("video_name", "frame_number", "timestamp", features)
    smoothed = series.smooth(narrow, features).select(
        "video_name", "frame_number", "timestamp", "gaussian_smoothed_features"
    )
    # Scaling and clustering read the smoothed rows many times.
    scaled = cluster.standardize(staged(smoothed, "smoothed"), "gaussian_smoothed_features")
    return kmeans.assign(scaled, ["video_name", "frame_number"], params=params)


def keyframes(
    frames: DataFrame, features: str = "features", params: ClusterParams = ClusterParams()
) -> DataFrame:
    """One keyframe per cluster, by video and time."""
    chosen = cluster.select_keyframes(assign_clusters(frames, features, params))
    return chosen.select(
        "video_name", "frame_number", "timestamp", "cluster", "gaussian_smoothed_features"
    ).orderBy("video_name", "timestamp", "frame_number")


def from_pixels(store: FrameStore, params: ClusterParams = ClusterParams()) -> DataFrame:
    """Keyframes of stored frames (timestamp, height, width, channels, data), with their pixels.

    Features are taken from the pixels in one scan and written; the frames are chosen on them
    alone.  Then the pixels of the chosen frames are fetched.
    """
    found = extract_features(store.frames()).select("video_name", "frame_number", "timestamp", "features")
    chosen = staged(keyframes(staged(found, "features"), params=params), "chosen")
    columns = ("height", "width", "channels", "data")
    return store.fetch(chosen, *columns).orderBy("video_name", "timestamp", "frame_number")
