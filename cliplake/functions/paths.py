"""File names, extensions and path segments as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.params import MEDIA_EXTENSIONS


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def strip_extension(name: Column) -> Column:
    """Drop the last extension only."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def has_media_extension(name: Column) -> Column:
    suffix = F.substring_index(F.lower(name), ".", -1)
    return name.contains(".") & suffix.isin(*MEDIA_EXTENSIONS)


def strip_authority(path: Column) -> Column:
    """Remove every ``hdfs://host/`` prefix, keeping the rest of the path."""
    return F.regexp_replace(path, "hdfs://.*?/", "")


def audio_name(video_name: Column) -> Column:
    """Replace every ``.mp4`` by ``.wav``."""
    return F.replace(video_name, F.lit(".mp4"), F.lit(".wav"))


def video_name_of_audio(audio_path: Column) -> Column:
    """Replace a closing ``.wav`` by ``.mp4``."""
    return F.regexp_replace(audio_path, r"\.wav$", ".mp4")


def summary_name(video_name: Column) -> Column:
    return F.replace(video_name, F.lit(".mp4"), F.lit("_summary.mp4"))


def path_category(path: Column) -> Column:
    """Quality category named by the tier folder in the path."""
    return (
        F.when(path.contains("/high_quality/"), "high")
        .when(path.contains("/medium_quality/"), "medium")
        .when(path.contains("/low_quality/"), "low")
        .otherwise("unknown")
    )
