"""Quality score, level and validity checks of probed media files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.params import QualityParams


def duration_points(duration: Column) -> Column:
    return (
        F.when(duration.between(30, 600), 25.0)
        .when((duration > 600) & (duration <= 1800), 20.0)
        .when((duration > 0) & (duration < 30), 10.0)
        .otherwise(0.0)
    )


def resolution_points(resolution: Column) -> Column:
    """Points by line count; the first line count found anywhere in the text decides."""
    return (
        F.when(resolution.contains("1080"), 30.0)
        .when(resolution.contains("720"), 25.0)
        .when(resolution.contains("480"), 20.0)
        .otherwise(10.0)
    )


def fps_points(fps: Column) -> Column:
    return (
        F.when(fps.between(24, 30), 20.0)
        .when((fps > 30) & (fps <= 60), 25.0)
        .when(fps > 0, 10.0)
        .otherwise(0.0)
    )


def bitrate_points(bitrate: Column) -> Column:
    """Points by whole kilobits per second."""
    kbps = F.floor(bitrate / 1000)
    return (
        F.when(kbps.between(500, 5000), 25.0)
        .when(kbps > 5000, 20.0)
        .when(kbps > 0, 10.0)
        .otherwise(0.0)
    )


def quality_score(duration: Column, resolution: Column, fps: Column, bitrate: Column) -> Column:
    """Sum of the four point bands, 0 to 105."""
    return (
        duration_points(duration)
        + resolution_points(resolution)
        + fps_points(fps)
        + bitrate_points(bitrate)
    )


def quality_level(score: Column, params: QualityParams = QualityParams()) -> Column:
    return (
        F.when(score >= params.high, "high")
        .when(score >= params.medium, "medium")
        .when(score >= params.low, "low")
        .otherwise("poor")
    )


def is_valid_duration(duration: Column, params: QualityParams = QualityParams()) -> Column:
    return duration.between(params.min_duration, params.max_duration)


def is_valid_resolution(resolution: Column) -> Column:
    return ~resolution.contains("unknown") & ~resolution.contains("0x0")


def is_valid_fps(fps: Column, params: QualityParams = QualityParams()) -> Column:
    return fps.between(params.min_fps, params.max_fps)
