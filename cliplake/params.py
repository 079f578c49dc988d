"""Default parameters of the jobs, in one typed object each."""

from __future__ import annotations

from dataclasses import dataclass

# File extensions taken as media, matched without regard to case.
MEDIA_EXTENSIONS = ("mp4", "avi", "mov", "mkv", "flv", "webm")

# Rows sorted together when one ordered group (a video, a clip) is cut into slices.
ROWS_PER_SLICE = 65536


@dataclass(frozen=True)
class QualityParams:
    """Thresholds of the quality levels and of the cleaning funnel."""

    high: float = 80.0
    medium: float = 60.0
    low: float = 40.0
    min_duration: float = 10.0
    max_duration: float = 3600.0
    min_fps: float = 15.0
    max_fps: float = 120.0


@dataclass(frozen=True)
class ClusterParams:
    """K-means settings; the cluster count is max(floor, int(ratio * rows)), and there are at most
    ``passes`` passes."""

    ratio: float = 0.1
    floor: int = 5
    passes: int = 20


@dataclass(frozen=True)
class AudioParams:
    """Framing and MFCC settings (seconds, counts)."""

    frame_seconds: float = 0.025
    hop_seconds: float = 0.010
    pre_emphasis: float = 0.97
    n_fft: int = 512
    n_filters: int = 26
    n_mfcc: int = 13
    speech_ratio: float = 0.5


@dataclass(frozen=True)
class TextParams:
    """Sizes of the keyword lists."""

    keywords: int = 10
    summary_keywords: int = 5
    tfidf_terms: int = 5
