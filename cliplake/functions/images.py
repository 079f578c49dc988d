"""Image features as Arrow UDFs over raw pixels (height, width, channels, BGR bytes)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.functions.vectors import FEATURE_DIM

# Edge kernels (horizontal, vertical, diagonal) and gray weights of B, G, R in thousandths.
KERNELS = {
    "horizontal": ((-1, -1, -1), (0, 0, 0), (1, 1, 1)),
    "vertical": ((-1, 0, 1), (-1, 0, 1), (-1, 0, 1)),
    "diagonal": ((0, 1, 1), (-1, 0, 1), (-1, -1, 0)),
}
GRAY_WEIGHTS = (114, 587, 299)
HISTOGRAM_BINS = 32

EDGE_MAPS = "struct<" + ",".join(f"{name}:array<double>" for name in KERNELS) + ">"
TEXTURE_STATS = (
    "struct<mean_h:double,std_h:double,mean_v:double,std_v:double,mean_d:double,std_d:double,"
    "max_h:double,max_v:double,max_d:double,"
    "mean_gray:double,std_gray:double,min_gray:double,max_gray:double>"
)
TEXTURE_FIELDS = tuple(part.split(":")[0] for part in TEXTURE_STATS[7:-1].split(","))


#: Pixels that are worked on at once.
CHUNK_PIXELS = 1 << 22


def _tensors(h: pd.Series, w: pd.Series, c: pd.Series, d: pd.Series) -> Iterator[tuple[list[int], np.ndarray]]:
    """Images of a batch by shape: their rows and one array (image, height, width, channel).

    Images of one or of three and more channels whose bytes fit their shape; others are left out.
    """
    shapes: dict[tuple, list[int]] = {}
    for row, (height, width, channels, data) in enumerate(zip(h, w, c, d)):
        if data is None or pd.isna(height) or pd.isna(width) or pd.isna(channels):
            continue
        sides = int(height), int(width), int(channels)
        if min(sides) > 0 and sides[2] != 2 and len(data) == sides[0] * sides[1] * sides[2]:
            shapes.setdefault(sides, []).append(row)
    for sides, rows in shapes.items():
        step = max(1, CHUNK_PIXELS // (sides[0] * sides[1]))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            flat = np.frombuffer(b"".join([d.iloc[row] for row in some]), np.uint8)
            yield some, flat.reshape(len(some), *sides)


def _gray(images: np.ndarray) -> np.ndarray:
    """Gray levels in [0, 1]; colour is weighted and rounded to whole levels first."""
    if images.shape[3] == 1:
        return images[..., 0] / 255.0
    blue, green, red = (images[..., c].astype(np.int64) * GRAY_WEIGHTS[c] for c in range(3))
    return ((blue + green + red + 500) // 1000) / 255.0


def _edges(gray: np.ndarray) -> list[np.ndarray]:
    """Valid 3x3 cross-correlation of every image with each kernel."""
    height, width = gray.shape[1] - 2, gray.shape[2] - 2
    return [
        sum(
            (weight * gray[:, i : i + height, j : j + width] for i, line in enumerate(kernel) for j, weight in enumerate(line) if weight),
            np.zeros((len(gray), height, width)),
        )
        for kernel in KERNELS.values()
    ]


def _histograms(images: np.ndarray) -> np.ndarray:
    """Pixel counts in 32 equal bins for B, G and R; zeros for gray images."""
    n = len(images)
    if images.shape[3] == 1:
        return np.zeros((n, 3 * HISTOGRAM_BINS))
    bins = images[..., :3].reshape(n, -1, 3) // (256 // HISTOGRAM_BINS) + np.arange(3) * HISTOGRAM_BINS
    place = bins + (np.arange(n) * 3 * HISTOGRAM_BINS)[:, None, None]
    return np.bincount(place.ravel(), minlength=n * 3 * HISTOGRAM_BINS).reshape(n, -1).astype(float)


def _texture(images: np.ndarray) -> np.ndarray:
    """The statistics of TEXTURE_FIELDS, one row per image."""
    gray, whole = _gray(images), (1, 2)
    edges = _edges(gray)
    spread = [value for edge in edges for value in (edge.mean(axis=whole), edge.std(axis=whole))]
    peaks = [edge.max(axis=whole) for edge in edges]
    levels = [gray.mean(axis=whole), gray.std(axis=whole), gray.min(axis=whole), gray.max(axis=whole)]
    return np.stack([*spread, *peaks, *levels], axis=1)


def _features(images: np.ndarray) -> np.ndarray:
    found = np.concatenate([_histograms(images), _texture(images)], axis=1)
    padded = np.zeros((len(images), FEATURE_DIM), dtype=np.float32)
    padded[:, : found.shape[1]] = found[:, :FEATURE_DIM]
    return padded


def _per_image(compute, failed, least: int, batch: tuple[pd.Series, ...]) -> list:
    """What ``compute`` gives for each image; ``failed`` for bad ones and such with sides below
    ``least`` pixels."""
    results = [failed] * len(batch[0])
    for rows, images in _tensors(*batch):
        if min(images.shape[1:3]) >= least:
            for row, result in zip(rows, compute(images), strict=True):
                results[row] = result
    return results


def edge_maps(height: Column, width: Column, channels: Column, data: Column) -> Column:
    """The three edge maps, row by row; null fields for pixels that do not fit the shape."""

    @F.pandas_udf(EDGE_MAPS)
    def apply(h: pd.Series, w: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        def maps(images: np.ndarray) -> list[tuple]:
            return list(zip(*[list(edge.reshape(len(images), -1)) for edge in _edges(_gray(images))], strict=True))

        rows = _per_image(maps, [None] * len(KERNELS), 3, (h, w, c, d))
        return pd.DataFrame(rows, columns=list(KERNELS))

    return apply(height, width, channels, data)


def color_histograms(height: Column, width: Column, channels: Column, data: Column) -> Column:
    """96 counts: 32 bins each of blue, green and red."""

    @F.pandas_udf("array<double>")
    def apply(h: pd.Series, w: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_per_image(_histograms, None, 1, (h, w, c, d)))

    return apply(height, width, channels, data)


def texture_stats(height: Column, width: Column, channels: Column, data: Column) -> Column:
    """Edge means, deviations and peaks, and gray-level statistics."""

    @F.pandas_udf(TEXTURE_STATS)
    def apply(h: pd.Series, w: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        rows = _per_image(_texture, [None] * len(TEXTURE_FIELDS), 3, (h, w, c, d))
        return pd.DataFrame(rows, columns=list(TEXTURE_FIELDS))

    return apply(height, width, channels, data)


def frame_features(height: Column, width: Column, channels: Column, data: Column) -> Column:
    """Histograms, texture and intensity in one vector of 512 floats; zeros for a bad image."""

    @F.pandas_udf("array<float>")
    def apply(h: pd.Series, w: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        zeros = np.zeros(FEATURE_DIM, dtype=np.float32)
        return pd.Series(_per_image(_features, zeros, 3, (h, w, c, d)))

    return apply(height, width, channels, data)
