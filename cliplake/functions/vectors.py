"""Arithmetic on feature arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

FEATURE_DIM = 512


def as_doubles(values: Column) -> Column:
    return values.cast("array<double>")


def pad_vector(values: Column, length: int = FEATURE_DIM) -> Column:
    """Cut or zero-fill an array to a fixed length."""
    zeros = F.array_repeat(F.lit(0.0), length)
    return F.slice(F.concat(as_doubles(values), zeros), 1, length)


def _sum_vectors(vectors: Column) -> Column:
    return F.aggregate(
        F.slice(vectors, 2, F.greatest(F.size(vectors) - 1, F.lit(0))),
        F.get(vectors, F.lit(0)),
        lambda total, vector: F.zip_with(total, vector, lambda a, b: a + b),
    )


def moving_average(window: Column, length: int = FEATURE_DIM) -> Column:
    """Element-wise mean of the vectors in a window; zeros when there are none."""
    count = F.size(window)
    return F.when(
        count > 0, F.transform(_sum_vectors(window), lambda total: total / count)
    ).otherwise(F.array_repeat(F.lit(0.0), length))


def gaussian_smooth(window: Column, sigma: float = 1.0, length: int = FEATURE_DIM) -> Column:
    """Weighted mean of a three-row window; shorter windows give their middle row."""
    side = math.exp(-1.0 / (2.0 * sigma * sigma))
    total = 1.0 + 2.0 * side
    before, here, after = (F.get(window, F.lit(i)) for i in range(3))
    neighbours = F.zip_with(before, after, lambda a, b: (a + b) * F.lit(side / total))
    smoothed = F.zip_with(neighbours, here, lambda n, x: n + x * F.lit(1.0 / total))
    middle = F.get(window, F.floor(F.size(window) / 2).cast("int"))
    return (
        F.when(F.size(window) >= 3, smoothed)
        .when(F.size(window) > 0, middle)
        .otherwise(F.array_repeat(F.lit(0.0), length))
    )


def euclid_distance(left: Column, right: Column) -> Column:
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, square: total + square))
