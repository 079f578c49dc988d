"""Time-series operators: smoothing windows, framing, sampling and speech segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake.functions import vectors
from cliplake.operators import ordered
from cliplake.params import ROWS_PER_SLICE
from cliplake.runtime import staged


def frame_index(
    df: DataFrame, key: str, order: list[str], slice_id: Column, step_seconds: float = 1.0
) -> DataFrame:
    """Number the frames of each video from 0 and time them at a fixed rate."""
    numbered = ordered.number_rows(df, [key], order, slice_id, "frame_number")
    return numbered.withColumn("timestamp", F.col("frame_number") * F.lit(float(step_seconds)))


def window_collect(
    frames: DataFrame,
    features: str = "features",
    key: str = "video_name",
    partitions: int | None = None,
) -> DataFrame:
    """Collect the features of the frame before, the frame and the frame after.

    The first and last frame of a video get two vectors, a single frame gets one.  ``partitions``
    is the number of ranges that frames are dealt to, else as many as shuffles have.
    """
    order = ["timestamp", "frame_number"]
    narrow = frames.withColumn(features, vectors.as_doubles(F.col(features)))
    with_edges = ordered.with_edge_rows(narrow, [key], order, partitions)
    centred = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(-1, 1)
    collected = with_edges.withColumn(
        "features_in_window", F.collect_list(features).over(centred)
    )
    return collected.where(~F.col("_copied")).drop("_range", "_copied")


def smooth(frames: DataFrame, features: str = "features", sigma: float = 1.0) -> DataFrame:
    """Add the moving average and the Gaussian mean over the centred three-row window."""
    window = F.col("features_in_window")
    return window_collect(frames, features).select(
        "*",
        vectors.moving_average(window).alias("smoothed_features"),
        vectors.gaussian_smooth(window, sigma).alias("gaussian_smoothed_features"),
    )


def pre_emphasis(
    signal: DataFrame, factor: float = 0.97, slice_rows: int = ROWS_PER_SLICE
) -> DataFrame:
    """y[i] = x[i] - factor * x[i-1] along each clip; the first sample is kept."""
    copied = ordered.with_previous_row(signal.select("clip", "i", "x"), "i", slice_rows)
    before = F.lag("x").over(ordered.slice_window(["clip"], ["i"]))
    emphasised = copied.withColumn("y", F.col("x") - factor * F.coalesce(before, F.lit(0.0)))
    return emphasised.where(~F.col("_copied")).select("clip", "i", "y")


def overlap_frames(
    signal: DataFrame, size: int, hop: int, slice_rows: int = ROWS_PER_SLICE
) -> DataFrame:
    """Give every sample once per overlapping frame it falls in.

    Clips count as zero-padded to a whole number of hops, and only frames that fit in the padded
    clip exist.  Rows: clip, frame, offset in the frame, x.  Padding adds no rows.
    """
    measured = ordered.group_aggregate(
        signal.select("clip", "i", "x"),
        ["clip"],
        ordered.slice_of(F.col("i"), slice_rows),
        {"_last": F.max("i")},
        {"samples": lambda clip: F.max("_last").over(clip) + 1},
    )
    padded = F.ceil(F.col("samples") / hop) * hop
    frame_count = F.floor((padded - size) / hop) + 1
    first = F.greatest(F.ceil((F.col("i") - (size - 1)) / hop), F.lit(0).cast("bigint"))
    last = F.least(F.floor(F.col("i") / hop), frame_count - 1)
    frame_ids = F.when(first <= last, F.sequence(first, last))
    return measured.select("clip", "i", "x", F.explode(frame_ids).alias("frame")).select(
        "clip", "frame", (F.col("i") - F.col("frame") * hop).alias("offset"), "x"
    )


def frame_energy(framed: DataFrame) -> DataFrame:
    return framed.groupBy("clip", "frame").agg(
        F.count(F.lit(1)).alias("samples"), F.sum(F.col("x") * F.col("x")).alias("energy")
    )


def speech_mask(
    energies: DataFrame, ratio: float = 0.5, slice_rows: int = ROWS_PER_SLICE
) -> DataFrame:
    """Mark the frames whose energy is above ``ratio`` times the mean energy of their clip."""
    measured = ordered.group_aggregate(
        energies,
        ["clip"],
        ordered.slice_of(F.col("frame"), slice_rows),
        {"_energy": F.sum("energy"), "_frames": F.count(F.lit(1))},
        {
            "threshold": lambda clip: F.sum("_energy").over(clip)
            / F.sum("_frames").over(clip)
            * ratio
        },
    )
    return measured.withColumn("speech", F.col("energy") > F.col("threshold"))


def segments(mask: DataFrame, slice_rows: int = ROWS_PER_SLICE) -> DataFrame:
    """Runs of speech frames per clip as half-open [start, end) frame ranges.

    Runs are found inside slices of a clip.  Only those at the edge of a slice, two per slice at
    most, are looked at per whole clip to join what a slice boundary has cut.
    """
    inside = ordered.slice_window(["clip"], ["frame"])
    before = F.lag("speech").over(inside)
    opens = F.col("speech") & ~F.coalesce(before, F.lit(False))
    runs = (
        mask.select("clip", "frame", "speech")
        .withColumn("_slice", ordered.slice_of(F.col("frame"), slice_rows))
        .withColumn("_opens", opens.cast("int"))
        .withColumn("_first", before.isNull())
        .withColumn("_last", F.lead("speech").over(inside).isNull())
        .withColumn("_run", F.sum("_opens").over(inside))
        .where("speech")
        .groupBy("clip", "_slice", "_run")
        .agg(
            F.min("frame").alias("start"),
            (F.max("frame") + 1).alias("end"),
            F.bool_or(F.col("_first") | F.col("_last")).alias("_edge"),
        )
    )
    along = Window.partitionBy("clip").orderBy("start")
    cut = F.col("start") == F.lag("end").over(along)
    joined = (
        runs.where("_edge")
        .withColumn("_new", (~F.coalesce(cut, F.lit(False))).cast("int"))
        .withColumn("_run", F.sum("_new").over(along))
        .groupBy("clip", "_run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    whole = runs.where(~F.col("_edge"))
    return whole.select("clip", "start", "end").unionByName(joined.select("clip", "start", "end"))


def sample_per_bucket(
    df: DataFrame, keys: list[str], bucket: Column, order: list[str], name: str = "bucket"
) -> DataFrame:
    """Keep the first row of each key in each time bucket."""
    rest = [column for column in df.columns if column not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys, bucket.alias(name)).agg(first).select(*keys, name, "row.*")


def clip_records(signal: DataFrame, sample_rate: int, size: int, hop: int) -> DataFrame:
    """Segment count, duration and placeholder transcript per clip, from frame energies.

    A clip shorter than one frame gets an error transcript and zeros.
    """
    lengths = signal.groupBy("clip").agg(F.count(F.lit(1)).alias("samples"))
    energies = staged(frame_energy(overlap_frames(signal, size, hop)), "energies")
    mask = speech_mask(energies)
    found = segments(mask).groupBy("clip").agg(F.count(F.lit(1)).alias("found"))
    count = F.coalesce("found", F.lit(0))
    too_short = F.ceil(F.col("samples") / hop) * hop < size
    label = F.concat(F.lit("[Audio contains approximately "), count, F.lit(" speech segments]"))
    return lengths.join(found, "clip", "left").select(
        "clip",
        count.alias("num_segments"),
        F.when(too_short, 0.0).otherwise(F.col("samples") / sample_rate).alias("duration"),
        F.when(too_short, "[Transcription error: clip shorter than one frame]")
        .otherwise(label)
        .alias("transcript"),
    )
