"""Catalogue operators: manifest, listing, probe records, quality and the cleaning funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake import schemas
from cliplake.functions import paths, quality
from cliplake.params import QualityParams

# The watch address, and the cycles of the sample manifest.
WATCH_URL = "https://www.youtube.com/watch?v="
SAMPLE_IDS = ("dQw4w9WgXcQ", "9bZkp7q19f0", "kJQP7kiw5Fk", "tgbNymZ7vqY")
SAMPLE_CATEGORIES = ("cooking", "crafts", "technology", "gardening")


def parse_manifest(lines: DataFrame, index: str = "idx", line: str = "line") -> DataFrame:
    """Positional fields of unquoted comma-separated lines.

    Trailing empty fields count as absent and take the default, an empty middle field stays
    empty.  A duration that is no number gives 0.0 and fills ``error`` for that row only.
    """
    fields = F.split(F.regexp_replace(line, ",+$", ""), ",")

    def field(position: int, default: Column) -> Column:
        return F.when(F.size(fields) > position, F.get(fields, F.lit(position))).otherwise(default)

    raw_duration = field(3, F.lit("0.0"))
    duration = raw_duration.try_cast("double")
    return lines.select(
        F.col(index).alias("idx"),
        field(0, F.lit("")).alias("video_id"),
        F.concat(F.lit(WATCH_URL), field(0, F.lit(""))).alias("url"),
        field(1, F.concat(F.lit("Video_"), F.col(index))).alias("title"),
        field(2, F.lit("general")).alias("category"),
        F.coalesce(duration, F.lit(0.0)).alias("duration"),
        F.when(duration.isNull(), F.concat(F.lit("bad duration: "), raw_duration)).alias("error"),
    )


def sample_manifest(rows: DataFrame, index: str = "idx") -> DataFrame:
    """Made-up manifest rows, one per input row, that cycle through fixed ids and categories."""
    i = F.col(index)

    def cycle(values: tuple[str, ...]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))

    return rows.select(
        i.alias("idx"),
        F.concat(cycle(SAMPLE_IDS), F.lit("_"), i).alias("video_id"),
        F.concat(F.lit(WATCH_URL), cycle(SAMPLE_IDS)).alias("url"),
        F.concat(F.lit("HowTo Video "), i).alias("title"),
        cycle(SAMPLE_CATEGORIES).alias("category"),
        (i * 30 + 60.0).alias("duration"),
    )


def media_listing(files: DataFrame) -> DataFrame:
    """Listing records of the media files among (path, length) rows."""
    name = paths.basename(F.col("path"))
    return files.where(paths.has_media_extension(name)).select(
        paths.strip_extension(name).alias("video_id"),
        "path",
        F.col("length").alias("file_size"),
        (F.col("length") > 0).alias("is_valid"),
        F.when(F.col("length") == 0, "Empty file").alias("error_message"),
    )


def probe_defaults() -> dict[str, Column]:
    """Fields of the probe record of files that were not or could not be probed."""
    return {
        "duration": F.lit(0.0),
        "resolution": F.lit("unknown"),
        "fps": F.lit(0.0),
        "codec": F.lit("unknown"),
        "bitrate": F.lit(0).cast("bigint"),
        "has_audio": F.lit(False),
    }


def invalid_status() -> Column:
    """Status of an invalid file of a listing."""
    return F.concat(F.lit("invalid: "), F.coalesce("error_message", F.lit("unknown error")))


def invalid_defaults(listing: DataFrame) -> DataFrame:
    """Default probe records of the invalid files, with the reason in the status."""
    fields = [value.alias(name) for name, value in probe_defaults().items()]
    status = invalid_status().alias("processing_status")
    return listing.where(~F.col("is_valid")).select("video_id", "path", *fields, "file_size", status)


def pending(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows whose file is not there yet."""
    return manifest.join(listing, "video_id", "left_anti")


def present(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    return manifest.join(listing, "video_id", "left_semi")


def _frame_rate(text: Column) -> tuple[Column, Column]:
    """Value and failure flag of an ``n/d`` frame rate; 0.0 without two parts or for d = 0.

    Closing slashes do not count as parts.
    """
    parts = F.split(F.regexp_replace(text, "/+$", ""), "/")
    top = F.get(parts, F.lit(0)).try_cast("double")
    bottom = F.get(parts, F.lit(1)).try_cast("int")
    two_parts = F.size(parts) == 2
    value = F.when(two_parts & (bottom != 0), top / bottom.cast("double")).otherwise(0.0)
    failed = two_parts & (bottom.isNull() | ((bottom != 0) & top.isNull()))
    return value, failed


def parse_probe(df: DataFrame, probe: str = "probe") -> DataFrame:
    """Typed columns of probe JSON: the first video stream, any audio stream, defaults.

    Text that is not one whole JSON object of this shape, or a number that does not parse or fit,
    gives the default values and the status ``parse_error``; other rows get ``parsed``.
    """
    # The parser keeps what it could read of broken text and puts the text into this field.
    options = {"columnNameOfCorruptRecord": "_broken"}
    body = F.regexp_replace(probe, r"^\s+|\s+$", "")
    parsed = df.withColumn("_p", F.from_json(body, schemas.PROBE_JSON, options))
    streams = F.coalesce("_p.streams", F.array())
    parsed = parsed.withColumn(
        "_v", F.get(F.filter(streams, lambda s: s["codec_type"] == "video"), F.lit(0))
    )
    duration_text, bitrate_text = F.col("_p.format.duration"), F.col("_p.format.bit_rate")
    duration = duration_text.try_cast("double")
    bitrate = bitrate_text.try_cast("bigint")
    fps, bad_fps = _frame_rate(F.coalesce("_v.r_frame_rate", F.lit("0/1")))
    is_object = F.coalesce(body.startswith("{") & body.endswith("}"), F.lit(False))

    def bad_side(name: str) -> Column:
        given = F.col(f"_v.{name}")
        whole = given.try_cast("double").try_cast("int")
        return F.coalesce(given.isNotNull() & whole.isNull(), F.lit(False))

    failed = (
        ~is_object
        | F.col("_p").isNull()
        | F.col("_p._broken").isNotNull()
        | bad_side("width")
        | bad_side("height")
        | (duration_text.isNotNull() & duration.isNull())
        | (bitrate_text.isNotNull() & bitrate.isNull())
        | F.coalesce(bad_fps, F.lit(False))
    )

    def side(name: str) -> Column:
        return F.coalesce(F.col(f"_v.{name}").try_cast("double").try_cast("int"), F.lit(0))

    def unless_failed(value: Column, default) -> Column:
        return F.when(failed, F.lit(default)).otherwise(F.coalesce(value, F.lit(default)))

    return parsed.select(
        *df.columns,
        unless_failed(duration, 0.0).alias("duration"),
        unless_failed(F.concat_ws("x", side("width"), side("height")), "unknown").alias(
            "resolution"
        ),
        unless_failed(fps, 0.0).alias("fps"),
        unless_failed(F.col("_v.codec_name"), "unknown").alias("codec"),
        unless_failed(bitrate, 0).cast("bigint").alias("bitrate"),
        unless_failed(F.exists(streams, lambda s: s["codec_type"] == "audio"), False).alias(
            "has_audio"
        ),
        F.when(failed, "parse_error").otherwise("parsed").alias("processing_status"),
    )


def with_score(probe: DataFrame) -> DataFrame:
    return probe.withColumn(
        "quality_score",
        quality.quality_score(
            F.col("duration"), F.col("resolution"), F.col("fps"), F.col("bitrate")
        ),
    )


def with_checks(scored: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Add the quality level, one flag per check and the flag of all checks."""
    flags = {
        "is_valid_duration": quality.is_valid_duration(F.col("duration"), params),
        "is_valid_resolution": quality.is_valid_resolution(F.col("resolution")),
        "is_valid_fps": quality.is_valid_fps(F.col("fps"), params),
    }
    checked = scored.withColumns(
        {"quality_level": quality.quality_level(F.col("quality_score"), params), **flags}
    )
    return checked.withColumn(
        "passes_all_checks",
        F.col("is_valid_duration") & F.col("is_valid_resolution") & F.col("is_valid_fps"),
    )


def dedup(df: DataFrame, key: str = "video_id", order: str = "path") -> DataFrame:
    """Keep the first row of each key.

    The rank filter lets Spark keep one row per key in every task before the shuffle, so a key
    with very many copies costs no more than the others.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def cleaned(checked: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Rows left by the funnel: success, all checks, one per video, minimum score."""
    passed = checked.where((F.col("processing_status") == "success") & F.col("passes_all_checks"))
    return dedup(passed).where(F.col("quality_score") >= params.low)


def cleaning_funnel(checked: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Row counts after each cleaning step, and the whole percentage kept.

    One scan and one shuffle: the steps are counted per video with map-side partial sums, and
    the score of the row that deduplication keeps is the first by path.
    """
    valid = F.col("processing_status") == "success"
    passed = valid & F.col("passes_all_checks")
    kept = F.min(F.when(passed, F.struct("path", "quality_score")))
    per_video = checked.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(passed).alias("passed"),
        kept.alias("kept"),
    )
    counts = per_video.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("quality"),
        F.count("kept").alias("deduplicated"),
        F.count_if(F.col("kept.quality_score") >= params.low).alias("final"),
    )
    percent = F.floor(F.col("final").cast("double") / F.col("total") * 100)
    return counts.withColumn(
        "retention_percent", F.when(F.col("total") > 0, percent).otherwise(0).cast("bigint")
    )
