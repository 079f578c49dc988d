"""Media tables derived from the test tables, which hold no media of their own."""

from __future__ import annotations

import io
import struct
import wave
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import times
from cliplake.operators import cluster, ordered, series
from cliplake.runtime import staged
from cliplake.sources import files

HOST = "hdfs://host:9000"
FRAME_KEY = ["video_name", "frame_number"]
SAMPLE_RATE = 400
CLIP_SAMPLES = 64
SHEET_IMAGES = 16384
TILE_BYTES = 72


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(number: Column, values: list, otherwise) -> Column:
    """The value at the given position of a list, or ``otherwise`` beyond it."""
    chain = F.when(number == 0, values[0])
    for position, value in enumerate(values[1:], 1):
        chain = chain.when(number == position, value)
    return chain.otherwise(otherwise)


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest lines of one to four fields, some with an empty middle field."""
    part = table(spark, sf_dir, "part")
    key = F.concat(F.lit("v"), F.col("p_partkey"))

    def line(*fields: Column | str) -> Column:
        return F.concat_ws(",", key, *[F.lit(f) if isinstance(f, str) else f for f in fields])

    name, kind = F.col("p_name"), F.col("p_type")
    lines = [line(), line(name), line(name, kind), line("", kind)]
    longest = F.concat(line(name, kind, F.col("p_size").cast("string")), F.lit(".5"))
    return part.select(
        F.col("p_partkey").alias("line_no"),
        _cases(F.col("p_partkey") % 5, lines, longest).alias("line"),
    )


def media_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File listing with every kind of extension, tier folders and empty files."""
    pages = table(spark, sf_dir, "pages")
    page_id = F.col("page_id")
    folder = _cases(page_id % 4, ["high_quality", "medium_quality", "low_quality"], "raw")
    suffix = _cases(
        page_id % 9,
        [".mp4", ".avi", ".mov", ".MKV", ".flv", ".webm", ".txt", ".part.mp4"],
        "",
    )
    return pages.select(
        "page_id",
        F.concat(F.lit(f"{HOST}/user/"), folder, F.lit("/clip_"), page_id, suffix).alias("path"),
        F.when(page_id % 10 == 0, 0)
        .otherwise(F.length("html").cast("bigint") * 4099)
        .alias("length"),
    )


def probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe records, about ten per video."""
    key = F.col("o_orderkey")
    resolutions = ["1920x1080", "1280x720", "640x480", "854x480", "320x240", "0x0"]
    rates = [0.0, 10.0, 15.0, 24.0, 29.97, 60.0, 120.0]
    no_bits = F.lit(0).cast("bigint")
    bits = [key * 7919 % 9000000, key * 131 % 500000]
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("video_id"),
        F.concat(F.lit("/user/raw/"), key, F.lit(".mp4")).alias("path"),
        (key * 37 % 4000).cast("double").alias("duration"),
        _cases(key % 7, resolutions, "unknown").alias("resolution"),
        _cases(key % 8, rates, 144.0).alias("fps"),
        _cases(key % 4, ["h264", "vp9", "hevc"], "unknown").alias("codec"),
        _cases(key % 3, bits, no_bits).alias("bitrate"),
        (key % 2 == 0).alias("has_audio"),
        (key * 1009).alias("file_size"),
        F.when(F.col("o_orderstatus") == "P", "error: x")
        .otherwise("success")
        .alias("processing_status"),
    )


def _probe_text() -> Column:
    """Probe output of a probe record as text: valid, malformed, without streams, with bad numbers."""
    size = F.col("file_size")
    rate = _cases(size % 4, ["30000/1001", "25/1", "0/0"], "24")
    sound = F.when(F.col("has_audio"), '{"codec_type":"audio","codec_name":"aac"},').otherwise("")
    whole = F.format_string(
        '{"format":{"duration":"%s","bit_rate":"%s"},"streams":[%s{"codec_type":"video",'
        '"codec_name":"%s","width":%s,"height":480,"r_frame_rate":"%s"}]}',
        F.col("duration").cast("string"),
        F.col("bitrate").cast("string"),
        sound,
        F.col("codec"),
        (640 + size % 3).cast("string"),
        rate,
    )
    odd = [
        "not json",
        '{"streams":[]}',
        '{"format":{"duration":"N/A"},"streams":[]}',
        '{"format":{"duration":"5.5"',
        '{"format":',
        "{not json}",
        F.concat(whole, F.lit(" garbage")),
        '{"format":{"duration":"5.5"},"streams":"none"}',
        F.replace(whole, F.lit('"height":480'), F.lit('"height":"abc"')),
        F.replace(whole, F.lit('"height":480'), F.lit('"height":99999999999')),
        F.concat(F.lit("\n\t "), whole, F.lit("\n")),
    ]
    return _cases(size % 29, odd, whole)


def probe_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path and probe output of every probe record."""
    rows = probe(spark, sf_dir).select("path", _probe_text().alias("probe"))
    return files.spread(rows, f"{sf_dir}/orders.parquet", "path")


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe records with a path that ends in their video, so that videos have several files."""
    number = F.expr("file_size div 1009")
    path = F.concat(F.lit("/user/raw/"), number, F.lit("/"), "video_id", F.lit(".mp4"))
    return probe(spark, sf_dir).withColumn("path", path).withColumn("number", number)


def catalogue_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path and length of files to catalogue; every eleventh is empty."""
    length = F.when(F.col("number") % 11 == 0, 0).otherwise(F.col("file_size")).cast("bigint")
    return _catalogue(spark, sf_dir).select("path", length.alias("length"))


def catalogue_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe outputs of these files; every thirteenth file has none."""
    probed = _catalogue(spark, sf_dir).where("number % 13 <> 0")
    return probed.select("path", _probe_text().alias("probe"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of all documents; for every fifth a further row, placeholder or empty.

    The further rows have ids of their own, below zero.
    """
    doc_id, chars = F.col("doc_id"), F.col("n_chars")
    label = F.concat(
        F.lit("[Audio contains approximately "), chars % 17, F.lit(" speech segments]")
    )
    real = F.struct(doc_id.alias("doc_id"), F.col("text").alias("transcript"))
    filler = F.when(doc_id % 10 == 0, label).otherwise("")
    further = F.when(
        doc_id % 10 < 2, F.struct((-1 - doc_id).alias("doc_id"), filler.alias("transcript"))
    )
    both = F.explode(F.array_compact(F.array(real, further))).alias("row")
    rows = table(spark, sf_dir, "documents").select("n_chars", both).select("row.*", "n_chars")
    rows = rows.select(
        "doc_id",
        F.concat(F.lit(f"{HOST}/user/audio_files/video_"), doc_id, F.lit(".wav")).alias("filename"),
        "transcript",
        (chars % 17).cast("int").alias("num_segments"),
        (chars / F.lit(15.0)).alias("duration"),
    )
    return files.spread(rows, f"{sf_dir}/documents.parquet", "doc_id")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame rows, one video per label, with a given cluster each."""
    vector_table = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("video_"), F.col("label"), F.lit(".mp4")).alias("video_name"),
        "vec_id",
        (F.col("vec_id") * 7 % 25).alias("cluster"),
        F.col("embedding").alias("features"),
    )
    return series.frame_index(
        vector_table, "video_name", ["vec_id"], ordered.slice_of(F.col("vec_id"))
    )


def keyframes_det(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame nearest to the mean of each given cluster, as a written table."""
    distances = cluster.distance_to_mean(frames(spark, sf_dir), FRAME_KEY)
    chosen = cluster.select_keyframes(distances)
    return staged(chosen.drop("features"), "keyframes")


def gray_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 gray pixels, one image per vector."""
    return _images(spark, sf_dir, lambda level: [level])


def color_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 pixels of blue, green and red, one image per vector."""
    return _images(spark, sf_dir, lambda level: [level, 255 - level, level * 2 % 256])


def _images(
    spark: SparkSession, sf_dir: str, channels: Callable[[Column], list[Column]]
) -> DataFrame:
    def pixel(x: Column) -> Column:
        level = F.floor((x.cast("double") + 1) * 127.5)
        return F.concat(*[F.lpad(F.hex(value), 2, "0") for value in channels(level)])

    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(len(channels(F.lit(0)))).alias("channels"),
        F.unhex(F.array_join(F.transform("embedding", pixel), "")).alias("data"),
    )


def image_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG sheets of at most 16384 gray images, one below the other.

    A line of eight pixels above each image holds its vec_id.
    """
    tile = F.concat(F.lpad(F.hex("vec_id"), 16, "0"), F.hex("data"))
    tiles = F.transform(
        F.sort_array(F.collect_list(F.struct("vec_id", tile.alias("tile")))), lambda t: t["tile"]
    )
    sheets = (
        gray_images(spark, sf_dir)
        .groupBy(ordered.slice_of(F.col("vec_id"), SHEET_IMAGES).alias("sheet"))
        .agg(F.unhex(F.array_join(tiles, "")).alias("data"))
    )
    lines = F.floor(F.length("data") / 8).cast("int")
    return sheets.select("sheet", png_bytes(lines, F.lit(8), F.col("data")).alias("content"))


def png_bytes(height: Column, width: Column, data: Column) -> Column:
    """Gray pixels as PNG file content."""

    @F.pandas_udf("binary")
    def apply(heights: pd.Series, widths: pd.Series, pixels: pd.Series) -> pd.Series:
        return pd.Series([_png(*row) for row in zip(heights, widths, pixels)])

    return apply(height, width, data)


def _png(height: int, width: int, pixels: bytes) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        check = zlib.crc32(kind + body)
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", check)

    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    rows = b"".join(b"\0" + pixels[at * width : (at + 1) * width] for at in range(height))
    start = b"\x89PNG\r\n\x1a\n"
    body = chunk(b"IDAT", zlib.compress(rows))
    return start + chunk(b"IHDR", header) + body + chunk(b"IEND", b"")


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered samples, one clip per user."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("clip"), "ts", "event_id", F.col("value").alias("x")
    )
    numbered = ordered.number_rows(
        events, ["clip"], ["ts", "event_id"], times.epoch_minutes(F.col("ts")), "i"
    )
    return numbered.select("clip", "i", "x")


def wav_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WAV files of at most 64 samples cut from the signal of each user, 16 bit, one channel.

    Samples are scaled by 64, or by less where the loudest of the table would not fit.
    """
    loudest = F.max(F.abs("value"))
    scale = F.least(F.lit(64.0), F.floor(32767 / F.greatest(loudest, F.lit(1.0))).cast("double"))
    known = table(spark, sf_dir, "events").agg(scale).first()[0] or 64.0
    level = F.floor(F.col("x") * F.lit(known)).cast("smallint")
    cut = signal(spark, sf_dir).withColumn("part", ordered.slice_of(F.col("i"), CLIP_SAMPLES))
    samples = F.transform(
        F.sort_array(F.collect_list(F.struct("i", level.alias("level")))), lambda s: s["level"]
    )
    return (
        cut.groupBy("clip", "part")
        .agg(samples.alias("levels"))
        .select("clip", "part", wav_bytes(F.col("levels")).alias("content"))
    )


def wav_bytes(levels: Column, rate: int = SAMPLE_RATE) -> Column:
    """16-bit levels as WAV file content."""

    @F.pandas_udf("binary")
    def apply(clips: pd.Series) -> pd.Series:
        return pd.Series([_wav(clip, rate) for clip in clips])

    return apply(levels)


def _wav(levels: np.ndarray, rate: int) -> bytes:
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as clip:
        clip.setnchannels(1)
        clip.setsampwidth(2)
        clip.setframerate(rate)
        clip.writeframes(np.asarray(levels, dtype="<i2").tobytes())
    return buffer.getvalue()
