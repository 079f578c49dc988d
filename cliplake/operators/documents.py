"""Per-video documents: nested joins, lookups, upsert and final summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions import paths
from cliplake.operators import cluster
from cliplake.runtime import Scratch

# Keyframes listed in one document; longer lists go on in the next part.
DETAILS_PER_DOCUMENT = 10000
SECONDS_PER_KEYFRAME = 2


def with_lineage(df: DataFrame, processed_at: datetime, data_type: str) -> DataFrame:
    """Add when and as what the rows were processed."""
    return df.withColumns(
        {
            "processing_timestamp": F.lit(processed_at.isoformat(" ")).cast("timestamp_ntz"),
            "data_type": F.lit(data_type),
        }
    )


def video_facts(
    keyframes: DataFrame,
    text_results: DataFrame,
    processed_at: datetime,
    version: str = "1.0",
    pipeline: str = "files -> Spark -> documents",
) -> DataFrame:
    """One row per video: its number of keyframes and its text results, matched by file name."""
    counted = keyframes.groupBy("video_name").agg(F.count(F.lit(1)).alias("num_keyframes"))
    texts = text_results.select(
        paths.video_name_of_audio(paths.basename(F.col("filename"))).alias("video_name"),
        "transcript",
        "summary",
        "sentiment",
        "keywords",
        "duration",
    )
    return counted.join(texts, "video_name", "left").select(
        "*",
        F.lit(processed_at.isoformat(" ")).cast("timestamp_ntz").alias("processing_timestamp"),
        F.lit(version).alias("summary_version"),
        F.lit(pipeline).alias("processing_pipeline"),
    )


def video_parts(keyframes: DataFrame, details_per_document: int = DETAILS_PER_DOCUMENT) -> DataFrame:
    """The keyframes of each video in time, nested in parts of bounded size."""
    details = F.sort_array(F.collect_list(F.struct("frame_number", "timestamp", "cluster")))
    return (
        cluster.in_parts(keyframes, details_per_document)
        .groupBy("video_name", "part")
        .agg(details.alias("keyframe_details"))
    )


def joined_documents(
    facts: DataFrame, parts: DataFrame, details_per_document: int = DETAILS_PER_DOCUMENT
) -> DataFrame:
    """Documents from the facts of videos and their parts.

    The facts are repeated for the parts that their count gives, so both sides meet by (video, part):
    nested lists stay where their part was collected, and no video gathers all of its parts.
    """
    last = F.floor((F.col("num_keyframes") - 1) / details_per_document)
    for_each = facts.withColumnRenamed("video_name", "_video").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    )
    rest = [column for column in facts.columns if column not in ("video_name", "num_keyframes")]
    # Rows without a video name are one video of their own.
    same = F.col("video_name").eqNullSafe(F.col("_video")) & (F.col("part") == F.col("_part"))
    return parts.join(for_each, same).select(
        "video_name", "part", "num_keyframes", "keyframe_details", *rest
    )


def video_documents(
    keyframes: DataFrame,
    text_results: DataFrame,
    processed_at: datetime,
    version: str = "1.0",
    pipeline: str = "files -> Spark -> documents",
    details_per_document: int = DETAILS_PER_DOCUMENT,
) -> DataFrame:
    """One document per video with its keyframes nested, and its text results when there are any.

    A video with more keyframes than fit in one document continues in documents with ``part`` 1, 2,
    ...  ``keyframes`` is read twice, give a written table.
    """
    facts = video_facts(keyframes, text_results, processed_at, version, pipeline)
    return joined_documents(facts, video_parts(keyframes, details_per_document), details_per_document)


def _grams(text: str, size: int) -> Column:
    """All different substrings of this size; of shorter texts none."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    cut = F.transform(starts, lambda start: F.substring(F.col(text), start, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def contains_candidates(stems: DataFrame, texts: DataFrame, size: int = 4) -> DataFrame:
    """(_stem, _text) pairs that may hold: both have the stem's rarest substring of ``size``
    characters (of a shorter stem, the stem itself).

    ``stems`` and ``texts`` have one column each, ``_stem`` and ``_text``.  Texts are cut only into
    the sizes that stems ask for, and counted only for substrings that a stem has.
    """
    short = F.when(F.length("_stem") < size, F.length("_stem")).otherwise(size)
    sized = stems.where(F.length("_stem") > 0).withColumn("_size", short)
    every = range(1, size + 1)
    of_stem = F.coalesce(*[F.when(F.col("_size") == n, _grams("_stem", n)) for n in every])
    asked = sized.withColumn("_gram", F.explode(of_stem))
    sizes = sized.agg(F.collect_set("_size")).scalar()
    of_text = F.flatten(F.array(*[F.when(F.array_contains("_sizes", n), _grams("_text", n)).otherwise(F.array().cast("array<string>")) for n in every]))
    cut = texts.withColumn("_sizes", sizes).select("_text", F.explode(of_text).alias("_gram"))
    # Only substrings of stems go on.
    held = cut.join(asked.select("_gram").distinct(), "_gram", "left_semi")
    counts = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
    # A stem with a substring that no text has can be left out: nothing contains it.
    rarest = (
        asked.join(counts, "_gram", "left")
        .groupBy("_stem")
        .agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("texts"), "_gram")).alias("_rare"))
        .where("_rare.texts > 0")
        .select("_stem", F.col("_rare._gram").alias("_gram"))
    )
    return held.join(rarest, "_gram").select("_stem", "_text")


def contains_lookup(left: DataFrame, stem: str, right: DataFrame, text: str) -> DataFrame:
    """First row of ``right`` (by ``text``) whose text contains the stem; nulls when none does.

    Instead of comparing every pair, stems meet the texts that have their rarest substring of a few
    characters, and those pairs are verified.  Only texts go through this, written once; the first
    text per stem is kept, with a partial minimum before the shuffle, and then brings its row.  An
    empty stem is in every text.
    """
    scratch = Scratch(left.sparkSession)
    stems = scratch.staged(left.select(F.col(stem).alias("_stem")).where("_stem is not null").distinct(), "stems")
    texts = scratch.staged(right.select(F.col(text).alias("_text")).where("_text is not null").distinct(), "texts")
    pairs = contains_candidates(stems, texts).where(F.contains("_text", "_stem"))
    first = pairs.groupBy("_stem").agg(F.min("_text").alias("_text"))
    least = texts.agg(F.min("_text")).scalar()
    empty = stems.where("_stem = ''").withColumn("_text", least)
    first = scratch.staged(first.unionByName(empty), "first")
    rows = (
        right.withColumn("_text", F.col(text))
        .join(first.select("_text").distinct(), "_text", "left_semi")
        .groupBy("_text")
        .agg(F.min(F.struct(*right.columns)).alias("_row"))
    )
    found = first.join(rows, "_text").select("_stem", "_row.*")
    return left.join(found, left[stem] == found["_stem"], "left").drop("_stem")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` with the fields ``new`` brings for the same key, plus the unseen keys.

    A field that ``new`` does not have survives; a field it has wins even when it is null.
    """
    fields = [column for column in old.columns if column != key]
    fields += [column for column in new.columns if column != key and column not in fields]
    left = old.select(F.col(key), F.struct(*old.columns).alias("_old"))
    right = new.select(F.col(key), F.struct(*new.columns).alias("_new"))

    def merged(name: str) -> Column:
        if name not in new.columns:
            return F.col(f"_old.{name}")
        if name not in old.columns:
            return F.col(f"_new.{name}")
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(
            F.col(f"_old.{name}")
        )

    joined = left.join(right, key, "full_outer")
    return joined.select(key, *[merged(name).alias(name) for name in fields])


def final_summaries(
    keyframes: DataFrame, text_results: DataFrame, folder: str = "/summaries"
) -> DataFrame:
    """Playback facts per video, with the text results of the first audio file named like it."""
    name = F.col("video_name")
    videos = (
        keyframes.groupBy("video_name")
        .agg(F.count(F.lit(1)).alias("num_keyframes"))
        .select(
            "video_name",
            paths.summary_name(name).alias("summary_video_name"),
            F.concat(F.lit(f"{folder}/"), paths.summary_name(name)).alias("hdfs_path"),
            "num_keyframes",
            (F.col("num_keyframes") * SECONDS_PER_KEYFRAME).alias("duration_seconds"),
            F.replace(name, F.lit(".mp4"), F.lit("")).alias("stem"),
        )
    )
    texts = text_results.select(
        "filename", F.col("summary").alias("text_summary"), "sentiment", "keywords"
    )
    return contains_lookup(videos, "stem", texts, "filename").drop("stem", "filename")
