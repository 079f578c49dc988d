"""Reports: distributions, descriptions, totals and per-collection counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake.operators import ordered
from cliplake.runtime import Scratch

MEGABYTE = 1024 * 1024


def distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Row count per value, largest first; ties by value.  ``position`` counts from 0."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    order = [F.desc("count"), F.asc_nulls_first(column)]
    if top is not None:
        return _positions(counts.orderBy(*order).limit(top), order)
    return ordered.with_position(counts, order, "position", Scratch(df.sparkSession)).orderBy("position")


def _positions(few: DataFrame, order: list[Column]) -> DataFrame:
    """Number the rows of a list of limited length."""
    place = F.row_number().over(Window.orderBy(*order)) - 1
    return few.withColumn("position", place.cast("bigint"))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.count(name).alias("count"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("stddev"),
                F.min(name).cast("double").alias("min"),
                F.max(name).cast("double").alias("max"),
            ).alias(name)
            for name in columns
        ]
    )
    return stats.select(F.explode(F.array(*columns)).alias("stat")).select("stat.*")


def whole_percent(part: Column, total: Column) -> Column:
    """Truncated percentage; 0 when there is nothing to divide by."""
    share = F.floor(part.cast("double") / total * 100)
    return F.when(total > 0, share).otherwise(0).cast("bigint")


def fetch_report(results: DataFrame, fetched: Column) -> DataFrame:
    """Totals of a fetch run and its whole success percentage."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(fetched).alias("success"),
        F.count_if(~F.coalesce(fetched, F.lit(False))).alias("fail"),
    )
    return counts.withColumn("success_percent", whole_percent(F.col("success"), F.col("total")))


def file_sizes(files: DataFrame, name: Column) -> DataFrame:
    """Whole megabytes per file."""
    return files.select(
        name.alias("name"), "length", F.floor(F.col("length") / MEGABYTE).alias("size_mb")
    )


def size_report(files: DataFrame) -> DataFrame:
    """File count and whole megabytes of the summed sizes."""
    total = F.coalesce(F.sum("length"), F.lit(0))
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.floor(total / MEGABYTE).alias("total_mb")
    )


def removed_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows before and after cleaning."""
    tagged = raw.select(F.lit(1).alias("raw"), F.lit(0).alias("cleaned")).unionAll(
        cleaned.select(F.lit(0).alias("raw"), F.lit(1).alias("cleaned"))
    )
    sums = tagged.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum("cleaned"), F.lit(0)).alias("cleaned"),
    )
    return sums.withColumn("removed", F.col("raw") - F.col("cleaned"))


def global_stats(df: DataFrame, averages: list[str], sums: list[str]) -> DataFrame:
    """Averages and sums over the whole table; null, not an error, on an empty one."""
    return df.agg(
        *[F.avg(c).alias(f"avg_{c}") for c in averages],
        *[F.sum(c).alias(f"total_{c}") for c in sums],
    )


def count_per_category(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Row count of each listed value, zeros included, labelled in title case."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(value,) for value in categories], f"{column} string")
    counts = (
        df.where(F.col(column).isin(*categories))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return wanted.join(counts, column, "left").select(
        column, F.initcap(column).alias("label"), F.coalesce("count", F.lit(0)).alias("count")
    )


def collection_counts(collections: dict[str, DataFrame]) -> DataFrame:
    """One row per collection with its document count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("documents")).select(
            F.lit(name).alias("collection"), "documents"
        )
        for name, df in collections.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def top_keywords(df: DataFrame, keywords: str = "keywords", top: int = 10) -> DataFrame:
    """Most frequent keywords over all documents; ties by word."""
    return (
        # A plain explode makes Spark filter by the list's size first, which computes the list twice.
        df.select(F.explode_outer(keywords).alias("keyword"))
        .where(F.col("keyword").isNotNull())
        .groupBy(F.col("keyword.word").alias("word"))
        .agg(F.sum("keyword.frequency").alias("total_frequency"))
        .orderBy(F.desc("total_frequency"), "word")
        .limit(top)
        .transform(_positions, [F.desc("total_frequency"), F.col("word")])
    )


def top_rows(df: DataFrame, metric: str, tie: str, top: int) -> DataFrame:
    """Rows with the largest metric, numbered from 0; ties by name."""
    order = [F.desc(metric), F.col(tie)]
    return _positions(df.orderBy(*order).limit(top), order)


def final_totals(summaries: DataFrame) -> DataFrame:
    """Documents, keyframes and playback time over all final summaries."""

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    sums = summaries.agg(
        F.count(F.lit(1)).alias("documents"),
        total("num_keyframes").alias("total_keyframes"),
        total("duration_seconds").alias("total_seconds"),
    )
    return sums.withColumn("total_minutes", F.col("total_seconds") / 60)
