"""Catalogue jobs: manifest ingest, quality report and tier split."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from cliplake.operators import catalog, report
from cliplake.params import QualityParams
from cliplake.sinks import tables

# Columns whose distribution the quality report shows, with the number of values it lists.
REPORT_DISTRIBUTIONS = {
    "quality_level": None,
    "resolution": 10,
    "fps": 10,
    "codec": 20,
    "has_audio": None,
}

# Figures of the cleaned rows in the job's report: column, label, aggregate.
REPORT_FIGURES = (
    ("quality_score", "average", F.avg),
    ("duration", "average", F.avg),
    ("duration", "stddev", F.stddev_samp),
    ("duration", "min", F.min),
    ("duration", "max", F.max),
)


def ingest(manifest: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows still to fetch, and the report over what is there."""
    there = listing.select("video_id").distinct().withColumn("fetched", F.lit(True))
    results = manifest.join(there, "video_id", "left")
    fetched = F.coalesce("fetched", F.lit(False))
    return catalog.pending(manifest, listing), report.fetch_report(results, fetched)


def check(probe: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Probe records with score, level and checks."""
    return catalog.with_checks(catalog.with_score(probe), params)


def probe_listing(listing: DataFrame, probe_output: DataFrame) -> DataFrame:
    """Probe records of a listing: parsed output by path, default records for invalid files and for
    files without output.

    One join: listing and outputs are read once, whatever becomes of a file.
    """
    parsed = catalog.parse_probe(probe_output).drop("probe").withColumnRenamed("processing_status", "_status")
    both = listing.join(parsed, "path", "left")
    valid = F.coalesce("is_valid", F.lit(False))
    status = (
        F.when(~valid, catalog.invalid_status())
        .when(F.col("_status").isNull(), "error: no probe output")
        .when(F.col("_status") == "parsed", "success")
        .otherwise(F.col("_status"))
    )
    usable = valid & F.col("_status").isNotNull()
    fields = [
        F.when(usable, F.col(name)).otherwise(default).alias(name)
        for name, default in catalog.probe_defaults().items()
    ]
    return both.select("video_id", "path", *fields, "file_size", status.alias("processing_status"))


def write_catalogue(
    probe: DataFrame, path: str, params: QualityParams = QualityParams()
) -> tuple[DataFrame, DataFrame]:
    """Score, clean and write probe records to their quality tiers, all in one pass.

    Gives the written tiers and the funnel with its report figures as (section, item, value).  The
    figures are observed while the tiers are written: the source is read once, however many steps
    are counted.
    """
    spark = probe.sparkSession
    checked, cleaning, final = Observation("checked"), Observation("cleaning"), Observation("final")
    valid = F.col("processing_status") == "success"
    every = check(probe, params).observe(
        checked,
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(valid & F.col("passes_all_checks")).alias("quality"),
    )
    passed = catalog.dedup(every.where(valid & F.col("passes_all_checks")))
    single = passed.observe(cleaning, F.count(F.lit(1)).alias("deduplicated"))
    kept = single.where(F.col("quality_score") >= params.low).observe(
        final,
        F.count(F.lit(1)).alias("final"),
        *[F.count_if(F.col("quality_level") == tier).alias(tier) for tier in ("high", "medium", "low")],
        *[function(name).alias(f"{label}_{name}") for name, label, function in REPORT_FIGURES],
    )
    tables.write_tiers(kept, path, params=params)
    figures = [f"{label}_{name}" for name, label, _ in REPORT_FIGURES]
    steps = {
        **_observed(checked, dict.fromkeys(("total", "valid", "quality"), 0)),
        **_observed(cleaning, {"deduplicated": 0}),
        **_observed(final, dict.fromkeys(("final", "high", "medium", "low"), 0) | dict.fromkeys(figures)),
    }
    share = steps["final"] / steps["total"] * 100 if steps["total"] else 0
    steps["retention_percent"] = float(int(share))
    sections = {name: "funnel" for name in ("total", "valid", "quality", "deduplicated", "final", "retention_percent")}
    sections |= dict.fromkeys(("high", "medium", "low"), "tiers")
    rows = [
        (sections.get(name, "report"), name, None if value is None else float(value)) for name, value in steps.items()
    ]
    long = spark.createDataFrame(rows, "section string, item string, value double")
    return spark.read.schema(kept.schema).parquet(path), long


def _observed(observation: Observation, of_no_rows: dict) -> dict:
    """Figures of a finished observation; where no row can reach a step, Spark leaves it out of the
    plan and there is none."""
    try:
        return observation.get
    except Py4JJavaError:
        return of_no_rows


def run(
    listing: DataFrame, probe_output: DataFrame, path: str, params: QualityParams = QualityParams()
) -> tuple[DataFrame, DataFrame]:
    """The catalogue job from a file listing and probe texts (path, probe) to tiers and figures."""
    return write_catalogue(probe_listing(listing, probe_output), path, params)


def quality_report(probe: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The preprocessing report in long form: section, item, value.

    All distributions come from one pass over the cleaned rows.
    """
    rows = catalog.cleaned(check(probe, params), params)
    items = F.array(
        *[
            F.struct(F.lit(name).alias("section"), F.col(name).cast("string").alias("item"))
            for name in REPORT_DISTRIBUTIONS
        ]
    )
    counts = (
        rows.select(F.explode(items).alias("cell"))
        .groupBy("cell.section", "cell.item")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    )
    # Only the sections without a list length hold a handful of values by nature.
    longest = max(top for top in REPORT_DISTRIBUTIONS.values() if top)
    length = F.coalesce(
        *[
            F.when(F.col("section") == name, top)
            for name, top in REPORT_DISTRIBUTIONS.items()
            if top
        ],
        F.lit(longest),
    )
    order = Window.partitionBy("section").orderBy(F.desc("value"), F.asc_nulls_first("item"))
    listed = (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= longest)
        .where(F.col("rank") <= length)
        .drop("rank")
    )
    numbers = rows.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.avg("quality_score").alias("average_score"),
        F.avg("duration").alias("average_duration"),
        F.stddev_samp("duration").alias("stddev_duration"),
        F.min("duration").alias("min_duration"),
        F.max("duration").alias("max_duration"),
    )
    totals = numbers.unpivot([], numbers.columns, "item", "value")
    return listed.unionByName(totals.select(F.lit("totals").alias("section"), "item", "value"))
