"""Catalogue queries: manifest, listing, probe, quality, funnel, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake import schemas
from cliplake.functions import paths
from cliplake.operators import catalog, report
from cliplake.plans import catalogue_job
from cliplake.queries.oracle import with_views
from cliplake.runtime import fresh_dir
from cliplake.sinks import tables
from cliplake.sources import files, views

PROBE_COLUMNS = [part.split()[0] for part in schemas.PROBE.split(", ")]


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue_job.check(views.probe(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cleaned(_checked(spark, sf_dir))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.media_listing(views.media_files(spark, sf_dir))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.parse_manifest(views.manifest_lines(spark, sf_dir), index="line_no")


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files already there: every second manifest row."""
    return _manifest(spark, sf_dir).where("idx % 2 = 0").select("video_id")


def manifest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).drop("error")


def manifest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("idx"))
    return catalog.sample_manifest(rows)


def pending_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting, _ = catalogue_job.ingest(_manifest(spark, sf_dir), _fetched(spark, sf_dir))
    return waiting.select("video_id", "title", "category", "duration")


def fetch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, totals = catalogue_job.ingest(_manifest(spark, sf_dir), _fetched(spark, sf_dir))
    return totals


def multi_path_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tier folders and one that does not exist, read as one table."""
    media = views.media_files(spark, sf_dir)
    folder = F.regexp_extract("path", "/user/([^/]*)/", 1)
    root = fresh_dir(spark, "folders")
    media.withColumn("folder", folder).write.partitionBy("folder").json(root)
    tiers = ["high_quality", "medium_quality", "low_quality", "no_such_quality"]
    return files.json_folders(
        spark, [f"{root}/folder={tier}" for tier in tiers], "path string, length bigint"
    )


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    name = paths.basename(path)
    return views.media_files(spark, sf_dir).select(
        "page_id",
        name.alias("name"),
        paths.strip_extension(name).alias("stem"),
        paths.strip_authority(path).alias("local_path"),
        paths.audio_name(name).alias("audio_name"),
        paths.video_name_of_audio(paths.audio_name(name)).alias("video_name"),
        paths.summary_name(name).alias("summary_name"),
    )


def path_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.media_files(spark, sf_dir).select(
        "page_id", paths.path_category(F.col("path")).alias("category")
    )


def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.size_report(views.media_files(spark, sf_dir))


def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.file_sizes(views.media_files(spark, sf_dir), paths.basename(F.col("path")))


def invalid_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.invalid_defaults(_listing(spark, sf_dir))


def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing that is there and one that is not, side by side."""
    schema = "path string, length bigint"
    root = fresh_dir(spark, "listing")
    tables.write_json(views.media_files(spark, sf_dir).select("path", "length"), root)
    there = files.optional_json(spark, root, schema).withColumn("source", F.lit("there"))
    missing = files.optional_json(spark, f"{root}/missing", schema)
    return there.unionByName(missing.withColumn("source", F.lit("missing")))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "json")
    tables.write_json(views.probe(spark, sf_dir), root)
    return files.json_lines(spark, root, schemas.PROBE)


def tier_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "tiers")
    tables.write_tiers(_cleaned(spark, sf_dir), root)
    return (
        spark.read.parquet(root)
        .groupBy("quality_level")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("file_size").alias("total_size"))
    )


def catalogue_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue job: the figures observed on the way, and the tiers read back."""
    listing = catalog.media_listing(views.catalogue_files(spark, sf_dir))
    tiers, figures = catalogue_job.run(listing, views.catalogue_probes(spark, sf_dir), fresh_dir(spark, "tiers"))
    stored = tiers.groupBy("quality_level").agg(
        F.count(F.lit(1)).cast("double").alias("files"), F.sum("file_size").cast("double").alias("bytes")
    )
    stored = stored.unpivot("quality_level", ["files", "bytes"], "what", "value").select(
        F.concat(F.lit("stored "), "what").alias("section"), F.col("quality_level").cast("string").alias("item"), "value"
    )
    return figures.unionByName(stored).withColumn("value", F.round("value", 6))


def collection_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tables.Collections(spark, fresh_dir(spark, "collections"))
    stored = store.overwrite(_cleaned(spark, sf_dir), "videos")
    return stored.select("video_id", "path", "quality_score", "quality_level")


def probe_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = catalog.parse_probe(views.probe_json(spark, sf_dir)).drop("probe")
    return parsed.withColumn("fps", F.round("fps", 6))


def error_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows end up as default rows with an error status; all others go on."""
    parsed = catalog.parse_probe(views.probe_json(spark, sf_dir))
    return parsed.groupBy("processing_status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("duration").alias("total_duration")
    )


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.with_score(views.probe(spark, sf_dir)).select("path", "quality_score")


def quality_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("path", "quality_level")


def validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(
        "path", "is_valid_duration", "is_valid_resolution", "is_valid_fps", "passes_all_checks"
    )


def cleaning_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cleaning_funnel(_checked(spark, sf_dir))


def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("video_id", "path", "quality_score", "quality_level")


def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.dedup(views.probe(spark, sf_dir)).select("video_id", "path", "duration")


def removed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.removed_report(views.probe(spark, sf_dir), _cleaned(spark, sf_dir))


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.describe_numeric(
        views.probe(spark, sf_dir), ["duration", "fps", "file_size"]
    )
    return stats.withColumns({c: F.round(c, 6) for c in ["mean", "stddev", "min", "max"]})


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalogue_job.quality_report(views.probe(spark, sf_dir))
    return rows.withColumn("value", F.round("value", 6))


def dist_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.distribution(path_category(spark, sf_dir), "category")


def _distribution(column: str, top: int | None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report.distribution(_cleaned(spark, sf_dir), column, top)

    return query


DISTRIBUTIONS = {
    "dist_quality": ("quality_level", None),
    "dist_resolution": ("resolution", 10),
    "dist_fps": ("fps", 10),
    "dist_codec": ("codec", 20),
    "dist_audio": ("has_audio", None),
}

QUERIES = {
    "manifest_load": manifest_load,
    "manifest_sample": manifest_sample,
    "pending_manifest": pending_manifest,
    "fetch_report": fetch_report,
    "media_scan": _listing,
    "multi_path_union": multi_path_union,
    "path_parts": path_parts,
    "path_category": path_category,
    "size_report": size_report,
    "file_sizes": file_sizes,
    "invalid_defaults": invalid_defaults,
    "optional_source": optional_source,
    "json_roundtrip": json_roundtrip,
    "tier_split": tier_split,
    "catalogue_run": catalogue_run,
    "collection_write": collection_write,
    "probe_parse": probe_parse,
    "error_isolation": error_isolation,
    "quality_score": quality_score,
    "quality_level": quality_level,
    "validity_flags": validity_flags,
    "cleaning_funnel": cleaning_funnel,
    "cleaned_rows": cleaned_rows,
    "dedup_key": dedup_key,
    "removed_report": removed_report,
    "describe_numeric": describe_numeric,
    "quality_report": quality_report,
    **{name: _distribution(*args) for name, args in DISTRIBUTIONS.items()},
    "dist_category": dist_category,
}


def _distribution_sql(column: str, top: int | None) -> str:
    limit = "" if top is None else f" limit {top}"
    return with_views(
        f"select {column}, count, row_number() over (order by count desc, {column} nulls first) - 1 as position"
        f" from (select {column}, count(*) as count from cleaned group by {column})"
        f" order by position{limit}",
        "cleaned",
    )


ORACLES = {
    "manifest_load": with_views("select * from manifest", "manifest"),
    "manifest_sample": """
        select p_partkey as idx, concat(id, '_', p_partkey) as video_id,
          concat('https://www.youtube.com/watch?v=', id) as url,
          concat('HowTo Video ', p_partkey) as title,
          ['cooking', 'crafts', 'technology', 'gardening'][p_partkey % 4 + 1] as category,
          60.0::double + p_partkey * 30 as duration
        from (select p_partkey, ['dQw4w9WgXcQ', '9bZkp7q19f0', 'kJQP7kiw5Fk',
          'tgbNymZ7vqY'][p_partkey % 4 + 1] as id from part)""",
    "pending_manifest": with_views(
        "select video_id, title, category, duration from manifest where idx % 2 <> 0", "manifest"
    ),
    "fetch_report": with_views(
        """select count(*) as total, count(*) filter (where idx % 2 = 0) as success,
          count(*) filter (where idx % 2 <> 0) as fail,
          cast(floor(count(*) filter (where idx % 2 = 0) / count(*)::double * 100) as bigint)
            as success_percent from manifest""",
        "manifest",
    ),
    "media_scan": with_views("select * from listing", "listing"),
    "multi_path_union": with_views(
        """select path, length from media_files where path like '%/high_quality/%'
        union all select path, length from media_files where path like '%/medium_quality/%'
        union all select path, length from media_files where path like '%/low_quality/%'""",
        "media_files",
    ),
    "path_parts": with_views(
        r"""select page_id, name, regexp_replace(name, '\.[^.]*$', '') as stem,
          regexp_replace(path, 'hdfs://.*?/', '', 'g') as local_path,
          replace(name, '.mp4', '.wav') as audio_name,
          regexp_replace(replace(name, '.mp4', '.wav'), '\.wav$', '.mp4') as video_name,
          replace(name, '.mp4', '_summary.mp4') as summary_name
        from (select *, regexp_extract(path, '([^/]*)$', 1) as name from media_files)""",
        "media_files",
    ),
    "path_category": with_views(
        """select page_id, case when path like '%/high_quality/%' then 'high'
          when path like '%/medium_quality/%' then 'medium'
          when path like '%/low_quality/%' then 'low' else 'unknown' end as category
        from media_files""",
        "media_files",
    ),
    "size_report": with_views(
        """select count(*) as files, cast(sum(length) // 1048576 as bigint) as total_mb
        from media_files""",
        "media_files",
    ),
    "file_sizes": with_views(
        """select regexp_extract(path, '([^/]*)$', 1) as name, length,
          length // 1048576 as size_mb from media_files""",
        "media_files",
    ),
    "invalid_defaults": with_views(
        """select video_id, path, 0::double as duration, 'unknown' as resolution,
          0::double as fps, 'unknown' as codec, 0::bigint as bitrate, false as has_audio,
          file_size, concat('invalid: ', error_message) as processing_status
        from listing where not is_valid""",
        "listing",
    ),
    "optional_source": with_views(
        "select path, length, 'there' as source from media_files", "media_files"
    ),
    "json_roundtrip": with_views("select * from probe", "probe"),
    "tier_split": with_views(
        """select quality_level, count(*) as count, cast(sum(file_size) as bigint) as total_size
        from cleaned group by quality_level""",
        "cleaned",
    ),
    "catalogue_run": with_views(
        """select * from (with passed as (select * from job_checked where processing_status = 'success' and passes_all_checks),
        single as (select * from passed qualify row_number() over (partition by video_id order by path) = 1),
        kept as (select * from single where quality_score >= 40),
        f as (select (select count(*) from job_checked) as total,
          (select count(*) from job_checked where processing_status = 'success') as valid,
          (select count(*) from passed) as quality, (select count(*) from single) as deduplicated,
          (select count(*) from kept) as final)
        select 'funnel' as section, unnest(['total', 'valid', 'quality', 'deduplicated', 'final', 'retention_percent'])
          as item, unnest([total, valid, quality, deduplicated, final, case when total > 0
            then floor(final / total::double * 100) else 0 end])::double as value from f
        union all select 'tiers', t, (select count(*) from kept where quality_level = t)::double
        from (select unnest(['high', 'medium', 'low']) as t)
        union all select 'report', unnest(['average_quality_score', 'average_duration', 'stddev_duration',
            'min_duration', 'max_duration']), round(unnest([avg(quality_score), avg(duration),
            stddev_samp(duration), min(duration), max(duration)]), 6) from kept
        union all select 'stored files', quality_level, count(*)::double from kept group by quality_level
        union all select 'stored bytes', quality_level, sum(file_size)::double from kept group by quality_level)""",
        "job_checked",
    ),
    "collection_write": with_views(
        "select video_id, path, quality_score, quality_level from cleaned", "cleaned"
    ),
    "probe_parse": with_views(
        """select path, duration, resolution, round(fps, 6) as fps, codec, bitrate, has_audio,
          processing_status from parsed""",
        "parsed",
    ),
    "error_isolation": with_views(
        """select processing_status, count(*) as files, sum(duration) as total_duration
        from parsed group by processing_status""",
        "parsed",
    ),
    "quality_score": with_views("select path, quality_score from checked", "checked"),
    "quality_level": with_views("select path, quality_level from checked", "checked"),
    "validity_flags": with_views(
        """select path, is_valid_duration, is_valid_resolution, is_valid_fps, passes_all_checks
        from checked""",
        "checked",
    ),
    "cleaning_funnel": with_views(
        """select *, cast(floor(final / total::double * 100) as bigint) as retention_percent
        from (select count(*) as total,
            count(*) filter (where processing_status = 'success') as valid,
            count(*) filter (where processing_status = 'success' and passes_all_checks)
              as quality from checked)
          cross join (select count(*) as deduplicated from deduped)
          cross join (select count(*) as final from cleaned)""",
        "cleaned",
    ),
    "cleaned_rows": with_views(
        "select video_id, path, quality_score, quality_level from cleaned", "cleaned"
    ),
    "dedup_key": with_views(
        """select video_id, path, duration from (select *,
          row_number() over (partition by video_id order by path) as rn from probe) where rn = 1""",
        "probe",
    ),
    "removed_report": with_views(
        """select raw, cleaned, raw - cleaned as removed
        from (select count(*) as raw from probe),
          (select count(*) as cleaned from cleaned)""",
        "cleaned",
    ),
    "describe_numeric": with_views(
        " union all ".join(
            f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 6) as mean,
              round(stddev_samp({c}), 6) as stddev, round(min({c})::double, 6) as min,
              round(max({c})::double, 6) as max from probe"""
            for c in ["duration", "fps", "file_size"]
        ),
        "probe",
    ),
    "quality_report": with_views(
        " union all ".join(
            f"""select section, item, value from (select '{c}' as section,
              {c}::varchar as item, count(*)::double as value from cleaned group by {c}
              order by value desc, item{f" limit {top}" if top else ""})"""
            for c, top in DISTRIBUTIONS.values()
        )
        + " union all "
        + " union all ".join(
            f"select 'totals', '{item}', round({value}, 6) from cleaned"
            for item, value in {
                "rows": "count(*)::double",
                "average_score": "avg(quality_score)",
                "average_duration": "avg(duration)",
                "stddev_duration": "stddev_samp(duration)",
                "min_duration": "min(duration)",
                "max_duration": "max(duration)",
            }.items()
        ),
        "cleaned",
    ),
    **{name: _distribution_sql(*args) for name, args in DISTRIBUTIONS.items()},
    "dist_category": with_views(
        """select category, count(*) as count,
          row_number() over (order by count(*) desc, category) - 1 as position from (select case
            when path like '%/high_quality/%' then 'high'
            when path like '%/medium_quality/%' then 'medium'
            when path like '%/low_quality/%' then 'low' else 'unknown' end as category
          from media_files) group by category""",
        "media_files",
    ),
}
