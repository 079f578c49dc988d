"""Series and clustering queries over frame rows and ordered samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import times, vectors
from cliplake.operators import cluster, report, series
from cliplake.plans import keyframe_job
from cliplake.queries.oracle import with_views
from cliplake.runtime import staged
from cliplake.sources import views

FRAME_SIZE, FRAME_HOP = 40, 16
AS_OF = "2024-01-30 23:00:00"
PADDED = 96
TRUNCATED = 48


def _long(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per element of an array column, rounded for comparison."""
    return df.select(*keys, F.posexplode(column).alias("dim", "value")).select(
        *keys, F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value")
    )


def frame_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.frames(spark, sf_dir).select("vec_id", "video_name", "frame_number", "timestamp")


def window_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    collected = series.window_collect(views.frames(spark, sf_dir))
    rows = collected.select(
        "video_name", "frame_number", F.posexplode("features_in_window").alias("slot", "vector")
    ).withColumn("slot", F.col("slot").cast("bigint"))
    return _long(rows, ["video_name", "frame_number", "slot"], "vector")


def _smooth(column: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        smoothed = series.smooth(views.frames(spark, sf_dir))
        return _long(smoothed, ["video_name", "frame_number"], column)

    return query


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = cluster.standardize(views.frames(spark, sf_dir), "features")
    return _long(scaled, ["video_name", "frame_number"], "scaled_features")


def pad_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = views.frames(spark, sf_dir).select(
        "vec_id", vectors.pad_vector(F.col("features"), PADDED).alias("padded")
    )
    return _long(padded, ["vec_id"], "padded")


def truncate_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = views.frames(spark, sf_dir).select(
        "vec_id", vectors.pad_vector(F.col("features"), TRUNCATED).alias("cut")
    )
    return _long(cut, ["vec_id"], "cut")


def euclid_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.distance_to_mean(views.frames(spark, sf_dir), views.FRAME_KEY).select(
        "video_name", "frame_number", "cluster", "distance"
    )


def cluster_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.frames(spark, sf_dir).agg(F.count(F.lit(1)).alias("frames"))
    return rows.withColumn("clusters", cluster.cluster_count(F.col("frames")))


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyframe_job.assign_clusters(views.frames(spark, sf_dir)).select(
        "video_name", "frame_number", "cluster", F.round("distance", 6).alias("distance")
    )


def keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smoothed vectors in millionths, as one line of text."""
    millionths = F.transform("gaussian_smoothed_features", lambda x: F.floor(x * 1e6 + 0.5))
    return keyframe_job.keyframes(views.frames(spark, sf_dir)).withColumn(
        "gaussian_smoothed_features", F.array_join(millionths, ",")
    )


def keyframe_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.keyframes_det(spark, sf_dir).select(
        "cluster", "video_name", "frame_number", "timestamp", "distance"
    )


def ordered_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.ordered_keyframes(views.keyframes_det(spark, sf_dir)).select(
        "position", "video_name", "frame_number", "timestamp", "caption"
    )


def keyframe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = F.array_join(F.col("clusters_represented").cast("array<string>"), ",")
    return (
        cluster.keyframe_stats(views.frames(spark, sf_dir), views.keyframes_det(spark, sf_dir))
        .withColumn("clusters_represented", clusters)
        .withColumn("compression_ratio", F.round("compression_ratio", 6))
    )


def overall_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = cluster.overall_ratio(
        views.frames(spark, sf_dir), views.keyframes_det(spark, sf_dir)
    )
    return ratios.withColumns(
        {c: F.round(c, 6) for c in ["compression", "frames_per_video"]}
    )


def compression_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = cluster.keyframe_figures(views.frames(spark, sf_dir), views.keyframes_det(spark, sf_dir))
    stats = report.global_stats(figures, ["compression_ratio"], ["num_keyframes"])
    return stats.withColumn("avg_compression_ratio", F.round("avg_compression_ratio", 6))


def pre_emphasis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.pre_emphasis(views.signal(spark, sf_dir)).withColumn("y", F.round("y", 6))


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.overlap_frames(views.signal(spark, sf_dir), FRAME_SIZE, FRAME_HOP)


def overlap_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _framed(spark, sf_dir)


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    energies = staged(series.frame_energy(_framed(spark, sf_dir)), "energies")
    return series.speech_mask(energies)


def speech_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mask(spark, sf_dir).select(
        "clip", "frame", "samples", F.round("energy", 4).alias("energy"), "speech"
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.segments(_mask(spark, sf_dir)).select(
        "clip", F.col("start").alias("seg_start"), F.col("end").alias("seg_end")
    )


def clip_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = series.clip_records(
        views.signal(spark, sf_dir), views.SAMPLE_RATE, FRAME_SIZE, FRAME_HOP
    )
    return records.withColumn("duration", F.round("duration", 6))


def sample_per_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    hour = F.floor(times.epoch_seconds(F.col("ts")) / 3600)
    sampled = series.sample_per_bucket(events, ["user_id"], hour, ["ts", "event_id"], "hour")
    return sampled.select("user_id", "hour", "event_id", "value")


def recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return (
        views.table(spark, sf_dir, "events")
        .where(times.since(F.col("ts"), as_of))
        .select("event_id", "user_id", "ts")
    )


QUERIES = {
    "frame_index": frame_index,
    "window_collect": window_collect,
    "moving_average": _smooth("smoothed_features"),
    "gaussian_smooth": _smooth("gaussian_smoothed_features"),
    "standardize": standardize,
    "pad_vector": pad_vector,
    "truncate_vector": truncate_vector,
    "euclid_distance": euclid_distance,
    "cluster_count": cluster_count,
    "kmeans_assign": kmeans_assign,
    "keyframes": keyframes,
    "keyframe_select": keyframe_select,
    "ordered_keyframes": ordered_keyframes,
    "keyframe_stats": keyframe_stats,
    "overall_ratio": overall_ratio,
    "compression_average": compression_average,
    "pre_emphasis": pre_emphasis,
    "overlap_frames": overlap_frames,
    "speech_mask": speech_mask,
    "segments": segments,
    "clip_record": clip_record,
    "sample_per_bucket": sample_per_bucket,
    "recent_rows": recent_rows,
}

ORACLES = {
    "frame_index": with_views(
        "select vec_id, video_name, frame_number, timestamp from frames", "frames"
    ),
    "window_collect": with_views(
        """select video_name, frame_number, slot, dim, round(w[slot + 1][dim + 1]::double, 6) + 0::double
          as value
        from (select *, unnest(range(64)) as dim
          from (select *, unnest(range(len(w))) as slot
            from (select video_name, frame_number, list(features) over
                (partition by video_name order by timestamp, frame_number
                 rows between 1 preceding and 1 following) as w from frames)))""",
        "frames",
    ),
    "moving_average": with_views(
        """select video_name, frame_number, dim, round(avg(v) over
          (partition by video_name, dim order by timestamp, frame_number
           rows between 1 preceding and 1 following), 6) + 0::double as value from frames_long""",
        "frames_long",
    ),
    "gaussian_smooth": with_views(
        """select video_name, frame_number, dim, round(case
            when b is not null and a is not null
              then (exp(-0.5) * b + v + exp(-0.5) * a) / (1 + 2 * exp(-0.5))
            when b is null and a is not null then a else v end, 6) + 0::double as value
        from (select *, lag(v) over w as b, lead(v) over w as a from frames_long
          window w as (partition by video_name, dim order by timestamp, frame_number))""",
        "frames_long",
    ),
    "standardize": with_views(
        """select video_name, frame_number, dim,
          round(case when s = 0 then 0 else (v - m) / s end, 6) + 0::double as value
        from (select *, avg(v) over (partition by dim) as m,
          stddev_samp(v) over (partition by dim) as s from frames_long)""",
        "frames_long",
    ),
    "pad_vector": f"""
        select vec_id, dim, round(coalesce(embedding[dim + 1]::double, 0), 6) + 0::double as value
        from (select vec_id, embedding, unnest(range({PADDED})) as dim from embeddings)""",
    "truncate_vector": f"""
        select vec_id, dim, round(embedding[dim + 1]::double, 6) + 0::double as value
        from (select vec_id, embedding, unnest(range({TRUNCATED})) as dim from embeddings)""",
    "euclid_distance": with_views(
        "select video_name, frame_number, cluster, distance from distances", "distances"
    ),
    "cluster_count": with_views(
        """select count(*) as frames,
          greatest(5, cast(floor(count(*) * 0.1::double) as bigint)) as clusters from frames""",
        "frames",
    ),
    "kmeans_assign": with_views(
        """select video_name, frame_number, cluster, round(distance, 6) as distance
        from clusters""",
        "clusters",
    ),
    "keyframes": with_views(
        """select video_name, frame_number, timestamp, cluster,
          smoothed as gaussian_smoothed_features
        from (select *, row_number() over (partition by cluster
          order by distance, video_name, frame_number) as rn from clusters) where rn = 1""",
        "clusters",
    ),
    "keyframe_select": with_views(
        "select cluster, video_name, frame_number, timestamp, distance from keyframes_det",
        "keyframes_det",
    ),
    "ordered_keyframes": with_views(
        """select row_number() over (order by video_name, timestamp, frame_number) - 1 as position,
          video_name, frame_number, timestamp, printf('t=%.1fs', timestamp) as caption
        from keyframes_det""",
        "keyframes_det",
    ),
    "keyframe_stats": with_views(
        """select video_name, 0::bigint as part, num_keyframes, first_keyframe_time,
          last_keyframe_time, clusters_represented, original_frame_count,
          round(compression_ratio, 6) as compression_ratio from stats""",
        "stats",
    ),
    "overall_ratio": with_views(
        """select total_frames, videos, keyframes,
          round(total_frames / keyframes::double, 6) as compression,
          round(total_frames / videos::double, 6) as frames_per_video
        from (select count(*) as total_frames, count(distinct video_name) as videos from frames),
          (select count(*) as keyframes from keyframes_det)""",
        "keyframes_det",
    ),
    "compression_average": with_views(
        """select round(avg(compression_ratio), 6) as avg_compression_ratio,
          cast(sum(num_keyframes) as bigint) as total_num_keyframes from stats""",
        "stats",
    ),
    "pre_emphasis": with_views(
        """select clip, i, round(x - 0.97 * coalesce(lag(x) over (partition by clip order by i),
          0), 6) + 0::double as y from signal""",
        "signal",
    ),
    "overlap_frames": with_views(
        'select clip, frame, offs as "offset", x from framed', "framed"
    ),
    "speech_mask": with_views(
        "select clip, frame, samples, round(energy, 4) as energy, speech from mask", "mask"
    ),
    "segments": with_views("select clip, seg_start, seg_end from segments", "segments"),
    "clip_record": with_views(
        """select c.clip, coalesce(n, 0) as num_segments, round(case when padded < 40 then 0 else samples / 400::double end, 6)
            as duration,
          case when samples is null or padded < 40
            then '[Transcription error: clip shorter than one frame]'
            else concat('[Audio contains approximately ', coalesce(n, 0), ' speech segments]') end
            as transcript
        from (select clip, count(*) as samples, ((count(*) + 15) // 16) * 16 as padded
          from signal group by clip) c
        left join (select clip, count(*) as n from segments group by clip) s on c.clip = s.clip""",
        "segments",
    ),
    "sample_per_bucket": """
        select user_id, hour, event_id, value from (select *, row_number() over
            (partition by user_id, hour order by ts, event_id) as rn
          from (select *, cast(floor(epoch(ts) / 3600) as bigint) as hour from events))
        where rn = 1""",
    "recent_rows": f"""select event_id, user_id, ts from events
        where ts >= timestamp '{AS_OF}' - interval 1 hour""",
}
