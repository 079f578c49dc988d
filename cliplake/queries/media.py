"""Queries over file contents, pixels and audio derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import audio, images
from cliplake.plans import keyframe_job
from cliplake.queries.oracle import with_views
from cliplake.queries.series import _long
from cliplake.runtime import fresh_dir
from cliplake.sinks import tables
from cliplake.sources import files, views
from cliplake.sources.frame_store import FrameStore

PIXEL_COLUMNS = ["height", "width", "channels", "data"]


def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to container files, the files read whole and cut into pages again."""
    root = fresh_dir(spark, "pages")
    page = F.concat(F.col("page_id"), F.lit("\t"), F.col("html"))
    tables.write_records(views.table(spark, sf_dir, "pages").select(page.alias("page")), root)
    records = F.split(F.col("content").cast("string"), tables.RECORD_END)
    pages = (
        files.binary_files(spark, [root])
        .select(F.explode_outer(records).alias("page"))
        .where("page <> ''")
    )
    html = F.regexp_replace("page", r"^[0-9]+\t", "")
    return pages.select(
        F.substring_index("page", "\t", 1).cast("bigint").alias("page_id"),
        F.octet_length(html).cast("bigint").alias("length"),
        F.md5(html.cast("binary")).alias("checksum"),
    )


def image_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images written to PNG sheets, the files decoded and cut into images again."""
    root = fresh_dir(spark, "images")
    tables.write_files(views.image_sheets(spark, sf_dir), "sheet", "content", root)
    count = F.floor(F.col("height") * F.col("width") / views.TILE_BYTES).cast("int")
    starts = F.transform(
        F.sequence(F.lit(0), count - 1), lambda tile: tile * views.TILE_BYTES + 1
    )
    tiles = files.images(spark, root).select(
        "width", "n_channels", F.explode(starts).alias("start"), "data"
    )
    return tiles.select(
        F.conv(F.hex(F.substring("data", F.col("start"), 8)), 16, 10)
        .cast("bigint")
        .alias("vec_id"),
        F.lit(8).alias("height"),
        "width",
        "n_channels",
        F.hex(F.substring("data", F.col("start") + 8, 64)).alias("pixels"),
    )


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded WAV clips: clip, wav(sample_rate, samples, error)."""
    return views.wav_clips(spark, sf_dir).select(
        F.concat_ws("/", "clip", "part").alias("clip"),
        audio.wav_samples(F.col("content")).alias("wav"),
    )


def wav_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select(
        "clip",
        F.col("wav.sample_rate").alias("sample_rate"),
        F.posexplode("wav.samples").alias("position", "sample"),
    ).select(
        "clip",
        "sample_rate",
        F.col("position").cast("bigint").alias("position"),
        F.col("sample").cast("double").alias("sample"),
    )


def _mel(spark: SparkSession, sf_dir: str) -> DataFrame:
    spectra = _decoded(spark, sf_dir).select(
        "clip",
        F.posexplode(
            audio.power_spectrum(F.col("wav.sample_rate"), F.col("wav.samples"))
        ).alias("frame", "power"),
    )
    return audio.mel_energies(
        spectra.withColumn("frame", F.col("frame").cast("bigint")),
        audio.mel_filterbank(spark, views.SAMPLE_RATE),
    )


def mel_filterbank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mel(spark, sf_dir).withColumn("energy", F.round("energy", 6))


def dct_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    cepstra = audio.cepstrum(_mel(spark, sf_dir), audio.dct_basis(spark))
    return cepstra.withColumn("mfcc", F.round("mfcc", 5))


def mfcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip records of the WAV clips: one row per mean coefficient, one for a failed clip."""
    records = views.wav_clips(spark, sf_dir).select(
        F.concat_ws("/", "clip", "part").alias("clip"),
        audio.clip_record(F.col("content")).alias("record"),
    )
    return records.select(
        "clip",
        F.col("record.num_segments").cast("bigint").alias("num_segments"),
        "record.duration",
        "record.transcript",
        F.posexplode_outer("record.mfcc_features").alias("k", "mfcc"),
    ).select(
        "clip",
        "num_segments",
        "duration",
        "transcript",
        F.coalesce("k", F.lit(-1)).cast("bigint").alias("k"),
        F.round("mfcc", 5).alias("mfcc"),
    )


def _on_pixels(compute):
    def apply(df: DataFrame, name: str) -> DataFrame:
        return df.select("vec_id", compute(*map(F.col, PIXEL_COLUMNS)).alias(name))

    return apply


def edge_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = _on_pixels(images.edge_maps)(views.gray_images(spark, sf_dir), "maps")
    named = F.array(
        *[
            F.struct(F.lit(kernel).alias("kernel"), F.col(f"maps.{kernel}").alias("map"))
            for kernel in images.KERNELS
        ]
    )
    cells = maps.select("vec_id", F.explode(named).alias("one")).select(
        "vec_id", "one.kernel", F.posexplode("one.map").alias("at", "value")
    )
    return cells.select(
        "vec_id",
        "kernel",
        F.floor(F.col("at") / 6).alias("r"),
        (F.col("at") % 6).cast("bigint").alias("c"),
        F.round("value", 6).alias("value"),
    )


def color_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _on_pixels(images.color_histograms)(views.color_images(spark, sf_dir), "counts")
    cells = counts.select("vec_id", F.posexplode("counts").alias("at", "n"))
    return cells.select(
        "vec_id",
        F.floor(F.col("at") / images.HISTOGRAM_BINS).alias("channel"),
        (F.col("at") % images.HISTOGRAM_BINS).cast("bigint").alias("bin"),
        F.col("n").cast("bigint").alias("n"),
    )


def texture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _on_pixels(images.texture_stats)(views.gray_images(spark, sf_dir), "stats")
    return stats.select(
        "vec_id", *[F.round(f"stats.{name}", 6).alias(name) for name in images.TEXTURE_FIELDS]
    )


def frame_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _on_pixels(images.frame_features)(views.gray_images(spark, sf_dir), "features")
    doubles = found.withColumn("features", F.col("features").cast("array<double>"))
    return _long(doubles, ["vec_id"], "features")


def color_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors of colour images: histograms, texture and intensity."""
    found = _on_pixels(images.frame_features)(views.color_images(spark, sf_dir), "features")
    doubles = found.withColumn("features", F.col("features").cast("array<double>"))
    return _long(doubles, ["vec_id"], "features")


def keyframes_from_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colour frames stored, described, smoothed, clustered, and the keyframes' pixels fetched."""
    frames = views.frames(spark, sf_dir).select("vec_id", "video_name", "frame_number", "timestamp")
    pixels = frames.join(views.color_images(spark, sf_dir), "vec_id").drop("vec_id")
    store = FrameStore.write(pixels, fresh_dir(spark, "frames"), per_bucket=64)
    found = keyframe_job.from_pixels(store)
    return found.select(
        "video_name",
        "frame_number",
        "timestamp",
        "cluster",
        F.array(*[F.col(name) for name in PIXEL_COLUMNS[:3]]).cast("string").alias("shape"),
        F.hex("data").alias("frame_data"),
    )


def base64_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = F.translate(F.base64("data"), "\r\n", "")
    return (
        views.gray_images(spark, sf_dir)
        .select("vec_id", encoded.alias("encoded"))
        .withColumn("decoded", F.hex(F.unbase64("encoded")))
    )


QUERIES = {
    "binary_scan": binary_scan,
    "image_scan": image_scan,
    "wav_samples": wav_samples,
    "mel_filterbank": mel_filterbank,
    "dct_basis": dct_basis,
    "mfcc": mfcc,
    "edge_maps": edge_maps,
    "color_histogram": color_histogram,
    "texture_stats": texture_stats,
    "frame_features": frame_features,
    "color_features": color_features,
    "keyframes_from_pixels": keyframes_from_pixels,
    "base64_roundtrip": base64_roundtrip,
}

PIXEL_HEX = """string_agg(printf('%02X', cast(level as int)), '' order by d)"""

ORACLES = {
    "binary_scan": """
        select page_id, octet_length(encode(html)) as length, md5(html) as checksum from pages""",
    "image_scan": with_views(
        f"""select vec_id, 8 as height, 8 as width, 1 as n_channels, {PIXEL_HEX} as pixels
        from pixels group by vec_id""",
        "pixels",
    ),
    "wav_samples": with_views(
        """select clip, 400 as sample_rate, j as position, s as sample from wavs""", "wavs"
    ),
    "mel_filterbank": with_views(
        "select clip, frame, filter, round(energy, 6) as energy from mel", "mel"
    ),
    "dct_basis": with_views("select clip, frame, k, round(mfcc, 5) + 0::double as mfcc from mfcc", "mfcc"),
    "mfcc": with_views(
        """select c.clip, coalesce(s.n, 0) as num_segments,
          case when f.clip is null then 0 else c.samples / 400::double end as duration,
          case when f.clip is null then '[Transcription error: clip shorter than one frame]'
            else concat('[Audio contains approximately ', coalesce(s.n, 0), ' speech segments]')
            end as transcript,
          coalesce(f.k, -1) as k, round(f.mfcc, 5) + 0::double as mfcc
        from (select clip, count(*) as samples from wavs group by clip) c
        left join (select clip, k, avg(mfcc) as mfcc from mfcc group by clip, k) f
          on c.clip = f.clip
        left join (select clip, count(distinct island) as n
          from (select clip, frame - row_number() over (partition by clip order by frame) as island
            from (select *, avg(e) over (partition by clip) as m
              from (select clip, frame, sum(mfcc * mfcc) as e from mfcc group by clip, frame))
            where e > m * 0.5) group by clip) s on c.clip = s.clip""",
        "mfcc",
    ),
    "edge_maps": with_views(
        "select vec_id, kernel, r, c, round(value, 6) + 0::double as value from edges", "edges"
    ),
    "color_histogram": with_views(
        """select a.vec_id, a.channel, a.bin, coalesce(n, 0) as n
        from (select vec_id, unnest(range(3)) as channel, bin
          from (select vec_id, unnest(range(32)) as bin from embeddings)) a
        left join (select vec_id, channel, cast(case channel when 0 then level
              when 1 then 255 - level else level * 2 % 256 end as bigint) // 8 as bin,
            count(*) as n
          from (select *, unnest(range(3)) as channel from pixels) group by all) b
        on a.vec_id = b.vec_id and a.channel = b.channel and a.bin = b.bin""",
        "pixels",
    ),
    "texture_stats": with_views(
        "select vec_id, {} from texture".format(
            ", ".join(f"round({name}, 6) + 0::double as {name}" for name in images.TEXTURE_FIELDS)
        ),
        "texture",
    ),
    "frame_features": with_views(
        """select vec_id, dim, round(coalesce(case when dim between 96 and 108 then
            stats[dim - 95] else 0 end::float::double, 0), 6) + 0::double as value
        from (select vec_id, [{}] as stats, unnest(range(512)) as dim from texture)""".format(
            ", ".join(images.TEXTURE_FIELDS)
        ),
        "texture",
    ),
    "color_features": with_views(
        "select vec_id, dim, round(value, 6) + 0::double as value from color_features", "color_features"
    ),
    "keyframes_from_pixels": with_views(
        """select video_name, frame_number, timestamp, cluster, '[8, 8, 3]' as shape, frame_data
        from (select *, row_number() over (partition by cluster
          order by distance, video_name, frame_number) as rn from pixel_clusters)
        join (select vec_id, video_name, frame_number from frames) using (video_name, frame_number)
        join (select vec_id, string_agg(printf('%02X%02X%02X', b, g, r), '' order by d) as frame_data
          from color_levels group by vec_id) using (vec_id)
        where rn = 1""",
        "pixel_clusters",
        "color_levels",
    ),
    "base64_roundtrip": with_views(
        f"""select vec_id, to_base64(unhex(pixels)) as encoded, pixels as decoded
        from (select vec_id, {PIXEL_HEX} as pixels from pixels group by vec_id)""",
        "pixels",
    ),
}
