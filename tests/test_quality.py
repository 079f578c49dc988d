import pytest
from cliplake.functions import paths, quality
from cliplake.operators import catalog, report
from cliplake.plans import catalogue_job
from cliplake.sinks import tables
from pyspark.sql import functions as F


def _value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "duration,points",
    [(-1, 0), (0, 0), (0.5, 10), (29.9, 10), (30, 25), (600, 25), (600.1, 20), (1800, 20), (1801, 0)],
)
def test_duration_points(spark, duration, points):
    assert _value(spark, quality.duration_points(F.lit(float(duration)))) == points


@pytest.mark.parametrize(
    "kbits,points",
    [(0, 0), (999, 0), (1000, 10), (499999, 10), (500000, 25), (5000999, 25), (5001000, 20)],
)
def test_bitrate_points(spark, kbits, points):
    assert _value(spark, quality.bitrate_points(F.lit(kbits))) == points


@pytest.mark.parametrize(
    "fps,points", [(0, 0), (10, 10), (24, 20), (30, 20), (30.1, 25), (60, 25), (61, 10)]
)
def test_fps_points(spark, fps, points):
    assert _value(spark, quality.fps_points(F.lit(float(fps)))) == points


def test_resolution(spark):
    for resolution, points in {"1920x1080": 30, "1280x720": 25, "854x480": 20, "0x0": 10}.items():
        assert _value(spark, quality.resolution_points(F.lit(resolution))) == points
    assert not _value(spark, quality.is_valid_resolution(F.lit("640x0x0")))
    assert not _value(spark, quality.is_valid_resolution(F.lit("unknown")))


def test_probe_text_that_does_not_parse(spark):
    whole = (
        '{"format":{"duration":"12.5","bit_rate":"800000"},"streams":['
        '{"codec_type":"audio","codec_name":"aac"},{"codec_type":"video","codec_name":"vp9",'
        '"width":640,"height":360,"r_frame_rate":"%s"}]}'
    )
    rows = [
        ("ok", whole % "30/2"),
        ("bad rate", whole % "x/2"),
        ("zero rate", whole % "30/0"),
        ("one part", whole % "30"),
        ("closing slash", whole % "30/"),
        ("list", "[1]"),
        ("text", "nothing"),
        ("null", None),
        ("empty", "{}"),
        ("bad duration", '{"format":{"duration":"N/A"}}'),
    ]
    df = catalog.parse_probe(spark.createDataFrame(rows, "path string, probe string"))
    found = {r.path: r for r in df.collect()}
    ok = found["ok"]
    assert (ok.duration, ok.resolution, ok.fps, ok.codec) == (12.5, "640x360", 15.0, "vp9")
    assert ok.bitrate == 800000 and ok.has_audio and ok.processing_status == "parsed"
    assert found["zero rate"].fps == found["one part"].fps == found["closing slash"].fps == 0.0
    assert found["closing slash"].processing_status == "parsed"
    assert found["empty"].resolution == "0x0" and found["empty"].processing_status == "parsed"
    for name in ["bad rate", "list", "text", "null", "bad duration"]:
        assert found[name].processing_status == "parse_error", name
        assert (found[name].duration, found[name].resolution) == (0.0, "unknown")


def test_manifest_fields(spark):
    lines = [(0, "a"), (1, "b,,,"), (2, "c,,x"), (3, "d,t,k,12.5"), (4, "e,t,k,soon")]
    df = catalog.parse_manifest(spark.createDataFrame(lines, "idx int, line string"))
    found = {r.video_id: r for r in df.collect()}
    assert (found["a"].title, found["a"].category, found["a"].duration) == ("Video_0", "general", 0)
    assert (found["b"].title, found["b"].category) == ("Video_1", "general")
    assert (found["c"].title, found["c"].category) == ("", "x")
    assert found["d"].duration == 12.5 and found["d"].error is None
    assert found["e"].duration == 0.0 and "soon" in found["e"].error


def _probe(spark):
    rows = [
        ("a", "2", 60.0, "1920x1080", 25.0, "h264", 900000, True, 1, "success"),
        ("a", "1", 60.0, "320x240", 16.0, "h264", 0, True, 1, "success"),
        ("b", "1", 60.0, "1280x720", 25.0, "h264", 900000, False, 1, "success"),
        ("c", "1", 60.0, "1280x720", 25.0, "h264", 900000, False, 1, "error: x"),
        ("d", "1", 5.0, "1280x720", 25.0, "h264", 900000, False, 1, "success"),
        ("e", "1", 2000.0, "320x240", 16.0, "h264", 0, False, 1, "success"),
    ]
    from cliplake import schemas

    return spark.createDataFrame(rows, schemas.PROBE)


def test_funnel_agrees_with_the_rows(spark, tmp_path):
    checked = catalogue_job.check(_probe(spark))
    funnel = catalog.cleaning_funnel(checked).first().asDict()
    kept = catalog.cleaned(checked)
    assert funnel == {
        "total": 6, "valid": 5, "quality": 4, "deduplicated": 3, "final": 2,
        "retention_percent": 33,
    }
    assert {(r.video_id, r.path) for r in kept.collect()} == {("a", "1"), ("b", "1")}
    tables.write_tiers(kept, str(tmp_path / "tiers"))
    tiers = spark.read.parquet(str(tmp_path / "tiers"))
    assert tiers.count() == funnel["final"]
    assert {r.quality_level for r in tiers.collect()} == {"high", "low"}


def test_reports_on_empty_tables(spark):
    empty = catalogue_job.check(_probe(spark).limit(0))
    assert catalog.cleaning_funnel(empty).first().asDict()["retention_percent"] == 0
    assert report.global_stats(empty, ["duration"], ["bitrate"]).first().avg_duration is None
    assert report.fetch_report(empty, F.col("has_audio")).first().success_percent == 0
    assert report.size_report(empty.withColumn("length", F.lit(1))).first().total_mb == 0


def test_probe_listing_joins_output_and_defaults(spark):
    files = [("/x/a.mp4", 10), ("/x/b.mp4", 0), ("/x/c.MKV", 5), ("/x/d.txt", 5)]
    listing = catalog.media_listing(spark.createDataFrame(files, "path string, length bigint"))
    outputs = spark.createDataFrame([("/x/a.mp4", "{}")], "path string, probe string")
    found = {r.path: r for r in catalogue_job.probe_listing(listing, outputs).collect()}
    assert set(found) == {"/x/a.mp4", "/x/b.mp4", "/x/c.MKV"}
    assert found["/x/a.mp4"].processing_status == "success"
    assert found["/x/b.mp4"].processing_status == "invalid: Empty file"
    assert found["/x/c.MKV"].processing_status == "error: no probe output"


def test_catalogue_job_counts_while_it_writes(spark, tmp_path):
    files = [(f"/x/{i}/v{i % 40}.mp4", 0 if i % 11 == 0 else i) for i in range(400)]
    text = '{"format":{"duration":"%d","bit_rate":"900000"},"streams":[{"codec_type":"video","width":%d,"height":%d,"r_frame_rate":"25/1"}]}'
    outputs = [(path, "broken" if i % 17 == 0 else text % (i * 10, 640, (480, 720, 1080)[i % 3])) for i, (path, _) in enumerate(files) if i % 7]
    spark.createDataFrame(files, "path string, length bigint").write.parquet(str(tmp_path / "files"))
    spark.createDataFrame(outputs, "path string, probe string").write.parquet(str(tmp_path / "probes"))
    listing = catalog.media_listing(spark.read.parquet(str(tmp_path / "files")))
    probes = spark.read.parquet(str(tmp_path / "probes"))
    joined = catalogue_job.probe_listing(listing, probes)
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2
    tiers, figures = catalogue_job.run(listing, probes, str(tmp_path / "tiers"))
    found = {(r.section, r.item): r.value for r in figures.collect()}
    checked = catalogue_job.check(joined)
    for name, value in catalog.cleaning_funnel(checked).first().asDict().items():
        assert found["funnel", name] == value
    kept = catalog.cleaned(checked)
    assert found["report", "average_duration"] == pytest.approx(kept.agg(F.avg("duration")).first()[0])
    counts = {r["quality_level"]: r["count"] for r in kept.groupBy("quality_level").count().collect()}
    assert {t: found["tiers", t] for t in ("high", "medium", "low")} == {t: counts.get(t, 0) for t in ("high", "medium", "low")}
    assert {r["quality_level"]: r["count"] for r in tiers.groupBy("quality_level").count().collect()} == counts
    none, figures = catalogue_job.run(listing.limit(0), probes, str(tmp_path / "none"))
    assert none.count() == 0 and {r.value for r in figures.where("section = 'funnel'").collect()} == {0.0}


def test_path_names(spark):
    path = "hdfs://host:9000/user/x/high_quality/clip.part.mp4"
    assert _value(spark, paths.strip_authority(F.lit(path))) == "user/x/high_quality/clip.part.mp4"
    assert _value(spark, paths.strip_extension(paths.basename(F.lit(path)))) == "clip.part"
    assert _value(spark, paths.path_category(F.lit(path))) == "high"
    assert _value(spark, paths.video_name_of_audio(F.lit("a.wav.wav"))) == "a.wav.mp4"


def test_broken_probe_text(spark):
    good = '{"format":{"duration":"5.5","bit_rate":"7"},"streams":[{"codec_type":"video","width":%s,"height":2}]}'
    bad = ['{"format":{"duration":"5.5"', '{"format":', "{not json}", good % 1 + " garbage", good % '"abc"',
           good % 99999999999, '{"format":{},"streams":"none"}', "", None]
    fine = [good % 1, "\n\t " + good % '"640"' + " \n"]
    df = spark.createDataFrame([(t,) for t in bad + fine], "probe string")
    found = {r["probe"]: r for r in catalog.parse_probe(df).collect()}
    assert all(found[t]["processing_status"] == "parse_error" for t in bad)
    assert [found[t]["resolution"] for t in fine] == ["1x2", "640x2"]
