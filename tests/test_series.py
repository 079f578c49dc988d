"""Sliced operators against plain loops, with one clip holding most of the rows."""

import math
import random

import pytest
from cliplake.operators import ordered, series
from pyspark.sql import functions as F

SLICES = [1, 2, 3, 7, 1000]


def _clips():
    rng = random.Random(7)
    lengths = {"hot": 100, "one": 1, "two": 2, "some": 17}
    return {clip: [rng.uniform(-1, 1) for _ in range(n)] for clip, n in lengths.items()}


def _signal(spark):
    rows = [(clip, i, x) for clip, xs in _clips().items() for i, x in enumerate(xs)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "clip string, i bigint, x double")


@pytest.mark.parametrize("rows", SLICES)
def test_numbering_and_running_sum(spark, rows):
    signal = _signal(spark).withColumn("key", F.when(F.col("clip") != "some", F.col("clip")))
    cut = ordered.slice_of(F.col("i"), rows)
    numbered = ordered.number_rows(signal, ["key"], ["i"], cut, "n").collect()
    assert len(numbered) == 120 and all(r.n == r.i for r in numbered)
    summed = ordered.running_sum(signal, ["key"], ["i"], cut, F.col("x"), "s").collect()
    for r in summed:
        assert math.isclose(r.s, sum(_clips()[r.clip][: r.i + 1]), abs_tol=1e-9)


@pytest.mark.parametrize("rows", SLICES)
def test_pre_emphasis(spark, rows):
    for r in series.pre_emphasis(_signal(spark), 0.97, rows).collect():
        xs = _clips()[r.clip]
        assert math.isclose(r.y, xs[r.i] - (0.97 * xs[r.i - 1] if r.i else 0.0))


def _frames_of(xs, size, hop):
    padded = xs + [0.0] * (-len(xs) % hop)
    return [padded[at : at + size] for at in range(0, len(padded) - size + 1, hop)]


@pytest.mark.parametrize("rows", [3, 1000])
@pytest.mark.parametrize("size,hop", [(10, 4), (4, 4), (3, 5)])
def test_framing_mask_and_segments(spark, rows, size, hop):
    energies = series.frame_energy(series.overlap_frames(_signal(spark), size, hop, rows))
    mask = series.speech_mask(energies, 0.9, rows)
    found = sorted((r.clip, r.start, r.end) for r in series.segments(mask, rows).collect())
    expected = []
    for clip, xs in _clips().items():
        energy = [sum(x * x for x in frame) for frame in _frames_of(xs, size, hop)]
        speech = [e > 0.9 * sum(energy) / len(energy) for e in energy]
        start = None
        for at, on in enumerate([*speech, False]):
            if on and start is None:
                start = at
            elif not on and start is not None:
                expected.append((clip, start, at))
                start = None
    assert found == sorted(expected)


@pytest.mark.parametrize("rows", [1, 4, 1000])
def test_segments_cover_the_speech_frames(spark, rows):
    rng = random.Random(3)
    flags = [(0, i, rng.random() < 0.8) for i in range(60)] + [(1, i, True) for i in range(20)]
    mask = spark.createDataFrame(flags, "clip int, frame bigint, speech boolean")
    found = series.segments(mask, rows).collect()
    covered = sorted((r.clip, i) for r in found for i in range(r.start, r.end))
    assert covered == sorted((c, i) for c, i, on in flags if on)
    assert sum(r.clip == 1 for r in found) == 1


def _frame_rows(spark):
    rng = random.Random(5)
    rows = []
    for video, n in {"hot": 50, "one": 1, "two": 2, "three": 3}.items():
        at = 0.0
        for i in range(n):
            at += rng.choice([0.5, 1.0, 9.0])
            rows.append((video, i, at, [rng.random(), rng.random()]))
    rng.shuffle(rows)
    schema = "video_name string, frame_number bigint, timestamp double, features array<double>"
    return rows, spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_smoothing_windows(spark, partitions):
    rows, frames = _frame_rows(spark)
    by_video = {}
    for video, i, _, features in sorted(rows):
        by_video.setdefault(video, []).append(features)
    found = series.window_collect(frames, partitions=partitions).collect()
    assert len(found) == len(rows)
    for r in found:
        window = by_video[r.video_name][max(0, r.frame_number - 1) : r.frame_number + 2]
        assert r.features_in_window == window


def test_frames_of_one_second_spread(spark):
    """A video whose frames all have one time is dealt to many tasks, and its windows stay right."""
    rows = [("a.mp4", i, 1.0, [float(i)]) for i in range(400)]
    schema = "video_name string, frame_number bigint, timestamp double, features array<double>"
    frames = spark.createDataFrame(rows, schema)
    dealt = ordered.with_edge_rows(frames, ["video_name"], ["timestamp", "frame_number"], 8)
    own = dealt.where("not _copied").groupBy("_range").count().collect()
    assert len(own) == 8 and max(r["count"] for r in own) < 150
    assert dealt.where("_copied").count() == 14
    for r in series.window_collect(frames, partitions=8).collect():
        near = range(max(0, r.frame_number - 1), min(400, r.frame_number + 2))
        assert r.features_in_window == [[float(i)] for i in near]


def test_windows_of_nothing(spark):
    frames = _frame_rows(spark)[1]
    assert series.window_collect(frames.limit(0)).count() == 0


def test_smoothing_values(spark):
    rows, frames = _frame_rows(spark)
    side = math.exp(-0.5)
    for r in series.smooth(frames).collect():
        window = r.features_in_window
        mean = [sum(v[d] for v in window) / len(window) for d in range(2)]
        assert r.smoothed_features == pytest.approx(mean)
        if len(window) == 3:
            expected = [
                (side * window[0][d] + window[1][d] + side * window[2][d]) / (1 + 2 * side)
                for d in range(2)
            ]
        else:
            expected = window[len(window) // 2]
        assert r.gaussian_smoothed_features == pytest.approx(expected)


def test_smoothing_a_constant_changes_nothing(spark):
    frames = _frame_rows(spark)[1].withColumn("features", F.array(F.lit(0.25), F.lit(-3.0)))
    for r in series.smooth(frames).collect():
        assert r.smoothed_features == pytest.approx([0.25, -3.0])
        assert r.gaussian_smoothed_features == pytest.approx([0.25, -3.0])


def test_clip_shorter_than_one_frame(spark):
    records = {r.clip: r for r in series.clip_records(_signal(spark), 400, 10, 4).collect()}
    assert records["two"].transcript.startswith("[Transcription error")
    assert (records["two"].num_segments, records["two"].duration) == (0, 0.0)
    assert records["hot"].duration == 0.25 and records["hot"].num_segments > 0
