"""Audio and image features against plain loops."""

import io
import math
import random
import struct
import wave

import numpy as np
import pandas as pd
import pytest
from cliplake.functions import audio, images
from cliplake.operators import catalog
from cliplake.params import AudioParams
from cliplake.plans import keyframe_job
from cliplake.sources import files, listing, views
from cliplake.sources.frame_store import FrameStore
from pyspark.sql import functions as F


def _wav(levels, rate=16000, width=2):
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as clip:
        clip.setnchannels(1)
        clip.setsampwidth(width)
        clip.setframerate(rate)
        clip.writeframes(struct.pack(f"<{len(levels)}{'h' if width == 2 else 'B'}", *levels))
    return buffer.getvalue()


def _tone(n, seed=1):
    rng = random.Random(seed)
    return [int(8000 * math.sin(i / 9) * (i // 900 % 2) + rng.randint(-50, 50)) for i in range(n)]


def _mfcc_by_hand(levels, rate):
    x = [v / 32768 for v in levels]
    y = [x[0]] + [x[i] - 0.97 * x[i - 1] for i in range(1, len(x))]
    size, hop = int(0.025 * rate), int(0.010 * rate)
    y += [0.0] * (-len(y) % hop)
    top = 2595 * math.log10(1 + rate / 2 / 700)
    edges = [
        math.floor(513 * 700 * (10 ** (i * top / 27 / 2595) - 1) / rate) for i in range(28)
    ]
    result = []
    for at in range(0, len(y) - size + 1, hop):
        frame = [
            v * (0.54 - 0.46 * math.cos(2 * math.pi * i / (size - 1)))
            for i, v in enumerate(y[at : at + size])
        ]
        power = np.abs(np.fft.rfft(frame, 512)) ** 2
        logs = []
        for left, center, right in zip(edges, edges[1:], edges[2:]):
            e = sum(power[b] * (b - left) / (center - left) for b in range(left, center))
            e += sum(power[b] * (right - b) / (right - center) for b in range(center, right))
            logs.append(math.log(e or np.finfo(float).eps))
        result.append(
            [
                sum(v * math.cos(math.pi * k * (2 * n + 1) / 52) for n, v in enumerate(logs))
                for k in range(13)
            ]
        )
    return result


def test_clip_records(spark, tmp_path):
    levels = _tone(8000)
    (tmp_path / "a.wav").write_bytes(_wav(levels))
    (tmp_path / "b.wav").write_bytes(_wav([1, 2, 3]))
    (tmp_path / "c.wav").write_bytes(b"no wav")
    found = {r.filename[-5:]: r for r in files.wav_files(spark, [str(tmp_path)]).collect()}
    by_hand = _mfcc_by_hand(levels, 16000)
    assert found["a.wav"].mfcc_features == pytest.approx(np.mean(by_hand, axis=0), abs=1e-6)
    energy = [sum(v * v for v in frame) for frame in by_hand]
    speech = [e > 0.5 * sum(energy) / len(energy) for e in energy]
    starts = sum(on and not before for before, on in zip([False, *speech], speech))
    assert (found["a.wav"].num_segments, found["a.wav"].duration) == (starts, 0.5)
    for name in ["b.wav", "c.wav"]:
        assert found[name].transcript.startswith("[Transcription error: ")
        assert (found[name].num_segments, found[name].mfcc_features) == (0, [])
        assert found[name].error


def test_wav_samples(spark):
    rows = [(1, _wav([0, -32768, 32767])), (2, _wav([0, 255], width=1)), (3, b"x"), (4, None)]
    df = spark.createDataFrame(rows, "id int, content binary")
    found = {r.id: r.w for r in df.select("id", audio.wav_samples("content").alias("w")).collect()}
    assert found[1].samples == pytest.approx([0, -1, 32767 / 32768])
    assert found[2].samples == pytest.approx([0, 255 / 32768])
    assert found[3].error and found[4].error and found[3].samples is None


@pytest.mark.parametrize("rate", [400, 8000, 16000, 44100])
def test_filter_tables_equal_the_matrices(spark, rate):
    params = AudioParams()
    weights = audio._mel_weights(rate, params)
    rows = audio.mel_filterbank(spark, rate).collect()
    assert {r.filter for r in rows} == set(range(26))
    table = np.zeros_like(weights)
    for r in rows:
        table[r.filter, r.bin] = r.weight
    assert np.allclose(table, weights)
    basis = np.zeros((13, 26))
    for r in audio.dct_basis(spark).collect():
        basis[r.k, r.n] = r.factor
    assert np.allclose(basis, audio._dct_weights(params))


def _features_by_hand(image):
    image = np.asarray(image, dtype=float)
    if image.ndim == 3:
        gray = (image @ [114, 587, 299] + 500) // 1000 / 255
        counts = [
            float(((image[..., c] >= b * 8) & (image[..., c] < b * 8 + 8)).sum())
            for c in range(3)
            for b in range(32)
        ]
    else:
        gray, counts = image / 255, [0.0] * 96
    maps = []
    for kernel in images.KERNELS.values():
        height, width = gray.shape
        maps.append(
            [
                sum(kernel[a][b] * gray[i + a][j + b] for a in range(3) for b in range(3))
                for i in range(height - 2)
                for j in range(width - 2)
            ]
        )
    spread = [f(m) for m in maps for f in (np.mean, np.std)]
    stats = [*spread, *map(max, maps), gray.mean(), gray.std(), gray.min(), gray.max()]
    return [*counts, *stats] + [0.0] * (512 - 96 - 13)


def test_image_features(spark):
    rng = np.random.default_rng(4)
    color = rng.integers(0, 256, (6, 5, 3), dtype=np.uint8)
    gray = rng.integers(0, 256, (7, 4), dtype=np.uint8)
    rows = [(1, 6, 5, 3, color.tobytes()), (2, 7, 4, 1, gray.tobytes()), (3, 9, 9, 1, b"short")]
    df = spark.createDataFrame(rows, "id int, height int, width int, channels int, data binary")
    columns = [F.col(c) for c in ["height", "width", "channels", "data"]]
    found = {
        r.id: r
        for r in df.select(
            "id",
            images.frame_features(*columns).alias("features"),
            images.edge_maps(*columns).alias("maps"),
            images.color_histograms(*columns).alias("counts"),
        ).collect()
    }
    assert found[1].features == pytest.approx(_features_by_hand(color), abs=1e-5)
    assert found[2].features == pytest.approx(_features_by_hand(gray), abs=1e-5)
    assert found[3].features == [0.0] * 512
    assert found[3].maps.horizontal is None and found[3].counts is None
    assert sum(found[1].counts) == 90


def test_images_of_many_shapes_in_one_batch(spark, monkeypatch):
    rng = np.random.default_rng(6)
    shapes = [(3, 3, 1), (5, 4, 3), (2, 9, 1), (4, 4, 4), (6, 3, 2), (5, 4, 3), (3, 3, 1)] * 5
    pictures = [rng.integers(0, 256, shape, dtype=np.uint8) for shape in shapes]
    rows = [(i, *p.shape, p.tobytes()) for i, p in enumerate(pictures)] + [(99, None, 3, 1, b"x"), (98, 3, 3, 1, None), (97, -3, -3, 1, b"123456789")]
    df = spark.createDataFrame(rows, "id int, height int, width int, channels int, data binary").coalesce(1)
    found = df.select("id", images.frame_features("height", "width", "channels", "data").alias("features")).collect()
    for row in found:
        sides = shapes[row.id] if row.id < 90 else (0, 0, 0)
        if min(sides[:2]) < 3 or sides[2] == 2:
            assert row.features == [0.0] * 512
        else:
            picture = pictures[row.id]
            by_hand = _features_by_hand(picture[..., 0] if sides[2] == 1 else picture[..., :3])
            assert row.features == pytest.approx(by_hand, abs=1e-5)


def test_frame_store_opens_few_folders(spark, tmp_path):
    rows = [(f"v{i % 3}", i // 3, float(i), bytes([i % 256])) for i in range(3000)]
    # Frame 5 of the first video was never stored.
    frames = spark.createDataFrame(rows, "video_name string, frame_number long, timestamp double, data binary")
    store = FrameStore.write(frames.where("not (video_name = 'v0' and frame_number = 5)"), str(tmp_path / "store"), per_bucket=64)
    assert store.buckets == 47 and store.frames().count() == 2999
    chosen = spark.createDataFrame([("v0", 5, "a"), ("v0", 7, "b"), ("v2", 900, "c")], "video_name string, frame_number long, tag string")
    fetched = store.fetch(chosen, "data")
    assert {tuple(r) for r in fetched.collect()} == {("v0", 5, "a", None), ("v0", 7, "b", b"\x15"), ("v2", 900, "c", bytes([2702 % 256]))}
    scans = fetched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in scans
    assert store.fetch(chosen.limit(0), "data").collect() == []


def test_keyframes_from_pixels(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(f"v{i % 2}", i // 2, float(i // 2), 4, 4, 3, rng.integers(0, 256, 48, dtype=np.uint8).tobytes()) for i in range(80)]
    schema = "video_name string, frame_number long, timestamp double, height int, width int, channels int, data binary"
    store = FrameStore.write(spark.createDataFrame(rows, schema), str(tmp_path / "store"), per_bucket=10)
    found = keyframe_job.from_pixels(store).collect()
    pixels = {(r[0], r[1]): r[6] for r in rows}
    assert 1 <= len(found) <= 8 and all(pixels[r.video_name, r.frame_number] == r.data for r in found)
    assert [(r.video_name, r.timestamp) for r in found] == sorted((r.video_name, r.timestamp) for r in found)


def test_png_files_decode_to_their_pixels(spark, tmp_path):
    pixels = bytes(range(0, 240, 2))
    (tmp_path / "a.png").write_bytes(views._png(10, 12, pixels))
    row = files.images(spark, str(tmp_path)).first()
    assert (row.height, row.width, row.n_channels) == (10, 12, 1)
    assert bytes(row.data) == pixels


def test_folder_scans(spark, tmp_path):
    for folder in ["one", "two", "empty"]:
        (tmp_path / folder).mkdir()
    (tmp_path / "two" / "c d+e%41.mov").write_bytes(b"")
    (tmp_path / "two" / "d d+e%41.mkv").write_bytes(b"1")
    (tmp_path / "one" / "a.mp4").write_bytes(b"12345")
    (tmp_path / "one" / "below").mkdir()
    (tmp_path / "one" / "below" / "z.mp4").write_bytes(b"1")
    (tmp_path / "two" / "b.avi").write_bytes(b"")
    folders = [str(tmp_path / name) for name in ["one", "two", "empty", "missing"]]
    listed = files.media_files(spark, folders)
    found = {r.path.split("/")[-1]: r.length for r in listed.collect()}
    assert found == {"a.mp4": 5, "b.avi": 0, "c d+e%41.mov": 0, "d d+e%41.mkv": 1}
    invalid = catalog.media_listing(listed).where("not is_valid").collect()
    assert {(r.video_id, r.error_message) for r in invalid} == {
        ("b", "Empty file"), ("c d+e%41", "Empty file")
    }
    assert files.media_files(spark, folders[-1:]).count() == 0


@pytest.mark.parametrize("folders", [256, 3])
def test_listing_of_many_nested_files(spark, tmp_path, monkeypatch, folders):
    monkeypatch.setattr(listing, "FOLDERS", folders)
    expected = {}
    for i in range(10_000):
        folder = tmp_path / f"a{i % 7}" / f"b{i % 11}" if i % 3 else tmp_path / f"a{i % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f {i}.mp4").write_bytes(b"x" * (i % 5))
        expected[f"file:{folder}/f {i}.mp4"] = i % 5
    (tmp_path / "a1" / "_SUCCESS").write_bytes(b"")
    root = str(tmp_path)
    reader = listing.ListingReader([root], True)
    assert 1 < len(reader.partitions()) <= folders + 20
    found = files.media_files(spark, [root], recursive=True).collect()
    assert len(found) == 10_000 and {r.path: r.length for r in found} == expected
    upper = files.media_files(spark, [f"{root}/a?"]).collect()
    assert {r.path for r in upper} == {path for path in expected if "/b" not in path[len(root) :]}


def test_optional_json(spark, tmp_path):
    missing = files.optional_json(spark, str(tmp_path / "no"), "a int")
    assert missing.schema.simpleString() == "struct<a:int>" and missing.count() == 0


def test_manifest_file_lines(spark, tmp_path):
    lines = ["id,title"] + [f"v{i},t{i}" for i in range(50)]
    (tmp_path / "m.csv").write_text("\n".join(lines))
    found = files.manifest_lines(spark, str(tmp_path / "m.csv"), 7).collect()
    assert sorted((r.idx, r.line) for r in found) == [(i, f"v{i},t{i}") for i in range(7)]
    spark.createDataFrame([(s,) for s in lines], "value string").repartition(4).write.text(
        str(tmp_path / "parts")
    )
    numbers = [r.line_no for r in files.numbered_lines(spark, str(tmp_path / "parts")).collect()]
    assert sorted(numbers) == list(range(51))


def test_bad_image_is_a_row_with_an_error(spark, tmp_path):
    (tmp_path / "bad.png").write_bytes(b"no image")
    row = files.images(spark, str(tmp_path)).first()
    assert (row["error"], row["data"], row["height"]) == ("not an image", None, None)


def test_every_manifest_has_its_header_dropped(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,url\n" + "".join(f"b{i},u\n" for i in range(50)))
    (tmp_path / "a.csv").write_text("id,url\na0,u\na1,u\n")
    found = files.manifest_lines(spark, str(tmp_path)).orderBy("idx").collect()
    assert [r.idx for r in found] == list(range(52))
    assert [r.line for r in found] == ["a0,u", "a1,u"] + [f"b{i},u" for i in range(50)]


def test_folders_by_pattern(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "one.bin").write_bytes(b"1")
    assert files.binary_files(spark, [str(tmp_path / "*"), str(tmp_path / "none*")]).count() == 1


def test_spectra_are_given_out_in_pieces(monkeypatch):
    """The spectra of a batch of clips, many times its samples, are not held together."""
    monkeypatch.setattr(audio, "SPECTRA_BYTES", 1 << 16)
    clips = [np.sin(np.arange(n) / 7) for n in [64, 5, 64, 0] * 50]
    expected = [None if len(clip) < 64 else audio._power_spectrum(clip, 400, AudioParams()) for clip in clips]
    batch = pd.Series([400] * len(clips)), pd.Series(clips)
    pieces = list(audio._spectra(iter([batch, batch]), AudioParams()))
    held = [sum(len(s) * len(s[0]) * 8 for s in piece if s is not None) for piece in pieces]
    assert len(pieces) > 20 and max(held) <= 2 << 16
    got = [spectrum for piece in pieces for spectrum in piece]
    assert len(got) == 2 * len(clips)
    for mine, theirs in zip(got, expected * 2, strict=True):
        assert (mine is None) == (theirs is None)
        assert mine is None or np.array_equal(np.stack(mine), theirs)
