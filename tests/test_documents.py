import random
from datetime import datetime

import numpy as np
import pytest
from cliplake.functions import vectors
from cliplake.operators import cluster, documents, kmeans, ordered, report
from cliplake.params import ClusterParams
from cliplake.plans import keyframe_job
from cliplake.runtime import Scratch
from cliplake.sinks import tables
from pyspark.sql import functions as F

NOW = datetime(2024, 5, 6, 7, 8, 9)


def _points(spark, n=300, seed=2):
    rng = random.Random(seed)
    rows = [
        (f"v{i % 4}.mp4", i // 4, float(i // 4), [rng.gauss(i % 3, 0.1), rng.gauss(0, 0.1), 5.0])
        for i in range(n)
    ]
    schema = "video_name string, frame_number bigint, timestamp double, features array<double>"
    return spark.createDataFrame(rows, schema)


def test_standardize(spark):
    scaled = cluster.standardize(_points(spark), "features")
    first = scaled.select(F.col("scaled_features")[0].alias("x"))
    one = first.agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).first()
    assert one.m == pytest.approx(0, abs=1e-9) and one.s == pytest.approx(1)
    constant = scaled.select(F.col("scaled_features")[2])
    assert {r[0] for r in constant.collect()} == {0.0}


def test_cluster_count(spark):
    for rows, expected in {0: 5, 49: 5, 50: 5, 61: 6, 1000: 100}.items():
        counted = spark.range(1).select(cluster.cluster_count(F.lit(rows)).alias("k"))
        assert counted.first().k == expected


def _assigned(spark, params):
    return kmeans.assign(
        _points(spark), ["video_name", "frame_number"], "features", params
    ).collect()


def test_kmeans_gives_the_clusters_asked_for(spark):
    rows = _assigned(spark, ClusterParams())
    assert len({(r.video_name, r.frame_number) for r in rows}) == len(rows) == 300
    assert {r.cluster for r in rows} == set(range(30))
    groups = {}
    for r in rows:
        groups.setdefault(r.cluster, []).append(r)
    for members in groups.values():
        center = [sum(r.features[d] for r in members) / len(members) for d in range(3)]
        for r in members:
            gap = sum((a - b) ** 2 for a, b in zip(r.features, center)) ** 0.5
            assert r.distance == pytest.approx(gap, abs=0.05)
    assert sorted(_assigned(spark, ClusterParams())) == sorted(rows)


def _plain(vectors, passes=20):
    """Lloyd passes without pruning, seeded as the operator."""
    import hashlib

    marks = [hashlib.md5(",".join(str(int(np.floor(x * 1e4))) for x in v).encode()).hexdigest() for v in vectors]
    seeds = sorted({mark: i for i, mark in reversed(list(enumerate(marks)))}.items())
    count = max(5, int(0.1 * len(vectors)))
    centers = vectors[[i for _, i in seeds[:count]]]
    for _ in range(passes + 1):
        gaps = kmeans.rounded(np.sqrt(((vectors[:, None] - centers[None]) ** 2).sum(axis=2)))
        nearest = gaps.argmin(axis=1)
        moved = centers.copy()
        for c in set(nearest.tolist()):
            moved[c] = kmeans.rounded(vectors[nearest == c].mean(axis=0))
        if (moved == centers).all():
            break
        centers = moved
    return nearest, gaps.min(axis=1)


@pytest.mark.parametrize("copies, held", [(False, 0), (True, 0), (True, 1 << 20)])
def test_kmeans_equals_plain_passes(spark, monkeypatch, copies, held):
    """Small blocks and groups in many coarse cells, streamed and broadcast: pruning changes nothing."""
    monkeypatch.setattr(kmeans, "HELD", held)
    monkeypatch.setattr(kmeans, "BLOCK_ROWS", 16)
    monkeypatch.setattr(kmeans, "GROUP_CENTERS", 4)
    monkeypatch.setattr(kmeans, "ROWS_PER_CELL", 40)
    pick = np.random.default_rng(3)
    vectors = pick.normal(size=(12, 4))[np.arange(600) % 12] * 10 + pick.normal(size=(600, 4))
    if copies:
        vectors[::3] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assigned = kmeans.assign(spark.createDataFrame(rows, "id long, features array<double>"), ["id"], "features")
    found = {r.id: r for r in assigned.collect()}
    nearest, gaps = _plain(vectors)
    assert [found[i].cluster for i in range(600)] == nearest.tolist()
    assert [found[i].distance for i in range(600)] == pytest.approx(gaps.tolist(), abs=1e-8)


def test_kmeans_prunes(spark, monkeypatch):
    """Far clusters: a block meets its own neighbourhood of centres only."""
    monkeypatch.setattr(kmeans, "BLOCK_ROWS", 50)
    monkeypatch.setattr(kmeans, "GROUP_CENTERS", 5)
    monkeypatch.setattr(kmeans, "ROWS_PER_CELL", 50)
    monkeypatch.setattr(kmeans, "HELD", 0)
    met = []
    near = kmeans.candidates

    def counted(blocks, groups, pairs, few):
        found = near(blocks, groups, pairs, few)
        met.append((found.count(), blocks.count() * groups.count()))
        return found

    monkeypatch.setattr(kmeans, "candidates", counted)
    pick = np.random.default_rng(5)
    vectors = pick.normal(size=(20, 3))[np.arange(1000) % 20] * 1000 + pick.normal(size=(1000, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, features array<double>")
    assert kmeans.assign(rows, ["id"], "features").count() == 1000
    assert met and all(some < every / 3 for some, every in met[1:])


def test_kmeans_inertia(spark):
    """Within one percent of the library's K-means with the same number of clusters."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    pick = np.random.default_rng(7)
    vectors = pick.normal(size=(2000, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, features array<double>")
    own = kmeans.assign(rows, ["id"], "features").agg(F.sum(F.col("distance") ** 2)).first()[0]
    fit = KMeans(k=200, seed=42, maxIter=20).fit(rows.select(array_to_vector("features").alias("features")))
    assert own <= 1.01 * fit.summary.trainingCost


def test_positions(spark):
    rows = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("x"))
    placed = ordered.with_position(rows, ["x"], "place", Scratch(spark)).collect()
    assert [r.x for r in sorted(placed, key=lambda r: r.place)] == sorted(r.x for r in placed)
    assert sorted(r.place for r in placed) == list(range(5000))
    assert ordered.with_position(rows.limit(0), ["x"], "place", Scratch(spark)).collect() == []


def test_kmeans_with_copies_and_few_rows(spark):
    keys, schema = ["id"], "id int, features array<double>"
    # A third of the rows are copies: they are one cluster and keep no other row from its own.
    points = [(i, [float(i), 1.0] if i < 40 else [7.5, 1.0]) for i in range(60)]
    rows = kmeans.assign(spark.createDataFrame(points, schema), keys, "features").collect()
    assert len(rows) == 60 and len({r.cluster for r in rows if r.id >= 40}) == 1
    few = spark.createDataFrame(points[:3], schema)
    assert {r.cluster for r in kmeans.assign(few, keys, "features").collect()} == {0, 1, 2}
    assert kmeans.assign(few.limit(0), keys, "features").count() == 0


def test_keyframes(spark):
    frames = _points(spark, 80)
    chosen = keyframe_job.keyframes(frames).collect()
    assert 1 <= len(chosen) <= 8
    assert len({r.cluster for r in chosen}) == len(chosen)
    order = [(r.video_name, r.timestamp) for r in chosen]
    assert order == sorted(order)


def test_keyframe_ties_and_stats(spark):
    rows = [("b.mp4", 0, 0.0, 1, 2.0), ("a.mp4", 3, 3.0, 1, 2.0), ("a.mp4", 1, 1.0, 2, 0.5)]
    schema = (
        "video_name string, frame_number bigint, timestamp double, cluster int, distance double"
    )
    assigned = spark.createDataFrame(rows, schema)
    chosen = cluster.select_keyframes(assigned)
    kept = {(r.video_name, r.frame_number) for r in chosen.collect()}
    assert kept == {("a.mp4", 3), ("a.mp4", 1)}
    stats = cluster.keyframe_stats(assigned, chosen).collect()
    assert [(r.video_name, r.num_keyframes, r.clusters_represented) for r in stats] == [
        ("a.mp4", 2, [1, 2])
    ]
    parts = cluster.keyframe_stats(assigned, chosen, rows_per_part=1).collect()
    assert sorted((r.part, r.clusters_represented, r.num_keyframes) for r in parts) == [
        (0, [2], 2), (1, [1], 2)
    ]


def test_distance_to_mean(spark):
    points = _points(spark).withColumn("cluster", F.col("frame_number") % 3)
    rows = cluster.distance_to_mean(points, ["video_name", "frame_number"]).collect()
    assert len(rows) == 300
    for number in range(3):
        members = [r for r in rows if r.cluster == number]
        center = [sum(r.features[d] for r in members) / len(members) for d in range(3)]
        for r in members:
            gap = sum((a - b) ** 2 for a, b in zip(r.features, center)) ** 0.5
            assert r.distance == pytest.approx(gap, abs=1e-6)


def test_distance_and_padding(spark):
    row = spark.range(1).select(
        vectors.euclid_distance(F.array(F.lit(0.0), F.lit(3.0)), F.array(F.lit(4.0), F.lit(0.0))),
        vectors.pad_vector(F.array(F.lit(1.0)), 3),
        vectors.pad_vector(F.array(F.lit(1.0), F.lit(2.0)), 1),
    )
    assert list(row.first()) == [5.0, [1.0, 0.0, 0.0], [1.0]]


def test_contains_lookup_equals_brute_force(spark):
    rng = random.Random(9)
    stems = ["".join(rng.choice("ab1") for _ in range(rng.randint(1, 4))) for _ in range(30)]
    texts = ["".join(rng.choice("ab1_") for _ in range(rng.randint(0, 12))) for _ in range(60)]
    left = spark.createDataFrame([(i, s) for i, s in enumerate(stems)], "id int, stem string")
    right = spark.createDataFrame([(t, len(t)) for t in texts], "name string, size int")
    found = documents.contains_lookup(left, "stem", right, "name").collect()
    assert len(found) == len(stems)
    for r in found:
        hits = [t for t in texts if r.stem in t]
        assert r.name == (min(hits) if hits else None)
        assert r.size == (len(r.name) if hits else None)


def _keyframes(spark):
    rows = [("a.mp4", i, float(i), i) for i in range(7)] + [("b.mp4", 2, 2.0, 9)]
    return spark.createDataFrame(
        rows, "video_name string, frame_number bigint, timestamp double, cluster int"
    )


def _texts(spark):
    schema = (
        "filename string, transcript string, summary string, sentiment string,"
        " keywords array<struct<word:string,frequency:bigint>>, duration double"
    )
    rows = [("hdfs://h/u/a.wav", "x", "About <x> & y", "positive", [("x<y", 2)], 1.5)]
    return spark.createDataFrame(rows, schema)


def test_video_documents_in_parts(spark):
    docs = documents.video_documents(
        _keyframes(spark), _texts(spark), NOW, details_per_document=3
    ).collect()
    parts = {(r.video_name, r.part): [d.frame_number for d in r.keyframe_details] for r in docs}
    assert parts == {
        ("a.mp4", 0): [0, 1, 2], ("a.mp4", 1): [3, 4, 5], ("a.mp4", 2): [6], ("b.mp4", 0): [2]
    }
    assert {(r.video_name, r.num_keyframes, r.sentiment) for r in docs} == {
        ("a.mp4", 7, "positive"), ("b.mp4", 1, None)
    }
    assert {r.processing_timestamp for r in docs} == {NOW}


def test_video_facts_are_one_row_per_video(spark):
    keyframes, texts = _keyframes(spark), _texts(spark)
    facts = documents.video_facts(keyframes, texts, NOW).collect()
    assert sorted((r.video_name, r.num_keyframes, r.sentiment) for r in facts) == [
        ("a.mp4", 7, "positive"), ("b.mp4", 1, None)
    ]
    unnamed = keyframes.withColumn("video_name", F.lit(None).cast("string"))
    parts = documents.video_documents(unnamed, texts, NOW, details_per_document=5).collect()
    assert sorted((r.part, r.num_keyframes, len(r.keyframe_details)) for r in parts) == [(0, 8, 5), (1, 8, 3)]


def test_final_summaries_and_report(spark, tmp_path):
    final = documents.final_summaries(_keyframes(spark), _texts(spark))
    totals = report.final_totals(final).first()
    assert (totals.documents, totals.total_keyframes, totals.total_seconds) == (2, 8, 16)
    tables.write_html_report(final, str(tmp_path / "report"))
    page = "".join(
        path.read_text() for path in sorted((tmp_path / "report").glob("part-*"))
    )
    assert page.startswith("<!DOCTYPE html>") and page.rstrip().endswith("</html>")
    assert page.index("a.mp4") < page.index("b.mp4")
    assert "About &lt;x&gt; &amp; y" in page and "x&lt;y (2)" in page
    assert '<p class="positive">POSITIVE</p>' in page and "No summary available" in page


def test_keyed_collection_rewrites_only_what_it_meets(spark, tmp_path):
    root = str(tmp_path / "rows")
    store = tables.KeyedCollection(spark, root, "k", rows_per_bucket=50)
    with pytest.raises(ValueError):
        store.read()
    old = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    assert store.upsert(old).count() == 1000
    before = set(store.read().inputFiles())
    assert len(before) == 20
    new = spark.createDataFrame([(7, "seven"), (5000, "new")], "k long, y string")
    rows = {r.k: (r.x, r.y) for r in store.upsert(new).collect()}
    assert len(rows) == 1001 and rows[7] == (14, "seven") and rows[5000] == (None, "new") and rows[8] == (16, None)
    after = set(store.read().inputFiles())
    assert len(after) == 20 and len(before - after) <= 2
    again = {r.k: (r.x, r.y) for r in store.upsert(new).collect()}
    assert again == rows
    # A write that did not end is not read, and its number is not used again.
    spark.range(1).select(F.lit(1).alias("x")).write.parquet(f"{root}/data-9")
    assert store.read().count() == 1001
    assert store.upsert(new.limit(0)).count() == 1001
    assert tables.KeyedCollection(spark, str(tmp_path / "none"), "k").upsert(new.limit(0)).count() == 0


def test_contains_lookup_by_rare_substrings(spark):
    names = [f"/user/audio/video_{i}.wav" for i in range(2000)] + [None, "", "xy"]
    stems = [f"video_{i}" for i in range(0, 2500, 50)] + ["", None, "xy", "x", "audio", "absent"]
    left = spark.createDataFrame([(s,) for s in stems], "stem string")
    right = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, n int")
    found = {r.stem: r.name for r in documents.contains_lookup(left, "stem", right, "name").collect()}
    for stem in stems:
        fits = sorted(n for n in names if n is not None and stem is not None and stem in n)
        assert found[stem] == (fits[0] if fits else None)
    some = left.where("stem like 'video%'").selectExpr("stem as _stem")
    texts = right.where("name is not null").selectExpr("name as _text")
    pairs = documents.contains_candidates(some, texts)
    matches = pairs.where(F.contains("_text", "_stem")).count()
    assert 0 < matches <= pairs.count() <= 10 * matches
    none = documents.contains_lookup(left.limit(0), "stem", right, "name")
    assert none.count() == 0 and documents.contains_lookup(left, "stem", right.limit(0), "name").count() == len(stems)


def test_upsert(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, x string, y double")
    new = spark.createDataFrame([(2, None, True), (3, "c", False)], "k int, x string, z boolean")
    expected = [(1, "a", 1.0, None), (2, None, 2.0, True), (3, "c", None, False)]
    merged = documents.upsert(old, new, "k")
    assert sorted(map(tuple, merged.collect())) == expected
    assert sorted(map(tuple, documents.upsert(merged, new, "k").collect())) == expected
    store = tables.Collections(spark, str(tmp_path))
    with pytest.raises(ValueError):
        store.read("rows")
    store.upsert(old, "rows", "k")
    stored = store.upsert(new, "rows", "k")
    assert sorted(map(tuple, stored.collect())) == expected
    assert store.overwrite(old, "rows").count() == 2


def test_empty_counts(spark):
    rows = spark.createDataFrame([("positive",), ("other",), (None,)], "sentiment string")
    found = report.count_per_category(rows, "sentiment", ["positive", "neutral"]).collect()
    assert {tuple(r) for r in found} == {("positive", "Positive", 1), ("neutral", "Neutral", 0)}


def test_collections_without_success_marker(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    before = hadoop.get(key)
    hadoop.set(key, "false")
    try:
        store = tables.Collections(spark, str(tmp_path))
        store.upsert(spark.createDataFrame([(1, "a")], "id int, x string"), "c", "id")
        store.upsert(spark.createDataFrame([(2, "b")], "id int, x string"), "c", "id")
        assert sorted(map(tuple, store.read("c").collect())) == [(1, "a"), (2, "b")]
    finally:
        hadoop.set(key, before or "true")


def test_keyed_collection_bounds_its_buckets(spark, tmp_path, monkeypatch):
    """Beyond ``MOST_BUCKETS`` buckets hold more rows instead; the rows are the same."""
    monkeypatch.setattr(tables.KeyedCollection, "MOST_BUCKETS", 4)
    root = str(tmp_path / "bounded")
    store = tables.KeyedCollection(spark, root, "k", rows_per_bucket=2)
    store.upsert(spark.createDataFrame([(i, f"old{i}") for i in range(60)], "k long, name string"))
    new = [(i, f"new{i}") for i in range(50, 70)]
    got = store.upsert(spark.createDataFrame(new, "k long, name string"))
    assert len(list((tmp_path / "bounded" / "data-1").glob("bucket=*"))) == 4
    assert sorted(map(tuple, got.collect())) == sorted([(i, f"old{i}") for i in range(50)] + new)


def test_kmeans_leaves_out_dimensions_in_which_no_rows_differ(spark, monkeypatch):
    pick = random.Random(11)
    rows = [("v", i, [pick.random(), pick.random()]) for i in range(200)]
    padded = [(v, i, [0.0, x, 7.5, y, -1.0]) for v, i, (x, y) in rows]
    seen, passes = [], kmeans._held_passes

    def spied(blocks, seeds, wanted, coarse, *rest):
        seen.append(coarse.value.shape[1])
        return passes(blocks, seeds, wanted, coarse, *rest)

    monkeypatch.setattr(kmeans, "_held_passes", spied)
    # The mark of a vector has all its dimensions, so that the same vectors are seeds.
    monkeypatch.setattr(kmeans, "mark", lambda _: F.md5(F.col("frame_number").cast("string")))
    found = []
    for some in (rows, padded, [(v, i, [3.0, 3.0]) for v, i, _ in rows]):
        frames = spark.createDataFrame(some, "video_name string, frame_number long, scaled_features array<double>")
        own = kmeans.assign(frames, ["video_name", "frame_number"])
        found.append(sorted((r["frame_number"], r["cluster"], r["distance"]) for r in own.collect()))
    assert seen == [2, 2, 1]
    assert found[0] == found[1]
    assert [distance for _, _, distance in found[2]] == [0.0] * 200


def test_kmeans_settled_rows_meet_only_centres_that_moved(monkeypatch):
    pick = np.random.default_rng(5)
    rows, before = pick.normal(size=(400, 3)), pick.normal(size=(40, 3))
    moved = np.arange(40) % 8 == 0
    after = np.where(moved[:, None], before + 0.2, before)
    pairs, squares = [], kmeans._squares
    monkeypatch.setattr(kmeans, "_squares", lambda a, b: pairs.append(len(a) * len(b)) or squares(a, b))

    def met(centers, flags, old=None):
        held = kmeans._Held(centers, np.zeros((1, 3)), {0: 10.0}, flags)
        block = kmeans._Block(np.arange(400), rows.ravel())
        anew = None if old is None else block.known(old.center, old.best, flags)
        pairs.clear()
        return held.met(block, 0, 10.0, anew), sum(pairs)

    first, _ = met(before, np.ones(40, bool))
    whole, all_pairs = met(after, np.ones(40, bool))
    again, few_pairs = met(after, moved, first)
    assert (first.center != whole.center).any()
    assert again.center.tolist() == whole.center.tolist() and again.best.tolist() == whole.best.tolist()
    assert few_pairs < all_pairs / 2
