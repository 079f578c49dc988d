"""MinHash near-deduplication with b-bit signatures.

1. Every text becomes the set of its distinct word shingles (64-bit hashes), its
   MinHash minima, band keys of the full minima, and a packed signature that keeps the low two
   bits of each minimum.
2. Texts with equal sets form a class; only the smallest id of a class goes on.
3. Texts that share a band key are candidates.  Within a bucket similarities are estimated by
   counting equal signature slots, corrected for slots that agree by chance; a maximum spanning
   tree of the estimates gives the candidate links, one less than the bucket has texts.
4. Candidate links are confirmed on the full sets; components come from the confirmed links.
5. Where a bucket still holds several components, the texts outside its largest one meet the whole
   bucket; pairs of different components with a sufficient estimate are checked on the full sets in
   place, and only confirmed links leave the task.  Every candidate pair is thus either inside one
   component or was checked.

A bucket of more than ``BUCKET`` texts is dealt out over several tasks by a hash that differs per
band; step 5 meets the pairs that this separates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import Scratch
from . import words
from .components import components

SHINGLE = 5
PERCENT = 80
SLOTS, BANDS, ROWS = 128, 25, 5
BUCKET = 2048
#: Estimates below the limit less this (four standard deviations) are not worth a check.
MARGIN = 0.17

_random = np.random.default_rng(20)
_FACTORS = _random.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD_SLOTS = np.uint64(0x5555555555555555)

SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("signature", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
SET = T.StructType([T.StructField("shingles", T.BinaryType())])
PAIRS = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
    ]
)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in rising order, and their bounds by row.

    A text of fewer words than ``size`` has one shingle, all its words; without words it has none.
    """
    data, bounds = words.utf8(column)
    hashes, starts, _ = words.runs(data, bounds, words.NOT_SPACE, lower=True)
    firsts = words.row_ranges(starts, bounds)
    counts = np.diff(firsts)
    rows = words.row_of(firsts)
    whole = words.shingles(hashes, size)
    inside = np.arange(len(whole)) + size <= firsts[rows[: len(whole)] + 1]
    values, owners = [whole[inside]], [rows[: len(whole)][inside]]
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        if len(short):
            grid = hashes[firsts[short][:, None] + np.arange(length)]
            joined = np.zeros(len(short), np.uint64)
            for i in range(length):
                joined = words.mix(joined + grid[:, i] + np.uint64(length))
            values.append(joined)
            owners.append(short)
    whole, rows = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((whole, rows))
    whole, rows = whole[order], rows[order]
    new = np.ones(len(whole), bool)
    new[1:] = (whole[1:] != whole[:-1]) | (rows[1:] != rows[:-1])
    return whole[new], np.searchsorted(rows[new], np.arange(len(bounds)), "left")


def _minima(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Smallest value of each of the SLOTS hash functions in every (non-empty) set."""
    spread = words.mix(values + np.uint64(1))
    out = np.empty((len(firsts), SLOTS), np.uint64)
    for slot in range(SLOTS):
        out[:, slot] = np.minimum.reduceat(spread * _FACTORS[slot], firsts)
    return out


def _signed(size: int):
    def found(column: pa.Array) -> pa.StructArray:
        values, edges = shingle_sets(column, size)
        counts = np.diff(edges)
        full = np.flatnonzero(counts)
        set_a = np.zeros(len(counts), np.uint64)
        set_b = np.zeros(len(counts), np.uint64)
        packed = np.zeros((len(counts), SLOTS // 32), np.uint64)
        keys = np.empty((0, BANDS), np.uint64)
        if len(full):
            firsts = edges[:-1][full]
            set_a[full] = np.add.reduceat(words.mix(values), firsts)
            set_b[full] = np.add.reduceat(words.mix(values ^ np.uint64(0xABCDEF0123456789)), firsts)
            minima = _minima(values, firsts)
            low = words.mix(minima) & np.uint64(3)
            for word in range(SLOTS // 32):
                for slot in range(32):
                    packed[full, word] |= low[:, word * 32 + slot] << np.uint64(2 * slot)
            grid = minima[:, : BANDS * ROWS].reshape(len(full), BANDS, ROWS)
            keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(full), BANDS))
            for row in range(ROWS):
                keys = words.mix(keys * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, row])
        raw = packed.tobytes()
        width = SLOTS // 4
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(set_a.view(np.int64)),
                pa.array(set_b.view(np.int64)),
                pa.array([raw[i * width : (i + 1) * width] for i in range(len(counts))], pa.binary()),
                words.list_column(
                    pa.array(np.ascontiguousarray(keys).ravel().view(np.int64)), BANDS * (counts > 0)
                ),
            ],
            [field.name for field in SIGNED],
        )

    return found


def _as_bytes(size: int):
    """Full sets as 8 bytes per shingle, in rising order."""

    def found(column: pa.Array) -> pa.StructArray:
        values, edges = shingle_sets(column, size)
        raw = values.astype("<u8").tobytes()
        cells = [raw[8 * a : 8 * b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.StructArray.from_arrays([pa.array(cells, pa.binary())], ["shingles"])

    return found


def _similar(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of one signature and many: equal slots, corrected for chance."""
    differ = one ^ many
    differ = (differ | (differ >> np.uint64(1))) & _ODD_SLOTS
    equal = 1 - np.bitwise_count(differ).sum(axis=-1) / SLOTS
    return (equal - 0.25) / 0.75


def _tree(ids: np.ndarray, sizes: np.ndarray, signs: np.ndarray, limit: float) -> list:
    """Links of a maximum spanning forest of the estimates of at least ``limit``."""
    n = len(ids)
    best, link = np.full(n, -1.0), np.zeros(n, np.int64)
    outside = np.ones(n, bool)
    current, out = 0, []
    for _ in range(n - 1):
        outside[current] = False
        estimate = _similar(signs[current], signs)
        estimate[np.minimum(sizes, sizes[current]) < (limit + MARGIN - 1e-9) * np.maximum(sizes, sizes[current])] = -1
        better = outside & (estimate > best)
        best[better] = estimate[better]
        link[better] = current
        nearest = int(np.argmax(np.where(outside, best, -2)))
        if best[nearest] >= limit:
            x, y = ids[nearest], ids[link[nearest]]
            out.append((min(x, y), max(x, y)))
        current = nearest
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold whole groups (equal key and salt, which the rows are sorted by)."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch if left is None else pa.concat_batches([left, batch])
        edges = _edges(batch)
        left = batch.slice(edges[-2])
        if edges[-2]:
            yield batch.slice(0, edges[-2]), edges[:-1]
    if left is not None:
        yield left, _edges(left)


def _edges(batch: pa.RecordBatch) -> np.ndarray:
    key, salt = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "salt"))
    new = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
    return np.concatenate(([0], np.flatnonzero(new) + 1, [len(key)]))


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SLOTS // 32)


def _rows_of(batch: pa.RecordBatch) -> tuple:
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    return ids, batch.column("n_shingles").to_numpy(zero_copy_only=False), _signs(batch.column("signature"))


def _as_batch(links: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(x[0]) for x in links], pa.int64()),
            pa.array([int(x[1]) for x in links], pa.int64()),
        ],
        [field.name for field in PAIRS],
    )


def _trees(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in _groups(batches):
            ids, sizes, signs = _rows_of(batch)
            links = []
            two = edges[:-1][np.diff(edges) == 2]
            if len(two):
                x, y = np.minimum(ids[two], ids[two + 1]), np.maximum(ids[two], ids[two + 1])
                small = np.minimum(sizes[two], sizes[two + 1])
                near = (_similar(signs[two], signs[two + 1]) >= limit) & (
                    small >= (limit + MARGIN - 1e-9) * np.maximum(sizes[two], sizes[two + 1])
                )
                links += zip(x[near], y[near], strict=True)
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi - lo > 2:
                    links += _tree(ids[lo:hi], sizes[lo:hi], signs[lo:hi], limit)
            yield _as_batch(list(set(links)))

    return run


def _candidates(batch: pa.RecordBatch, edges: np.ndarray, limit: float) -> Iterator[tuple]:
    """(probe row, rows of other components worth a check, best estimate first) of whole groups.

    A pair that shares several buckets is met in all of them and belongs to its first common band.
    """
    ids, sizes, signs = _rows_of(batch)
    part = batch.column("component").to_numpy(zero_copy_only=False)
    probe = batch.column("probe").to_numpy(zero_copy_only=False)
    key = batch.column("key").to_numpy(zero_copy_only=False)
    bands = batch.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        base = lo + np.flatnonzero(~probe[lo:hi])
        for x in lo + np.flatnonzero(probe[lo:hi]):
            small = np.minimum(sizes[x], sizes[base])
            fit = (small >= (limit + MARGIN - 1e-9) * np.maximum(sizes[x], sizes[base])) & (part[base] != part[x])
            near = base[fit]
            estimate = _similar(signs[x], signs[near])
            near, estimate = near[estimate >= limit], estimate[estimate >= limit]
            if len(near):
                common = bands[near] == bands[x]
                own = bands[x, common.argmax(axis=1)] == key[x]
                near, estimate = near[own], estimate[own]
            if len(near):
                yield x, near[np.argsort(-estimate, kind="stable")], ids, part


def _live(limit: float):
    """The rows of open buckets that have a pair to check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in _groups(batches):
            live = np.zeros(batch.num_rows, bool)
            for x, near, _, _ in _candidates(batch, edges, limit):
                live[x] = True
                live[near] = True
            yield batch.filter(pa.array(live))

    return run


def _cross_links(limit: float, percent: int):
    """Confirmed links between components of a bucket; once two are linked, no more is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in _groups(batches):
            cells, links, root = batch.column("shingles"), [], {}
            group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            sets: dict[int, np.ndarray] = {}

            def top(node: tuple) -> tuple:
                while (up := root.get(node, node)) != node:
                    node = up
                return node

            def members(row: int) -> np.ndarray:
                if row not in sets:
                    sets[row] = _wide(cells[row])
                return sets[row]

            for x, near, ids, part in _candidates(batch, edges, limit):
                if sets and group[x] != group[min(sets)]:
                    sets.clear()
                for y in near.tolist():
                    a, b = top((group[x], part[x])), top((group[x], part[y]))
                    if a != b and _alike(members(x), members(y), percent):
                        root[a] = b
                        links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
            yield _as_batch(links)

    return run


def _wide(cell: pa.Scalar) -> np.ndarray:
    """The hashes of a packed set."""
    return np.frombuffer(cell.as_buffer(), "<u8")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches the limit."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    shared = int((y[at] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    side = lambda name: sets.select(
        F.col("id").alias(name), F.col("shingles").alias(f"set_{name}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            keep = [_alike(_wide(x), _wide(y), percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, PAIRS)


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: components of texts with similar shingle sets.

    component_id is the smallest id reachable over links of a Jaccard similarity of at least
    ``percent`` / 100; kept marks its row.  A null or empty text has no shingle and links with
    nothing.  Rows that repeat an id are rows of their own with the same result.  Ids are integers;
    a row with a null id is never kept, has a null component_id and links nothing.  An empty table
    gives an empty result.  Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    staged = scratch.staged
    limit = percent / 100 - MARGIN
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = staged(
        words.unpacked(words.per_text(source, "text", SIGNED, _signed(size), ["id"], 2 << 20), *SIGNED.names),
        "signatures",
    )
    filled = signed.where("n_shingles > 0 and id is not null")
    classes = staged(
        filled.groupBy("n_shingles", "set_a", "set_b", "signature", "bands").agg(F.min("id").alias("id")),
        "classes",
    )
    keys = classes.select("id", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(
        keys.join(sizes, "key").join(classes.select("id", "n_shingles", "signature"), "id"), "buckets"
    )
    parts = F.ceil(F.col("size") / BUCKET)
    salt = F.pmod(F.xxhash64("id", "key"), parts)
    dealt = members.withColumn("salt", salt).repartition("key", "salt").sortWithinPartitions("key", "salt", "id")
    pairs = staged(
        dealt.select("key", "salt", "id", "n_shingles", "signature").mapInArrow(_trees(limit), PAIRS).distinct(),
        "pairs",
    )
    wanted = staged(members.select("id").distinct(), "wanted")
    # Every row of an id that repeats has the same class, one of them is enough.
    texts = words.of_ids(source, wanted).dropDuplicates(["id"])
    sets = staged(
        words.unpacked(words.per_text(texts, "text", SET, _as_bytes(size), ["id"], 4 << 20), "shingles"),
        "sets",
    )
    links = staged(_confirmed(pairs, sets, percent), "links")
    parted = components(links, scratch)
    added = staged(_open_buckets(members, classes, parted, sets, limit, percent, staged).distinct(), "links")
    if added.limit(1).count():
        parted = components(links.union(added), scratch)
    to_class = classes.select("n_shingles", "set_a", "set_b", F.col("id").alias("first"))
    of_class = to_class.join(parted.withColumnRenamed("node", "first"), "first", "left").withColumn(
        "component", F.coalesce("component", "first")
    )
    joined = signed.select("id", "n_shingles", "set_a", "set_b").join(
        of_class.drop("first"), ["n_shingles", "set_a", "set_b"], "left"
    )
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id"))
    found = joined.select(
        F.col("id").alias(id),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
    return scratch.result(found, "near-duplicates")


def _open_buckets(
    members: DataFrame, classes: DataFrame, parted: DataFrame, sets: DataFrame, limit: float, percent: int,
    staged: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """Confirmed links between the components that still share a bucket."""
    placed = members.join(parted.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    per_part = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = (
        per_part.groupBy("key")
        .agg(F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"))
        .where("parts > 1")
    )
    open_rows = staged(
        placed.join(main, "key").join(classes.select("id", "bands"), "id"), "open-buckets"
    )
    # All texts outside the main component of a bucket meet all texts of the bucket, block by block.
    blocks = F.ceil(F.col("size") / BUCKET).cast("long")
    base = open_rows.withColumn("salt", F.pmod(F.xxhash64("id"), blocks)).withColumn("probe", F.lit(False))
    probes = (
        open_rows.where("component <> main")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("probe", F.lit(True))
    )
    columns = ["key", "salt", "id", "n_shingles", "signature", "bands", "component", "probe"]
    rows = base.select(*columns).union(probes.select(*columns))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("key", "salt").sortWithinPartitions("key", "salt", "id")

    live = staged(dealt(rows).mapInArrow(_live(limit), rows.schema), "live")
    with_sets = live.join(sets, "id").select(*columns, "shingles")
    return dealt(with_sets).mapInArrow(_cross_links(limit, percent), PAIRS)
