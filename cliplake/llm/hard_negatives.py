"""Hard-negative mining with an inverted multi-index, exact by certified stops.

Vectors are cut into two halves.  Two codebooks, one per half, are fitted on a bounded sample; the
pair of nearest codewords is a row's cell.  All rows are stored in shards, sorted by cell, with the
radius of each codeword in the shard (the largest distance of its rows).  For an anchor, a half of
any row of codeword c scores at most  anchor half . c + |anchor half| * radius(c);  a heap visits the
cells of a shard by the sum of both halves' bounds, the highest first (the multi-sequence order), and
stops when the next sum is below everything that is still wanted.  What it has not seen then cannot
belong to the result, so the result equals a full comparison.

First every anchor's best rows of its own label are found (positives).  Their scores give each
positive its window of scores; the second visit keeps the best rows of other labels in each window.
Anchors are taken from the index in blocks of a bounded size, each broadcast; a task keeps a few
rows per anchor of the block and carries its thresholds from shard to shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliplake.runtime import Scratch

from . import words

#: Codewords of each half, and how often the fit moves them.
CODEWORDS, ROUNDS = 16, 10
#: Components of the sample that the codebooks are fitted on (rows with the smallest digests of ids).
SAMPLE = 1 << 20
#: Components of a shard and of a block of anchors.
SHARD, BLOCK = 1 << 20, 1 << 21
#: Rows that are scored together.
CHUNK = 512
#: Carried for a missing id; sorts behind all others.
NO_ID = np.iinfo(np.int64).max
#: Doubles hold whole numbers up to here exactly.
EXACT = 2.0**53

_longs = T.ArrayType(T.LongType())
INDEX = T.StructType(
    [T.StructField(name, kind) for name, kind in (
        ("ids", _longs), ("labels", _longs), ("anchors", T.ArrayType(T.BooleanType())),
        ("cells", T.ArrayType(T.IntegerType())), ("vectors", T.ArrayType(T.DoubleType())),
    )]
)
FOUND = "anchor long, slot int, id long, key long, score long"


def points(rows: DataFrame, id: str, vector: str, label: str | Column, anchor: Column) -> DataFrame:
    """id, label, anchor, vector of the rows that take part, the vectors of the usual length only."""
    name = label if isinstance(label, Column) else F.col(f"`{label}`")
    named = rows.select(
        F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(int(NO_ID))).alias("id"),
        name.alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    kind = named.schema["label"].dataType
    number = F.col("label").cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64("label")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # A null list, or one with a null in it, gives null here and does not take part.
    named = named.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("label", number)
    lengths = named.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").first()
    return named.where(F.size("vector") == (usual["length"] if usual else 0))


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(rows @ centres.T - 0.5 * np.sum(centres**2, axis=1), axis=1)


def codebook(sample: np.ndarray, codewords: int = CODEWORDS, rounds: int = ROUNDS) -> np.ndarray:
    """K-means centres of a sample; the first rows, spread evenly over it, are the seeds."""
    distinct = np.unique(sample, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(codewords, len(distinct))).astype(int)]
    for _ in range(rounds):
        nearest = _nearest(sample, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def codebooks(chosen: DataFrame, scale: float, codewords: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres for both halves, fitted on a sample of at most ``SAMPLE`` components (one row at least)."""
    first = chosen.select(F.size("vector")).first()
    dim = first[0] if first else 0
    sample = chosen.orderBy(F.xxhash64("id"), "id").limit(max(1, SAMPLE // max(dim, 1))).select("vector")
    flat = sample.toArrow()["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    grid = np.floor(scale * flat.reshape(-1, max(dim, 1))) if dim else np.zeros((1, 0))
    if not len(grid):
        grid = np.zeros((1, dim))
    half = dim // 2
    return codebook(grid[:, :half], codewords), codebook(grid[:, half:], codewords)


def build(chosen: DataFrame, books: tuple[np.ndarray, np.ndarray], scale: float) -> DataFrame:
    """The index: shards of at most ``SHARD`` components, rows sorted by cell."""
    shared = chosen.sparkSession.sparkContext.broadcast(books)
    half = books[0].shape[1]
    dim = half + books[1].shape[1]
    limit = max(1, SHARD // max(dim, 1))

    def shard(table: pa.Table) -> pa.RecordBatch:
        first, second = shared.value
        n = table.num_rows
        columns = {name: table.column(name).to_numpy() for name in ("id", "label", "anchor")}
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        grid = np.floor(scale * flat.reshape(n, dim))
        cells = _nearest(grid[:, :half], first) * len(second) + _nearest(grid[:, half:], second)
        order = np.lexsort((columns["id"], cells))
        one = lambda values: words.list_column(pa.array(values), np.array([len(values)]))
        return pa.RecordBatch.from_arrays(
            [
                one(columns["id"][order]),
                one(columns["label"][order]),
                one(columns["anchor"][order]),
                one(cells[order].astype(np.int32)),
                one(grid[order].ravel()),
            ],
            INDEX.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                end = min(batch.num_rows, at + limit - rows)
                waiting.append(batch.slice(at, end - at))
                rows, at = rows + end - at, end
                if rows == limit:
                    yield shard(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
        if waiting:
            yield shard(pa.Table.from_batches(waiting))

    return chosen.mapInArrow(run, INDEX).withColumn("shard", F.monotonically_increasing_id())


class Anchors:
    """Anchors of a block: keys, ids, labels, whole components, bounds against all codewords."""

    def __init__(self, table: pa.Table, books: tuple[np.ndarray, np.ndarray]) -> None:
        self.keys = table["key"].to_numpy()
        self.labels = table["label"].to_numpy()
        half = books[0].shape[1]
        dim = half + books[1].shape[1]
        self.grid = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        self.largest = float(np.abs(self.grid).max(initial=0.0))
        self.books = books
        self.dots, self.norms = [], []
        for part, book in zip((self.grid[:, :half], self.grid[:, half:]), books, strict=True):
            self.dots.append(part @ book.T)
            self.norms.append(np.sqrt(np.sum(part**2, axis=1)))


class Shard:
    """Rows of one shard by cell, with the radius of each codeword."""

    def __init__(self, batch: pa.RecordBatch, row: int, books: tuple[np.ndarray, np.ndarray]) -> None:
        values = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)
        self.ids, self.labels = values("ids"), values("labels")
        half = books[0].shape[1]
        self.grid = values("vectors").reshape(len(self.ids), half + books[1].shape[1])
        self.keys = (batch.column("shard")[row].as_py() << 20) + np.arange(len(self.ids))
        cells = values("cells")
        self.width = len(books[1])
        self.starts = np.searchsorted(cells, np.arange(len(books[0]) * self.width + 1)).tolist()
        self.largest = float(np.abs(self.grid).max(initial=0.0))
        self.radii = []
        parts = (self.grid[:, :half], cells // self.width), (self.grid[:, half:], cells % self.width)
        for (part, code), book in zip(parts, books, strict=True):
            radius = np.full(len(book), -np.inf)
            np.maximum.at(radius, code, np.sqrt(np.sum((part - book[code]) ** 2, axis=1)))
            self.radii.append(radius)

    def visit(self, anchors: Anchors, a: int) -> Iterator[tuple[float, int, int]]:
        """Non-empty cells as (bound, first row, end row), the highest bound first."""
        order, bounds = [], []
        for half in (0, 1):
            bound = anchors.dots[half][a] + anchors.norms[half][a] * self.radii[half]
            # Codewords without rows have a radius, and so a bound, of minus infinity.
            some = np.flatnonzero(self.radii[half] >= 0)
            ranked = some[np.argsort(-bound[some], kind="stable")]
            order.append(ranked.tolist())
            bounds.append(bound[ranked].tolist())
        (rows, columns), (first, second) = order, bounds
        # The margin covers the rounding of bounds.
        margin = 1e-6 * (1 + abs(first[0]) + abs(second[0])) if rows else 0
        heap, met = [(-(first[0] + second[0]), 0, 0)] if rows else [], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(rows) and y < len(columns) and (x, y) not in met:
                    met.add((x, y))
                    heapq.heappush(heap, (-(first[x] + second[y]), x, y))
            cell = rows[i] * self.width + columns[j]
            if self.starts[cell] < self.starts[cell + 1]:
                yield margin - bound, self.starts[cell], self.starts[cell + 1]

    def scores(self, rows: np.ndarray, anchors: Anchors, a: int) -> np.ndarray:
        """Whole inner products; beyond 64 bits they stay at the last value."""
        if self.largest * anchors.largest * max(1, self.grid.shape[1]) < EXACT:
            return (self.grid[rows] @ anchors.grid[a]).astype(np.int64)
        whole = [int(x) for x in anchors.grid[a]]
        last = np.iinfo(np.int64).max
        sums = [sum(int(x) * y for x, y in zip(row, whole, strict=True)) for row in self.grid[rows].tolist()]
        return np.array([min(max(s, -last), last) for s in sums], np.int64)


class Best:
    """The k best rows within a window of scores; ties by id, then by place."""

    def __init__(self, k: int, low: int, high: int) -> None:
        self.k, self.low, self.high = k, low, high
        self.rows = np.empty((3, 0), np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        fit = (scores >= self.low) & (scores <= self.high)
        if not fit.any():
            return
        joined = np.concatenate((self.rows, np.stack((scores[fit], ids[fit], keys[fit]))), axis=1)
        if joined.shape[1] > self.k:
            joined = joined[:, np.lexsort((joined[2], joined[1], -joined[0]))[: self.k]]
        self.rows = joined
        if joined.shape[1] == self.k:
            self.low = max(self.low, int(joined[0].min()))


def _search(shard: Shard, anchors: Anchors, a: int, same: bool, wanted: list[Best]) -> None:
    """Offer the rows of a shard in the order of their cells, until none can be wanted."""
    need = min(best.low for best in wanted)
    taken, size = [], 0

    def score() -> None:
        rows = np.concatenate(taken)
        fit = (shard.labels[rows] == anchors.labels[a]) == same
        rows = rows[fit & (shard.keys[rows] != anchors.keys[a])]
        scores = shard.scores(rows, anchors, a)
        some = scores >= need
        rows, scores = rows[some], scores[some]
        if len(rows):
            for best in wanted:
                best.offer(scores, shard.ids[rows], shard.keys[rows])

    for bound, start, end in shard.visit(anchors, a):
        if bound < need:
            break
        taken.append(np.arange(start, end))
        size += end - start
        if size >= CHUNK:
            score()
            taken, size = [], 0
            need = min(best.low for best in wanted)
    if taken:
        score()


def _found(index: DataFrame, anchors, windows, same: bool, k: int) -> DataFrame:
    """The k best rows of every task for every (anchor, slot); ``windows`` lists (slot, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = anchors.value
        wanted = [[Best(k, low, high) for _, low, high in of] for of in windows.value]
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row, block.books)
                for a, best in enumerate(wanted):
                    if best:
                        _search(shard, block, a, same, best)
        for a, best in enumerate(wanted):
            for (slot, _, _), one in zip(windows.value[a], best, strict=True):
                n = one.rows.shape[1]
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, block.keys[a])),
                            pa.array(np.full(n, slot, np.int32)),
                            pa.array(one.rows[1]),
                            pa.array(one.rows[2]),
                            pa.array(one.rows[0]),
                        ],
                        ["anchor", "slot", "id", "key", "score"],
                    )

    found = index.mapInArrow(run, FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(scratch, index, rows: pa.Table, books, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    anchors = Anchors(rows, books)
    shared = context.broadcast(anchors)
    last = int(np.iinfo(np.int64).max)
    every = context.broadcast([[(0, -last, last)]] * len(anchors.keys))
    best = scratch.staged(_found(index, shared, every, True, positives), "positives")
    windows: list[list] = [[] for _ in anchors.keys]
    place = {key: a for a, key in enumerate(anchors.keys.tolist())}
    for anchor, rank, score in best.select("anchor", "rank", "score").collect():
        least, most = -(-low * score // 100), high * score // 100
        if least <= most:
            windows[place[anchor]].append((rank, max(least, -last), min(most, last)))
    found = _found(index, shared, context.broadcast(windows), False, negatives)
    positive = best.select(
        "anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return scratch.staged(found.join(positive, ["anchor", "slot"]), "negatives")


def mine(
    rows: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
    codewords: int = CODEWORDS,
) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Components become floor(scale * x); a score is the whole inner product with the anchor.  The
    positives of an anchor are its ``positives`` best other rows of its label; negatives are the best
    rows of other labels with low * positive <= 100 * negative <= high * positive.  Ties go to the
    smaller id.  Rows with a null label, a null vector or a null, NaN or infinite component take no
    part, nor do vectors of another length than most rows have (of equally many the shorter).  Rows
    that repeat an id or a vector are rows of their own, also as anchors; rows without an id take part
    as well, behind all ids.  Empty tables, anchors without positives and positives without negatives
    give no rows.  Scores beyond 64 bits count as the last 64-bit value.  Other columns are not read.
    """
    scratch = Scratch(rows.sparkSession)
    chosen = points(rows, id, vector, label, anchor)
    books = codebooks(chosen, scale, codewords)
    index = scratch.staged(build(chosen, books, scale), "index")
    dim = books[0].shape[1] + books[1].shape[1]

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                at = np.flatnonzero(values("anchors"))
                grid = values("vectors").reshape(-1, dim)[at] if dim else np.zeros((len(at), 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((batch.column("shard")[row].as_py() << 20) + at),
                        pa.array(values("ids")[at]),
                        pa.array(values("labels")[at]),
                        words.list_column(pa.array(grid.ravel()), np.full(len(at), dim)),
                    ],
                    ["key", "id", "label", "vector"],
                )

    anchors = index.mapInArrow(anchors_of, "key long, id long, label long, vector array<double>")
    anchors = scratch.staged(anchors, "anchors")
    blocks = -(-anchors.count() * max(dim, 1) // BLOCK)
    found = None
    for block in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).toArrow()
        if part.num_rows:
            more = _block(scratch, index, part, books, positives, negatives, low, high)
            found = more if found is None else found.unionByName(more)
    names = anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    if found is None:
        found = names.limit(0).selectExpr(
            "anchor", "0 as slot", "0L as id", "0L as key", "0L as score", "0 as rank", "0L as positive_id", "0L as positive_score"
        )
    plain = lambda name: F.nullif(F.col(name), F.lit(int(NO_ID))).alias
    result = found.join(names, "anchor").select(
        plain("anchor_id")("anchor_id"),
        plain("positive_id")("positive_id"),
        "rank",
        plain("id")("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    return scratch.result(result, "hard-negatives")
