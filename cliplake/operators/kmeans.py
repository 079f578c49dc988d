"""K-means with a cluster count that grows with the rows: Lloyd passes over all centres, pruned.

Centres are a tenth of the rows here, so neither all of them nor all pairs of rows and centres can be
held or tried.  Rows and centres are both filed under a few coarse cells: rows in *blocks* of one cell
(many vectors in one row of a table), centres in *groups* of one cell.  By the triangle inequality no
row of a block has its nearest centre in a group whose ball is further away than some centre of the
block's own surroundings; such pairs of block and group are never formed.  The others meet in a task
that streams the groups past the block, nearest first, and leaves out a group as soon as every row of
the block has a centre nearer than the group's ball.  A pass is one job: groups meet blocks, blocks
give partial sums per centre, the sums give the next groups.  Centres of at most ``HELD`` components
are broadcast instead of streamed, which gives the same rows with fewer tables.

With broadcast centres every row keeps its nearest centre and its distance from pass to pass.  A row
whose centre has not moved can only change to a centre that has, so it meets no others; only rows whose
centre has moved meet all.  Likewise only centres that a row has joined or left get a new mean.  As
centres settle a pass thus shrinks to the few that still move.

Dimensions in which no two rows differ add nothing to any distance and are left out first.  Pruning
only saves work: the result is that of plain Lloyd passes.  Seeds are the vectors with the
smallest digests, centres are rounded to nine decimals, ties go to the centre with the lower number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliplake.functions import vectors
from cliplake.operators import ordered
from cliplake.params import ClusterParams
from cliplake.runtime import Scratch

#: Rows of a block and centres of a group.
BLOCK_ROWS, GROUP_CENTERS = 2048, 256
#: Rows that a task sorts by cell before it cuts blocks.
GATHERED = 65536
#: Most coarse cells, and rows that call for one more.
CELLS, ROWS_PER_CELL = 256, 8192
#: Rows, with the smallest digests, that the coarse cells are fitted on; cells only steer the pruning.
SAMPLE = 4096
#: Blocks up to which their list of (number, cell, radius) is broadcast.
BROADCAST_BLOCKS = 1_000_000
#: Components of all centres up to which they are broadcast whole in each pass.
HELD = 1 << 22
#: Slack of bounds, far above the rounding of distances.
SLACK = 1e-6

_longs, _doubles = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())
BLOCKS = T.StructType([
    T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType()),
    T.StructField("ids", _longs), T.StructField("vectors", _doubles),
])
#: Blocks after a pass: the nearest centre and distance of every row, and the centres whose rows changed.
STATE = T.StructType([
    *BLOCKS.fields, T.StructField("nearest", _longs), T.StructField("best", _doubles), T.StructField("touched", _longs),
])
GROUPS = T.StructType([
    *BLOCKS.fields, T.StructField("nearest", T.DoubleType()), T.StructField("moved", T.LongType()),
])


def mark(features: Column) -> Column:
    """Digest of a vector to four decimals: equal vectors have one mark, others a random order."""
    return F.md5(F.array_join(F.transform(features, lambda x: F.floor(x * 1e4)), ","))


def rounded(values: np.ndarray) -> np.ndarray:
    """To nine decimals, so that sums taken in another order give the same centres and ties."""
    return np.floor(values * 1e9 + 0.5) / 1e9


def _grid(column: pa.Array, n: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, len(flat) // n) if n else np.zeros((0, 0))


def _one(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _varying(points: DataFrame) -> tuple[list[int], int]:
    """The dimensions in which some rows differ, the first one if none does, and how many there are."""
    model = np.asarray(points.select("_vector").first()[0], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ = np.zeros(len(model), bool)
        for batch in batches:
            differ |= (_grid(batch.column("_vector"), batch.num_rows) != model).any(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(differ), pa.int32())], ["at"])

    found = points.select("_vector").mapInArrow(run, "at int").distinct().collect()
    return sorted(row[0] for row in found) or [0], len(model)


def _squares(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres, up to rounding."""
    return (
        np.sum(rows * rows, axis=1)[:, None] - 2.0 * (rows @ centers.T) + np.sum(centers * centers, axis=1)
    )


def _coarse(points: DataFrame, rows: int) -> np.ndarray:
    """Centres of the coarse cells, from a bounded sample."""
    if rows < 2 * ROWS_PER_CELL:
        return np.array([points.select("_vector").first()[0]])
    sample = points.orderBy("_mark", "_row").limit(SAMPLE).select("_vector").toArrow()
    grid = np.unique(_grid(sample["_vector"].combine_chunks(), sample.num_rows), axis=0)
    cells = min(CELLS, rows // ROWS_PER_CELL, len(grid))
    centers = grid[np.linspace(0, len(grid) - 1, cells).astype(int)]
    for _ in range(5):
        cell = np.argmin(_squares(grid, centers), axis=1)
        sums, counts = np.zeros_like(centers), np.bincount(cell, minlength=cells)
        np.add.at(sums, cell, grid)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def _filed(batches: Iterator[pa.RecordBatch], coarse: np.ndarray, size: int) -> Iterator[tuple]:
    """(cell, ids, vectors, distances to the cell's centre, flags) of at most ``size`` rows each.

    Reads the columns id, vector and flag.
    """

    def cut(table: pa.Table) -> Iterator[tuple]:
        ids, flags = table["id"].to_numpy(), table["flag"].to_numpy()
        grid = _grid(table["vector"].combine_chunks(), table.num_rows)
        cell = np.argmin(_squares(grid, coarse), axis=1)
        for number in np.unique(cell):
            own = np.flatnonzero(cell == number)
            away = np.sqrt(np.sum((grid[own] - coarse[number]) ** 2, axis=1))
            # Shells around the cell's centre have tighter bounds than any mixture.
            own, away = own[np.argsort(away, kind="stable")], np.sort(away)
            for at in range(0, len(own), size):
                some = own[at : at + size]
                yield int(number), ids[some], grid[some], away[at : at + size], flags[some]

    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED:
            yield from cut(pa.Table.from_batches(waiting))
            waiting, rows = [], 0
    if rows:
        yield from cut(pa.Table.from_batches(waiting))


def _blocks(points: DataFrame, coarse) -> DataFrame:
    """Rows filed in numbered blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, ids, grid, away, _ in _filed(batches, coarse.value, BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([cell], pa.int32()), pa.array([away.max()]), _one(ids), _one(grid.ravel())], BLOCKS.names
            )

    named = points.select(F.col("_row").alias("id"), F.col("_vector").alias("vector"), F.lit(0).alias("flag"))
    return named.mapInArrow(run, BLOCKS).withColumn("block", F.monotonically_increasing_id())


def _groups(centers: DataFrame, coarse) -> DataFrame:
    """Centres (id, vector, flag: whether it moved) filed in groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, ids, grid, away, moved in _filed(batches, coarse.value, GROUP_CENTERS):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([cell], pa.int32()),
                    pa.array([away.max()]),
                    _one(ids),
                    _one(grid.ravel()),
                    pa.array([away.min()]),
                    pa.array([int(moved.sum())], pa.int64()),
                ],
                GROUPS.names,
            )

    return centers.mapInArrow(run, GROUPS)


def _near_cells(coarse: np.ndarray, blocks: dict[int, float], groups: dict[int, tuple[float, float]]) -> list[tuple]:
    """(cell of blocks, cell of groups, gap, reach) that may hold a nearest centre.

    ``blocks`` has the radius per cell, ``groups`` the radius and the smallest distance of a centre.
    No row of a block is further from its nearest centre than its own distance to the cell's centre
    plus ``reach``.
    """
    found = []
    for cell, radius in blocks.items():
        gaps = np.sqrt(np.sum((coarse - coarse[cell]) ** 2, axis=1))
        reach = min(float(gaps[other]) + nearest for other, (_, nearest) in groups.items())
        for other, (wide, _) in groups.items():
            if gaps[other] - radius - wide <= radius + reach + SLACK:
                found.append((cell, other, float(gaps[other]), reach))
    return found


def candidates(blocks: DataFrame, groups: DataFrame, pairs: list[tuple], few: bool) -> DataFrame:
    """Groups with the number of every block they may hold a nearest centre for, and the least
    distance (``low``) that any row of the block can have to them."""
    spark = blocks.sparkSession
    near = spark.createDataFrame(pairs, "cell int, other int, gap double, reach double")
    narrow = blocks.select("block", "cell", F.col("radius").alias("span")).join(F.broadcast(near), "cell")
    narrow = narrow.withColumnRenamed("cell", "home")
    met = groups.withColumnRenamed("cell", "other").join(F.broadcast(narrow) if few else narrow, "other")
    low = F.col("gap") - F.col("span") - F.col("radius")
    return met.where(low <= F.col("span") + F.col("reach") + SLACK).select(
        "block", F.lit(1).alias("part"), low.alias("low"), "ids", "vectors"
    )


class _Block:
    """A block while groups stream past: the nearest centre of each row so far."""

    def __init__(self, ids: np.ndarray, vectors_flat: np.ndarray) -> None:
        self.ids = ids
        self.grid = vectors_flat.reshape(len(ids), -1)
        self.best = np.full(len(ids), np.inf)
        self.center = np.full(len(ids), -1, np.int64)

    def known(self, center: np.ndarray, best: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """Take over what the pass before found, but for rows whose centre has moved; these are given back."""
        anew = moved[center]
        self.center, self.best = np.where(anew, -1, center), np.where(anew, np.inf, best)
        return anew

    def meet(self, low: float, ids: np.ndarray, vectors_flat: np.ndarray, some: np.ndarray | None = None) -> None:
        """Let all rows, or those marked in ``some``, meet the centres of a group."""
        near = self.best >= low - SLACK
        rows = np.flatnonzero(near if some is None else near & some)
        if not len(rows):
            return
        centers = vectors_flat.reshape(len(ids), -1)
        squares = _squares(self.grid[rows], centers)
        # Close calls are settled by exact distances, then by number.
        close = squares <= squares.min(axis=1, keepdims=True) + SLACK
        where, which = np.nonzero(close)
        exact = rounded(np.sqrt(np.sum((self.grid[rows[where]] - centers[which]) ** 2, axis=1)))
        first = np.lexsort((ids[which], exact, where))
        new = np.ones(len(first), bool)
        new[1:] = where[first[1:]] != where[first[:-1]]
        first = first[new]
        distance, center = exact[first], ids[which[first]]
        old, known = self.best[rows], self.center[rows]
        better = (distance < old) | ((distance == old) & (center < known))
        self.best[rows] = np.where(better, distance, old)
        self.center[rows] = np.where(better, center, known)

    def sums(self, wanted: np.ndarray | None = None) -> pa.RecordBatch:
        """Partial sums per centre, of all centres or of those marked in ``wanted``."""
        grid, center = self.grid, self.center
        if wanted is not None:
            grid, center = grid[wanted[center]], center[wanted[center]]
        centers, place = np.unique(center, return_inverse=True)
        total = np.zeros((len(centers), grid.shape[1]))
        np.add.at(total, place, grid)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(centers), pa.array(np.bincount(place)), lists.cast(pa.list_(pa.float64()))], ["id", "n", "total"]
        )

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids), pa.array(self.center), pa.array(self.best)], ["_row", "cluster", "distance"]
        )


def _streamed(blocks: DataFrame, met: DataFrame, result: str, schema: str) -> DataFrame:
    """Stream the groups past their blocks; ``result`` names what a finished block gives."""
    own = blocks.select("block", F.lit(0).alias("part"), F.lit(0.0).alias("low"), "ids", "vectors")
    stream = own.unionByName(met).repartition("block").sortWithinPartitions("block", "part", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            part, low = batch.column("part").to_pylist(), batch.column("low").to_pylist()
            for row in range(batch.num_rows):
                ids, flat = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("ids", "vectors"))
                if part[row] == 0:
                    if current is not None:
                        yield getattr(current, result)()
                    current = _Block(ids, flat)
                else:
                    current.meet(low[row], ids, flat)
        if current is not None:
            yield getattr(current, result)()

    return stream.mapInArrow(run, schema)


def _means(partial: DataFrame, groups: DataFrame) -> DataFrame:
    """New centres: rounded means; a centre without rows stays where it is."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, flat in zip(batch.column("ids"), batch.column("vectors"), strict=True):
                ids, flat = ids.values, flat.values
                old = pa.FixedSizeListArray.from_arrays(flat, len(flat) // len(ids)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([ids, old], ["id", "old"])

    old = groups.select("ids", "vectors").mapInArrow(kept, "id long, old array<double>")
    summed = vector_to_array(Summarizer.sum(array_to_vector("total")))
    total = partial.groupBy("id").agg(F.sum("n").alias("n"), summed.alias("total"))

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            before = _grid(batch.column("old"), n)
            counts = pc.fill_null(batch.column("n"), 0).to_numpy()
            after, some = before.copy(), np.flatnonzero(counts)
            after[some] = rounded(_grid(batch.column("total"), len(some)) / counts[some, None])
            moved = (after != before).any(axis=1).astype(np.int32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(after.ravel()), max(1, after.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), lists.cast(pa.list_(pa.float64())), pa.array(moved)], ["id", "vector", "flag"]
            )

    return old.join(total, "id", "left").mapInArrow(mean, "id long, vector array<double>, flag int")


class _Held:
    """Centres of a bounded size, filed in groups on the driver, with the cells near each other."""

    def __init__(self, grid: np.ndarray, coarse: np.ndarray, spans: dict[int, float], moved: np.ndarray) -> None:
        flat = pa.FixedSizeListArray.from_arrays(pa.array(grid.ravel()), grid.shape[1]).cast(pa.list_(pa.float64()))
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid))), flat, pa.array(moved.astype(np.int32))], ["id", "vector", "flag"])
        self.moved = moved
        self.groups: dict[int, list[tuple]] = {}
        facts: dict[int, tuple[float, float]] = {}
        for cell, own, rows, away, flags in _filed(iter([batch]), coarse, GROUP_CENTERS):
            gone = np.flatnonzero(flags)
            self.groups.setdefault(cell, []).append((away.max(), own, rows.ravel(), gone))
            wide, nearest = facts.get(cell, (0.0, np.inf))
            facts[cell] = max(wide, away.max()), min(nearest, away.min())
        self.near: dict[int, list[tuple]] = {}
        for home, other, gap, reach in _near_cells(coarse, spans, facts):
            self.near.setdefault(home, []).append((other, gap, reach))

    def met(self, block: _Block, cell: int, span: float, anew: np.ndarray | None) -> _Block:
        """The block after it has met all groups that may hold a nearest centre.

        Rows that are not ``anew`` (all are, if None) meet only the centres that moved.
        """
        some = [
            (gap - span - radius, at, ids, flat, gone)
            for other, gap, reach in self.near[cell]
            for at, (radius, ids, flat, gone) in enumerate(self.groups[other])
            if gap - span - radius <= span + reach + SLACK
        ]
        for low, _, ids, flat, gone in sorted(some, key=lambda group: group[:2]):
            block.meet(low, ids, flat, anew)
            if anew is not None and len(gone):
                block.meet(low, ids[gone], flat.reshape(len(ids), -1)[gone].ravel(), ~anew)
        return block


def _listed(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    return [batch.column(name)[row].values.to_numpy(zero_copy_only=False) for name in names]


def _past_held(blocks: DataFrame, held) -> DataFrame:
    """Every block past the broadcast groups, with the state of the pass before if it has one."""
    later = "best" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, anew, old = _Block(*_listed(batch, row, "ids", "vectors")), None, None
                if later:
                    old, best = _listed(batch, row, "nearest", "best")
                    anew = block.known(old, best, held.value.moved)
                block = held.value.met(block, batch.column("cell")[row].as_py(), batch.column("radius")[row].as_py(), anew)
                changed = np.flatnonzero(block.center != old) if later else np.arange(len(block.ids))
                touched = np.unique(np.concatenate((block.center[changed], old[changed])) if later else block.center)
                kept = [batch.column(name).slice(row, 1) for name in BLOCKS.names]
                yield pa.RecordBatch.from_arrays([*kept, _one(block.center), _one(block.best), _one(touched)], STATE.names)

    return blocks.select(*[name for name in STATE.names if name in blocks.columns]).mapInArrow(run, STATE)


def _held_sums(state: DataFrame, touched) -> DataFrame:
    """Sums of the rows of the touched centres; they are combined in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for row in range(batch.num_rows):
                block = _Block(*_listed(batch, row, "ids", "vectors"))
                (block.center,) = _listed(batch, row, "nearest")
                sums = block.sums(touched.value)
                if sums.num_rows:
                    parts.append(sums)
                if len(parts) == 64:
                    parts = [_combined(parts)]
        if parts:
            yield _combined(parts)

    return state.select("ids", "vectors", "nearest").mapInArrow(run, "id long, n long, total array<double>")


def _combined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row per centre of several partial sums."""
    ids, place = np.unique(np.concatenate([part.column(0).to_numpy() for part in parts]), return_inverse=True)
    counts, grid = (
        np.concatenate([part.column(1).to_numpy() for part in parts]),
        np.concatenate([_grid(part.column(2), part.num_rows) for part in parts]),
    )
    total = np.zeros((len(ids), grid.shape[1]))
    np.add.at(total, place, grid)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1])
    n = np.bincount(place, counts).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), lists.cast(pa.list_(pa.float64()))], ["id", "n", "total"])


def _held_passes(
    blocks: DataFrame, seeds: DataFrame, wanted: int, coarse, spans: dict, passes: int, scratch: Scratch
) -> DataFrame:
    """Passes with centres that fit the driver (at most ``HELD`` components)."""
    context = blocks.sparkSession.sparkContext
    first = seeds.orderBy("_mark").limit(wanted).select("vector").toArrow()
    grid = _grid(first["vector"].combine_chunks(), first.num_rows)
    state, moved = blocks, np.ones(len(grid), bool)
    for done in range(passes + 1):
        held = context.broadcast(_Held(grid, coarse.value, spans, moved))
        state = scratch.staged(_past_held(state, held), f"state{done}")
        scratch.delete(f"state{done - 1}")
        if done == passes:
            break
        touched = np.ones(len(grid), bool)
        if done:
            changed = state.select(F.explode("touched").alias("id")).distinct().toArrow()["id"].to_numpy()
            touched[:] = False
            touched[changed] = True
        if not touched.any():
            break
        summed = vector_to_array(Summarizer.sum(array_to_vector("total")))
        sums = _held_sums(state, context.broadcast(touched))
        table = sums.groupBy("id").agg(F.sum("n").alias("n"), summed.alias("total")).toArrow()
        after = grid.copy()
        if table.num_rows:
            total = _grid(table["total"].combine_chunks(), table.num_rows)
            after[table["id"].to_numpy()] = rounded(total / table["n"].to_numpy()[:, None])
        moved = (after != grid).any(axis=1)
        if not moved.any():
            break
        grid = after
    each = state.select(F.explode(F.arrays_zip("ids", "nearest", "best")).alias("one"))
    return each.select(F.col("one.ids").alias("_row"), F.col("one.nearest").alias("cluster"), F.col("one.best").alias("distance"))


def _stored_passes(
    scratch: Scratch, blocks: DataFrame, seeds: DataFrame, wanted: int, coarse, spans: dict, few: bool, passes: int
) -> DataFrame:
    """Passes with centres of any number, kept in tables."""
    seeds = ordered.with_position(seeds, ["_mark"], "id", scratch).where(F.col("id") < wanted)
    groups = scratch.staged(_groups(seeds.select("id", "vector", F.lit(1).alias("flag")), coarse), "groups")
    for done in range(passes + 1):
        facts = groups.groupBy("cell").agg(F.max("radius"), F.min("nearest"), F.sum("moved")).collect()
        pairs = _near_cells(coarse.value, spans, {row[0]: (row[1], row[2]) for row in facts})
        met = candidates(blocks, groups, pairs, few)
        if done == passes or not sum(row[3] for row in facts):
            break
        sums = _streamed(blocks, met, "sums", "id long, n long, total array<double>")
        groups = scratch.staged(_groups(_means(sums, groups), coarse), "groups")
    return _streamed(blocks, met, "rows", "_row long, cluster long, distance double")


def assign(
    df: DataFrame, keys: list[str], features: str = "scaled_features", params: ClusterParams = ClusterParams()
) -> DataFrame:
    """The input plus ``cluster`` and ``distance``, by Lloyd passes until no centre moves or
    ``params.passes`` are done.

    There are max(floor, int(ratio * rows)) clusters, or as many as vectors that can be told apart.
    """
    named = df.withColumns({
        "_vector": vectors.as_doubles(F.col(features)),
        "_mark": mark(F.col(features)),
        "_row": F.monotonically_increasing_id(),
    })
    scratch = Scratch(df.sparkSession)
    points = scratch.staged(named, "points")
    rows = points.count()
    if not rows:
        return df.select("*", F.lit(0).cast("bigint").alias("cluster"), F.lit(0.0).alias("distance"))
    wanted = max(params.floor, int(params.ratio * rows))
    kept, dimensions = _varying(points)
    if len(kept) < dimensions:
        own = F.transform(F.array(*map(F.lit, kept)), lambda at: F.get(F.col("_vector"), at))
        points = points.withColumn("_vector", own)
    context = df.sparkSession.sparkContext
    coarse = context.broadcast(_coarse(points, rows))
    blocks = scratch.staged(_blocks(points, coarse), "blocks")
    spans = blocks.groupBy("cell").agg(F.max("radius"), F.count(F.lit(1))).collect()
    few = sum(row[2] for row in spans) <= BROADCAST_BLOCKS
    spans = {row[0]: row[1] for row in spans}
    # One vector per mark, that of the least key; numbered by mark.
    seeds = points.groupBy("_mark").agg(F.min_by("_vector", F.struct(*keys)).alias("vector"))
    if wanted * coarse.value.shape[1] <= HELD:
        found = _held_passes(blocks, seeds, wanted, coarse, spans, params.passes, scratch)
    else:
        found = _stored_passes(scratch, blocks, seeds, wanted, coarse, spans, few, params.passes)
    return scratch.result(
        points.join(found, "_row").select(*df.columns, "cluster", "distance"), "clusters"
    )
