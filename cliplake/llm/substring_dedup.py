"""Near-duplicate passages across documents, by compact windows.

Tokens are word shingles.  For each of ``FUNCTIONS`` hash functions the compact windows of every
document (``compact_windows``) name the shingle that is the minimum of all passages around it.

1. Windows with the same minimum in several documents are kept, all others (nearly all of a clean
   text) go after one partial aggregation.
2. Within a group the first document (smallest id) leads, and the first window of each content too;
   every other window is joined to both leaders, and the two intervals around the shared minimum are
   intersected.  Links are linear in the rows.
3. Links on one diagonal of the same two documents form a chain; the shingles of both sides are
   joined to it in blocks, and the passages of the chain are verified by their Jaccard similarity.
4. Windows that verified spans do not cover whole stay open and meet the other contents of their group.
   A group of up to ``GROUP`` windows is one small block of a task (``_within_groups``): the number of
   shared shingles of all its pairs is one matrix product, and pairs that share enough are verified
   in the order of ids until a window is covered.  In larger groups windows meet that share a rare
   shingle.  Of two similar passages of w shingles each has at most k of its own, so whatever the
   order of the shingles, the first k + 1 of one and of the other have one in common (``_rarest``).
   Within the windows of such a shingle one document after the other leads (``_rounds``), then every
   pair that is still open is verified.
5. A window reaches further than the passage in it, so most open windows hold a passage that is
   verified already.  A passage inside a span asks only for sources before the span's (``_limits``),
   any other for all earlier documents: a comparison that is left out would change no joined span.

The passage stays in the document with the smallest id.  Nothing is compared within one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import Scratch
from . import words
from .compact_windows import WALL, compact_windows

SHINGLE = 5
#: Words of the shortest passage.
PASSAGE = 50
PERCENT = 80
FUNCTIONS = 3
#: Shingles of a block, and of a piece of a chain that is verified at once.
BLOCK, PIECE = 64, 4096
#: Blocks that one pass of verification may ask for, times those there are.
REQUESTS = 2
#: Spans (16 bytes each) that are broadcast to the texts they are cut from.
BROADCAST_SPANS = 500_000

#: Windows of a group that are compared inside one task.
GROUP = 256
#: Rounds of leaders in larger groups at most, and pairs for each open window that end them.
ROUNDS, PAIRS_PER_WINDOW = 4, 16

#: Bits of a packed window: position, mark of the content, left span, right span.
_SPAN_BITS, _MARK_BITS = 6, 22
_AT = _MARK_BITS + 2 * _SPAN_BITS

WINDOWS = T.StructType(
    [
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("windows", T.ArrayType(T.LongType())),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(T.BinaryType())),
    ]
)


def _shingled(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A shingle for each word (WALL for those that reach past their text) and bounds by row."""
    data, bounds = words.utf8(column)
    hashes, starts, _ = words.runs(data, bounds, words.NOT_SPACE, lower=True)
    firsts = words.row_ranges(starts, bounds)
    values = np.zeros(len(hashes), np.uint64)
    whole = words.shingles(hashes, size)
    values[: len(whole)] = whole | np.uint64(1)
    ends = firsts[words.row_of(firsts) + 1] if len(hashes) else np.empty(0, np.int64)
    values[np.arange(len(hashes)) + size > ends] = WALL
    return values, firsts


def _windows(size: int, width: int, functions: int):
    def found(column: pa.Array) -> pa.StructArray:
        values, firsts = _shingled(column, size)
        rows = words.row_of(firsts)
        sums = words.prefix_sums(values)
        keys, places = [], []
        for function in range(functions):
            factor = np.uint64((2 * function + 1) * 0xA0761D6478BD642F % (1 << 64))
            ranked = words.mix(values * factor) | np.uint64(1)
            ranked[values == WALL] = WALL
            c, left, right = compact_windows(ranked, width)
            packed = (c - firsts[rows[c]]).astype(np.uint64) << np.uint64(_AT)
            packed |= left.astype(np.uint64) << np.uint64(_SPAN_BITS)
            packed |= right.astype(np.uint64)
            content = words.mix(words.range_hashes(sums, c - left, c + right + 1))
            packed |= (content >> np.uint64(64 - _MARK_BITS)) << np.uint64(2 * _SPAN_BITS)
            keys.append(words.mix(values[c] + np.uint64(function)))
            places.append((c, packed))
        at = np.concatenate([c for c, _ in places])
        order = np.argsort(at, kind="stable")
        counts = np.bincount(rows[at], minlength=len(firsts) - 1)
        as_list = lambda v: words.list_column(
            pa.array(np.concatenate(v)[order].view(np.int64)), counts
        )
        return pa.StructArray.from_arrays(
            [as_list(keys), as_list([packed for _, packed in places])],
            [field.name for field in WINDOWS],
        )

    return found


def _blocks(size: int):
    """Shingles of each text as 4-byte values, BLOCK to a cell."""

    def found(column: pa.Array) -> pa.StructArray:
        values, firsts = _shingled(column, size)
        raw = (values >> np.uint64(32)).astype("<u4").tobytes()
        cells, counts = [], []
        for lo, hi in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            own = [raw[4 * at : 4 * min(at + BLOCK, hi)] for at in range(lo, hi, BLOCK)]
            cells += own
            counts.append(len(own))
        return pa.StructArray.from_arrays(
            [words.list_column(pa.array(cells, pa.binary()), np.array(counts, np.int64))], ["blocks"]
        )

    return found


SPAN = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.LongType()),
        T.StructField("start_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
    ]
)
_GROUP = ["id", "source", "diagonal", "lo"]


def _numbered(values: np.ndarray) -> np.ndarray:
    """Each value with the number of equal ones before it, as one key."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.ones(len(values), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    place = np.arange(len(values))
    number = np.empty(len(values), np.uint64)
    number[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return values.astype(np.uint64) << np.uint64(16) | number


def _share(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """How many of the intervals [first, last] hold each of n places."""
    change = np.zeros(n + 1, np.int64)
    fits = first <= last
    np.add.at(change, first[fits], 1)
    np.add.at(change, last[fits] + 1, -1)
    return np.cumsum(change)[:n]


def similar_starts(own: np.ndarray, other: np.ndarray, width: int, percent: int) -> np.ndarray:
    """Starts s at which own[s : s + width] and other[s : s + width] are similar.

    Shingles are matched one to one: those at the same place, of the rest the n-th of equal ones
    with the n-th.  The similarity is matched shingles over all in either side; as no shingle is
    matched twice, it is at most the Jaccard similarity of the two bags of shingles.
    """
    n = min(len(own), len(other)) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    m = n + width - 1
    aligned = own[:m] == other[:m]
    sums = np.concatenate(([0], np.cumsum(aligned)))
    shared = sums[width:] - sums[:-width]
    similar = 100 * shared >= percent * (2 * width - shared)
    if not similar.all():
        i, j = np.flatnonzero(~aligned), np.flatnonzero(~aligned)
        mine, theirs = _numbered(own[i]), _numbered(other[j])
        order = np.argsort(theirs)
        at = np.minimum(np.searchsorted(theirs[order], mine), len(theirs) - 1)
        met = theirs[order[at]] == mine
        i, j = i[met], j[order[at[met]]]
        shared = shared + _share(np.maximum(np.maximum(i, j) - width + 1, 0), np.minimum(np.minimum(i, j), n - 1), n)
        similar = 100 * shared >= percent * (2 * width - shared)
    return np.flatnonzero(similar)


def _runs_of(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last of each run of neighbouring starts."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    yield from zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist(), strict=True)


def similar_runs(
    data: np.ndarray, mine: np.ndarray, theirs: np.ndarray, lengths: np.ndarray, width: int, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the pair, first and last start of every run of ``similar_starts``, for many pairs at once.

    Pair i is data[mine[i] : mine[i] + lengths[i]] and data[theirs[i] : theirs[i] + lengths[i]], at
    least ``width`` long.
    """
    if not len(lengths):
        return (np.empty(0, np.int64),) * 3
    inside = _inside(lengths)
    own, other = data[np.repeat(mine, lengths) + inside], data[np.repeat(theirs, lengths) + inside]
    pair = np.repeat(np.arange(len(lengths)), lengths)
    base, starts = np.cumsum(lengths) - lengths, lengths - width + 1
    aligned = own == other
    sums = np.concatenate(([0], np.cumsum(aligned)))
    at = np.repeat(base, starts) + _inside(starts)
    pair_of = np.repeat(np.arange(len(lengths)), starts)
    shared = sums[at + width] - sums[at]
    similar = 100 * shared >= percent * (2 * width - shared)
    some = np.zeros(len(lengths), bool)
    some[pair_of[~similar]] = True
    place = np.flatnonzero(~aligned & some[pair])
    if len(place):
        high = pair[place].astype(np.uint64) << np.uint64(32)
        keys = np.concatenate((high | own[place], high | other[place]))
        number = np.unique(keys, return_inverse=True)[1]
        left, right = _numbered(number[: len(place)]), _numbered(number[len(place) :])
        order = np.argsort(right)
        met_at = np.minimum(np.searchsorted(right[order], left), len(right) - 1)
        met = right[order[met_at]] == left
        i, j = place[met], place[order[met_at[met]]]
        of = pair[i]
        i, j = i - base[of], j - base[of]
        first, last = np.maximum(np.maximum(i, j) - width + 1, 0), np.minimum(np.minimum(i, j), starts[of] - 1)
        # One place more for each pair, where its last intervals end.
        slots = np.cumsum(starts + 1) - (starts + 1)
        fits = first <= last
        change = np.bincount(slots[of[fits]] + first[fits], minlength=starts.sum() + len(starts))
        change -= np.bincount(slots[of[fits]] + last[fits] + 1, minlength=len(change))
        shared = shared + np.cumsum(change)[np.repeat(slots, starts) + _inside(starts)]
        similar = 100 * shared >= percent * (2 * width - shared)
    hits = np.flatnonzero(similar)
    if not len(hits):
        return (np.empty(0, np.int64),) * 3
    of = pair_of[hits]
    cut = np.flatnonzero((np.diff(hits) > 1) | (np.diff(of) > 0))
    first, last = np.r_[0, cut + 1], np.r_[cut, len(hits) - 1]
    local = hits - (np.cumsum(starts) - starts)[of]
    return of[first], local[first], local[last]


def _verified(size: int, width: int, percent: int):
    def spans(batch: pa.RecordBatch, firsts: np.ndarray) -> pa.RecordBatch:
        cells = batch.column("cell")
        edges = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64) // 4
        raw = np.frombuffer(cells.buffers()[2], np.uint8)
        data = raw[: len(raw) // 4 * 4].view("<u4")
        own = np.concatenate(([0], np.cumsum(batch.column("own").to_numpy(zero_copy_only=False))))
        # The own blocks of a group come first, in order, so both sides lie in one piece each.
        a, b = firsts[:-1], firsts[1:]
        middle = a + own[b] - own[a]
        both = (middle > a) & (middle < b)
        a, b, middle = a[both], b[both], middle[both]
        id_, source, diagonal, lo = (batch.column(name).to_numpy()[a] for name in _GROUP)
        blocks = batch.column("block").to_numpy().astype(np.int64)
        mine = edges[a] + lo - blocks[a] * BLOCK
        theirs = edges[middle] + lo - diagonal - blocks[middle] * BLOCK
        lengths = np.minimum(np.minimum(edges[middle] - mine, edges[b] - theirs), PIECE)
        some = lengths >= width
        group, first, last = similar_runs(data, mine[some], theirs[some], lengths[some], width, percent)
        id_, source, lo = id_[some][group], source[some][group], lo[some][group]
        columns = [id_, source, lo + first, lo + last + width + size - 1]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], SPAN.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            batch = batch if left is None else pa.concat_batches([left, batch])
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for name in _GROUP:
                values = batch.column(name).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            firsts = np.concatenate(([0], np.flatnonzero(new)))
            # The last group may go on in the next batch.
            left = batch.slice(firsts[-1])
            yield spans(batch, firsts)
        if left is not None:
            yield spans(left, np.array([0, left.num_rows]))

    return run


def repeated_spans(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    passage: int = PASSAGE,
    percent: int = PERCENT,
    functions: int = FUNCTIONS,
) -> DataFrame:
    """(id, start_word, end_word, source): passages that an earlier document has nearly alike.

    Words are runs without ASCII white space, A-Z folded, counted from 0; end_word is exclusive.
    A passage has at least ``passage`` words; ``source`` is the smallest id it was verified with.
    Overlapping passages of a document are joined.  Null, empty and short texts have none, rows that
    repeat an id are one document and are not compared with each other, rows with a null id are
    left alone, an empty table gives an empty result.  Other columns are not read.
    """
    width = passage - size + 1
    if not 0 < width <= 1 << _SPAN_BITS:
        raise ValueError(f"passages of {size} to {(1 << _SPAN_BITS) + size - 1} words")
    scratch = Scratch(docs.sparkSession)
    source = docs.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")
    ).where("id is not null")
    found = words.per_text(
        source, "text", WINDOWS, _windows(size, width, functions), ["id"], 4 << 20
    )
    pairs = F.explode(F.arrays_zip("found.keys", "found.windows")).alias("w")
    windows = _staged(
        scratch,
        found.select(F.col("row.id").alias("id"), pairs).select(
            "id", F.col("w.keys").alias("key"), F.col("w.windows").alias("window")
        ),
        "windows",
    )
    # Written, so that the join sees two plain exchanges and splits a common key.
    shared = _staged(
        scratch,
        windows.groupBy("key")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most")
        .select("key", "least"),
        "shared",
    )
    members = _staged(scratch, _unpacked(windows.join(shared, "key")), "members")
    scratch.drop("windows", "shared")
    chains = _staged(scratch, _chains(members, width), "chains")
    blocks = _staged(scratch, _shingle_blocks(source, chains, size, scratch), "blocks")
    spans = _linked(chains, blocks, width, size, percent, scratch)
    scratch.drop("chains", "wanted", "blocks")
    more = _of_open(source, members, spans, size, width, percent, scratch)
    for found in more:
        spans = spans.union(found)
    return scratch.result(_joined(spans).withColumnRenamed("id", id), "spans")


def _linked(
    chains: DataFrame, blocks: DataFrame, width: int, size: int, percent: int, scratch: Scratch
) -> DataFrame:
    """The verified spans of the chains.

    A block that many chains ask for goes to each of them.  Chains are taken in as many passes as
    keep the blocks on their way to about ``REQUESTS`` times the blocks there are.
    """
    requests = _requests(chains, width)
    passes = max(1, -(-requests.count() // (REQUESTS * max(1, blocks.count()))))
    found = []
    for number in range(passes):
        own = chains.where(F.pmod(F.xxhash64("id", "source", "diagonal"), F.lit(passes)) == number)
        spans = (
            _requests(own, width)
            .join(blocks, ["want", "block"])
            .repartition(*_GROUP)
            .sortWithinPartitions(*_GROUP, F.col("own").desc(), "block")
            .select(*_GROUP, "own", "block", "cell")
            .mapInArrow(_verified(size, width, percent), SPAN)
        )
        found.append(_staged(scratch, spans.distinct(), "linked"))
    return reduce(DataFrame.union, found)


def _staged(scratch: Scratch, df: DataFrame, name: str) -> DataFrame:
    """A working table; the shuffle files that led to it are freed."""
    table = scratch.staged(df, name)
    scratch.drop()
    return table


def _unpacked(windows: DataFrame) -> DataFrame:
    """One row per window: its group (the minimum), place, spans, content and the group's first id."""
    bits = lambda shift, n: F.shiftrightunsigned("window", shift).bitwiseAND((1 << n) - 1)
    return windows.select(
        "id",
        F.shiftrightunsigned("window", _AT).alias("at"),
        bits(_SPAN_BITS, _SPAN_BITS).cast("int").alias("left"),
        bits(0, _SPAN_BITS).cast("int").alias("right"),
        bits(2 * _SPAN_BITS, _MARK_BITS).cast("int").alias("mark"),
        F.col("key").alias("group"),
        "least",
    )


def _chains(members: DataFrame, width: int) -> DataFrame:
    """Per (id, source, diagonal) the interval of shingles that links to both leaders cover."""
    first = F.min(F.struct("id", "at", "left", "right")).alias("lead")
    by = (["group"], ["group", "left", "right", "mark"])
    # The first of a group is among the windows of its least id, which are few.
    leaders = (members.where("id = least"), members)
    links = [_links(members.join(some.groupBy(*on).agg(first), on), width) for some, on in zip(leaders, by, strict=True)]
    return (
        links[0]
        .union(links[1])
        .groupBy("id", "source", "diagonal")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )


def _links(led: DataFrame, width: int) -> DataFrame:
    left, right = F.least("left", "lead.left"), F.least("right", "lead.right")
    return (
        led.where(F.col("id") > F.col("lead.id"))
        .where(left + right + 1 >= width)
        .select(
            "id",
            F.col("lead.id").alias("source"),
            (F.col("at") - F.col("lead.at")).alias("diagonal"),
            (F.col("at") - left).alias("lo"),
            (F.col("at") + right).alias("hi"),
        )
    )


def _covered(windows: DataFrame, runs: DataFrame, size: int) -> DataFrame:
    """The windows with ``cover``: the source of the joined span that covers them whole, or null."""
    row = F.struct(*windows.columns)
    none = F.lit(None).cast("struct<end:bigint,source:bigint>")
    events = windows.select("id", (F.col("at") - F.col("left")).alias("p"), F.lit(1).alias("kind"), row.alias("w"), none.alias("run"))
    ends = runs.select(
        "id", F.col("start_word").alias("p"), F.lit(0).alias("kind"),
        F.lit(None).cast(events.schema["w"].dataType).alias("w"), F.struct(F.col("end_word").alias("end"), "source").alias("run"),
    )
    before = Window.partitionBy("id").orderBy("p", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reached = events.union(ends).withColumn("run", F.max("run").over(before)).where("w is not null")
    whole = F.col("run.end") >= F.col("w.at") + F.col("w.right") + size
    return reached.select("w.*", F.when(whole, F.col("run.source")).alias("cover"))


def _of_open(
    source: DataFrame, members: DataFrame, spans: DataFrame, size: int, width: int, percent: int, scratch: Scratch
) -> list[DataFrame]:
    """Spans of the windows that links to the leaders leave open, with the other windows of their group."""
    columns = ["group", "id", "at", "left", "right"]
    later = members.where("id > least").select(*columns)
    runs = _staged(scratch, _joined(spans), "runs")
    open_ = _staged(scratch, _covered(later, runs, size).where("cover is null").drop("cover"), "open")
    if not open_.limit(1).count():
        return []
    # Of equal contents the first document stands for all as a source.
    groups = open_.groupBy("group").agg(F.max("id").alias("most"))
    firsts = (
        members.join(groups, "group")
        .groupBy("group", "left", "right", "mark")
        .agg(F.min(F.struct("id", "at")).alias("first"), F.max("most").alias("most"))
        .where("first.id < most")
        .select("group", "first.id", "first.at", "left", "right")
    )
    both = firsts.withColumn("open", F.lit(False)).union(open_.withColumn("open", F.lit(True)))
    both = _staged(scratch, both.groupBy(*columns).agg(F.max("open").alias("open")), "both")
    scratch.drop("members", "open")
    sizes = both.groupBy("group").agg((F.count("*") > GROUP).alias("large"))
    contents = _staged(scratch, _contents(source, both.join(sizes, "group"), runs, width, size, scratch), "contents")
    scratch.drop("both", "asked", "runs")
    small = (
        contents.where("not large").select("group", "id", "at", "left", "open", "shingles", "limits")
        .repartition("group").sortWithinPartitions("group", "id", "at")
        .mapInArrow(_within_groups(width, size, percent), SPAN)
    )
    found = [_staged(scratch, small, "small")]
    large = contents.where("large").drop("large")
    if not large.limit(1).count():
        return found
    large = _staged(scratch, large.withColumn("w", F.monotonically_increasing_id()), "large")
    scratch.drop("contents")
    entries = _staged(scratch, _rare_entries(large, width, percent), "rare")
    return found + _rounds(entries, large, reduce(DataFrame.union, found, spans), size, width, percent, scratch)


def _within_groups(width: int, size: int, percent: int):
    """Spans of the open windows of small groups, whose rows come one group after the other."""
    # Shingles that two similar passages share at least.
    need = width - allowed(width, percent)

    def of_group(ids, at, left, open_, values, bounds, limits, edges) -> Iterator[tuple[int, int, int, int]]:
        n = len(ids)
        row = np.repeat(np.arange(n), np.diff(bounds))
        order = np.lexsort((row, values))
        ranked, owner = values[order], row[order]
        fresh = np.ones(len(ranked), bool)
        fresh[1:] = (ranked[1:] != ranked[:-1]) | (owner[1:] != owner[:-1])
        place = np.arange(len(ranked))
        nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
        # The n-th of equal shingles of a window is a shingle of its own.
        keys = (ranked.astype(np.int64) << 16) | nth
        _, column, counts = np.unique(keys, return_inverse=True, return_counts=True)
        common = counts > 1
        number = np.cumsum(common) - 1
        met = common[column]
        held = np.zeros((n, int(common.sum())), np.float32)
        held[owner[met], number[column[met]]] = 1
        shared = held @ held.T
        # Whether a window has the shingle at a place of another: as the first of equal ones.
        base = np.empty(len(ranked), np.int64)
        base[order] = column[place - nth]
        for i in np.flatnonzero(open_).tolist():
            limit = limits[edges[i] : edges[i + 1]].copy()
            near = np.flatnonzero((shared[i, :i] >= need) & (ids[:i] < limit.max()))
            if not len(near):
                continue
            own = base[bounds[i] : bounds[i + 1]]
            sums = np.zeros((len(near), len(own) + 1), np.int32)
            np.cumsum(np.where(common[own], held[near][:, number[own]], 0), axis=1, out=sums[:, 1:])
            may = sums[:, width:] - sums[:, :-width] >= need
            for j, at_start in zip(near.tolist(), may, strict=True):
                # Where a source that is no later is known already, this one adds nothing.
                if not (at_start & (limit > ids[j])).any():
                    continue
                reach = min(int(left[i]), int(left[j]))
                skip = int(left[i]) - reach
                x = values[bounds[i] + skip : bounds[i + 1]]
                y = values[bounds[j] + int(left[j]) - reach : bounds[j + 1]]
                m = min(len(x), len(y))
                starts = similar_starts(x[:m], y[:m], width, percent)
                if not len(starts):
                    continue
                limit[skip + starts] = np.minimum(limit[skip + starts], ids[j])
                for first, last in _runs_of(starts):
                    begin = int(at[i]) - reach
                    yield int(ids[i]), int(ids[j]), begin + first, begin + last + width + size - 1

    def spans(batch: pa.RecordBatch, firsts: np.ndarray) -> pa.RecordBatch:
        cells = batch.column("shingles")
        edges = cells.offsets.to_numpy() - cells.offsets[0].as_py()
        values = cells.flatten().to_numpy()
        bars = batch.column("limits")
        ends = bars.offsets.to_numpy() - bars.offsets[0].as_py()
        limits = bars.flatten().to_numpy()
        ids, at, left, open_ = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "at", "left", "open"))
        out = []
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if b - a > 1 and open_[a:b].any():
                part = values[edges[a] : edges[b]], edges[a : b + 1] - edges[a]
                out += of_group(ids[a:b], at[a:b], left[a:b], open_[a:b], *part, limits, ends[a : b + 1])
        columns = [pa.array([x[i] for x in out], pa.int64()) for i in range(4)]
        return pa.RecordBatch.from_arrays(columns, SPAN.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            batch = batch if left is None else pa.concat_batches([left, batch])
            if not batch.num_rows:
                continue
            groups = batch.column("group").to_numpy()
            firsts = np.concatenate(([0], np.flatnonzero(groups[1:] != groups[:-1]) + 1))
            # The last group may go on in the next batch.
            left = batch.slice(firsts[-1])
            yield spans(batch, firsts)
        if left is not None:
            yield spans(left, np.array([0, left.num_rows]))

    return run


def _rounds(
    entries: DataFrame, contents: DataFrame, spans: DataFrame, size: int, width: int, percent: int, scratch: Scratch
) -> list[DataFrame]:
    """Compare the windows of large groups that share a rare shingle.

    In each round the first window that has not led yet leads its shingle and is compared with those
    behind it that ask; what verified spans cover then asks for earlier sources only.  Copies and near
    copies thus go in a few rounds, each linear in the rows.  When the pairs that are left are few for
    their windows or no more than the entries, when a round answers next to none, or after ``ROUNDS``, all of them are compared.
    """
    by = ["group", "rare"]
    asking, waiting, found, before = entries.where("limit is not null"), entries, [], None
    rows = entries.count()
    for number in range(ROUNDS + 1):
        leads = waiting.groupBy(*by).agg(F.min(F.struct("id", "at", "w")).alias("lead"))
        leads = _staged(scratch, leads, f"leaders{number}")
        # Of what is asked no more nothing waits with a smaller id than the limit.
        asking = asking.join(leads, by).where(F.col("limit") > F.col("lead.id"))
        asking = _staged(scratch, asking, f"asking{number}")
        scratch.drop(f"asked{number - 1}")
        asks = asking.groupBy(*by).agg(F.count("*").alias("asks"), F.max("limit").alias("most"))
        pairs = waiting.join(asks, by).where(F.col("id") < F.col("most"))
        pairs = pairs.groupBy(*by).agg(F.first("asks").alias("asks"), F.count("*").alias("others"))
        expected = pairs.agg(F.coalesce(F.sum(F.col("asks") * F.col("others")), F.lit(0))).first()[0]
        left = asking.count()
        if not left:
            return found
        few = expected <= max(PAIRS_PER_WINDOW * left, rows)
        if few or number == ROUNDS or (before is not None and 100 * left > 99 * before):
            break
        before = left
        led = asking.select("w", "id", "at", F.col("lead.id").alias("source"), F.col("lead.w").alias("source_w"))
        found.append(_staged(scratch, _compared(led.distinct(), contents, width, size, percent), "led"))
        asking = _covered(asking.drop("lead"), _joined(reduce(DataFrame.union, found, spans)), size)
        asking = asking.withColumn("limit", F.least("limit", "cover")).drop("cover")
        asking = _staged(scratch, asking, f"asked{number}")
        gone = leads.select(*by, F.col("lead.w").alias("w"))
        waiting = _staged(scratch, waiting.join(gone, [*by, "w"], "left_anti"), f"waiting{number}")
        scratch.drop(f"leaders{number}", f"asking{number}", f"waiting{number - 1}")
    pairs = _pairs(waiting, asking)
    return [*found, _staged(scratch, _compared(pairs.distinct(), contents, width, size, percent), "pairs")]


def _pairs(known: DataFrame, asking: DataFrame) -> DataFrame:
    """Windows that ask, each with the earlier windows below its limit that share group and shingle."""
    other = known.select("group", "rare", F.col("id").alias("source"), F.col("w").alias("source_w"))
    pairs = asking.select("group", "rare", "w", "id", "at", "limit").join(other, ["group", "rare"])
    return pairs.where("limit > source").select("w", "id", "at", "source", "source_w")


WINDOW = T.ArrayType(
    T.StructType(
        [
            T.StructField("group", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("left", T.IntegerType()),
            T.StructField("right", T.IntegerType()),
            T.StructField("open", T.BooleanType()),
            T.StructField("large", T.BooleanType()),
            T.StructField("shingles", T.ArrayType(T.IntegerType())),
            T.StructField("limits", T.ArrayType(T.LongType())),
        ]
    )
)


def _contents(
    source: DataFrame, both: DataFrame, runs: DataFrame, width: int, size: int, scratch: Scratch
) -> DataFrame:
    """The windows with their shingles, as the 4-byte values that are verified, and their limits.

    An open window has a limit for each passage around its minimum: the source of the joined span that
    covers the passage, or else the window's id.  Only sources before the limit add anything.
    """
    window = F.struct("group", "at", "left", "right", "open", "large")
    lists = both.groupBy("id").agg(F.collect_list(window).alias("windows"))
    run_of = F.struct("start_word", "end_word", "source")
    known = runs.groupBy("id").agg(F.sort_array(F.collect_list(run_of)).alias("runs"))
    lists = lists.join(known, "id", "left").withColumn("runs", F.coalesce("runs", F.array().cast(known.schema["runs"].dataType)))
    lists = _staged(scratch, lists, "asked")
    texts = words.of_ids(source, lists.select("id")).dropDuplicates(["id"]).join(lists, "id")
    schema = T.StructType([T.StructField("id", T.LongType()), *WINDOW.elementType.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in words.batches_of_rows(batch, batch.column("text"), 4 << 20):
                part = batch.slice(lo, hi - lo)
                values, firsts = _shingled(part.column("text"), size)
                values = (values >> np.uint64(32)).astype(np.uint32).view(np.int32)
                windows = part.column("windows")
                counts = np.diff(windows.offsets.to_numpy())
                flat = windows.flatten()
                fields = {f: flat.field(f) for f in ("group", "at", "left", "right", "open", "large")}
                at, left, right = (fields[f].to_numpy(zero_copy_only=False).astype(np.int64) for f in ("at", "left", "right"))
                base = np.repeat(firsts[:-1], counts) + at - left
                id_of, row_of = (np.repeat(v, counts) for v in (part.column("id").to_numpy(), np.arange(len(counts))))
                starts = np.where(fields["open"].to_numpy(zero_copy_only=False), left + right + 2 - width, 0)
                limit_of = _limits(part.column("runs"), width + size - 1)
                for a in range(0, len(at), 10_000):
                    b = slice(a, a + 10_000)
                    lengths = (left + right + 1)[b]
                    cells = words.list_column(pa.array(values[np.repeat(base[b], lengths) + _inside(lengths)]), lengths)
                    asked = np.repeat((at - left)[b], starts[b]) + _inside(starts[b])
                    limits = limit_of(np.repeat(row_of[b], starts[b]), asked, np.repeat(id_of[b], starts[b]))
                    limits = words.list_column(pa.array(limits), starts[b])
                    columns = [fields[f].slice(a, len(lengths)) for f in fields]
                    yield pa.RecordBatch.from_arrays([pa.array(id_of[b]), *columns, cells, limits], schema.names)

    return texts.select("id", "text", "windows", "runs").mapInArrow(run, schema)


def _inside(lengths: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each length n, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _limits(runs: pa.Array, n_words: int):
    """Sources of the runs that cover whole passages of ``n_words`` words, elsewhere the given ids."""
    row = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
    first, end, source = (runs.flatten().field(i).to_numpy() for i in range(3))
    keys = (row << 40) + first

    def limits(rows: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if not len(keys):
            return ids
        place = np.searchsorted(keys, (rows << 40) + at, "right") - 1
        covers = (place >= 0) & (row[place] == rows) & (end[place] >= at + n_words)
        return np.where(covers, source[place], ids)

    return limits


def allowed(width: int, percent: int) -> int:
    """How many shingles of a passage a similar one may lack."""
    return width - -(-2 * width * percent // (100 + percent))


def _rarest(values: np.ndarray, counts: np.ndarray, width: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of passages, each with the places of its rarest shingles, one more than a similar one may lack."""
    n = allowed(width, percent) + 1
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, counts))] = np.arange(len(values))
    starts = np.arange(len(values) - width + 1)
    grid = rank[starts[:, None] + np.arange(width)]
    places = np.argpartition(grid, n - 1, axis=1)[:, :n] if n < width else np.tile(np.arange(width), (len(starts), 1))
    places = (starts[:, None] + places).ravel()
    met = counts[places] > 1
    return np.repeat(starts, n if n < width else width)[met], places[met]


def _rare_entries(windows: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per window and rare shingle of it that other windows of the group hold too.

    With ``limit``, ``left`` and ``right`` of the passages that have it among their rarest: the last
    limit of any, and how far they reach from the window's minimum.  Only shingles that several windows
    of a group hold are listed by window; all others are rarer than these, in whatever order.
    """
    cells = windows.select("group", "w", F.posexplode("shingles").alias("place", "rare"))
    # One number stands for group and shingle; should two fall together, more pairs are compared.
    cells = cells.select("w", "place", "rare", F.xxhash64("group", "rare").alias("key"))
    counts = cells.groupBy("key").agg(F.count_distinct("w").cast("int").alias("n")).where("n > 1")
    listed = (
        cells.join(counts, "key")
        .groupBy("w")
        .agg(F.collect_list(F.struct("place", "n", "rare")).alias("places"))
    )
    names = ["group", "id", "at", "w"]
    known = windows.select(*names, "left", (F.col("left") + F.col("right") + 1).alias("length"), "limits")
    ranked = known.join(listed, "w")
    new = [("rare", T.IntegerType()), ("limit", T.LongType()), ("left", T.IntegerType()), ("right", T.IntegerType())]
    schema = T.StructType([*[ranked.schema[n] for n in names], *[T.StructField(*field) for field in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("places")
            edges = cells.offsets.to_numpy() - cells.offsets[0].as_py()
            flat = cells.flatten()
            places, counts, values = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("place", "n", "rare"))
            lefts, lengths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("left", "length"))
            bars = batch.column("limits")
            ends = bars.offsets.to_numpy() - bars.offsets[0].as_py()
            limits = bars.flatten().to_numpy()
            rows, found = [], []
            for i, (a, b, length) in enumerate(zip(edges[:-1], edges[1:], lengths, strict=True)):
                own, n = np.zeros(length, values.dtype), np.ones(length, counts.dtype)
                own[places[a:b]], n[places[a:b]] = values[a:b], counts[a:b]
                starts, taken = _rarest(own, n, width, percent)
                if not len(taken):
                    continue
                order = np.lexsort((starts, own[taken]))
                rare, starts = own[taken][order], starts[order]
                first = np.flatnonzero(np.r_[True, rare[1:] != rare[:-1]])
                last = np.r_[first[1:], len(rare)] - 1
                asked = limits[ends[i] : ends[i + 1]]
                most = np.maximum.reduceat(asked[starts], first) if len(asked) else np.full(len(first), -1)
                rows.append(np.full(len(first), i))
                asks = np.full(len(first), len(asked) > 0)
                found.append((rare[first], most, lefts[i] - starts[first], starts[last] + width - 1 - lefts[i], asks))
            if rows:
                rare, most, left, right, asks = (np.concatenate(column) for column in zip(*found, strict=True))
                taken = batch.select(names).take(pa.array(np.concatenate(rows)))
                columns = [pa.array(rare), pa.array(most, pa.int64(), mask=~asks), pa.array(left, pa.int32()), pa.array(right, pa.int32())]
                yield pa.RecordBatch.from_arrays([*taken.columns, *columns], schema.names)

    return ranked.select(*names, "left", "length", "limits", "places").mapInArrow(run, schema)


def _compared(pairs: DataFrame, contents: DataFrame, width: int, size: int, percent: int) -> DataFrame:
    """Spans of the pairs of windows that are similar around their shared minimum."""
    mine = contents.select("w", "left", F.col("shingles").alias("own"))
    theirs = contents.select(
        F.col("w").alias("source_w"), F.col("left").alias("source_left"), F.col("shingles").alias("other")
    )
    both = pairs.join(mine, "w").join(theirs, "source_w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            ids, sources, at, left, source_left = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "source", "at", "left", "source_left")
            )
            own, other = batch.column("own"), batch.column("other")
            bounds = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in (own, other)]
            flat = [c.flatten().to_numpy() for c in (own, other)]
            for i in range(batch.num_rows):
                x, y = (values[edge[i] : edge[i + 1]] for values, edge in zip(flat, bounds, strict=True))
                reach = min(int(left[i]), int(source_left[i]))
                x, y = x[left[i] - reach :], y[source_left[i] - reach :]
                n = min(len(x), len(y))
                starts = similar_starts(x[:n], y[:n], width, percent)
                if len(starts):
                    lo = int(at[i]) - reach
                    for a, b in _runs_of(starts):
                        for column, value in zip(out, (ids[i], sources[i], lo + a, lo + b + width + size - 1), strict=True):
                            column.append(int(value))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], SPAN.names)

    return both.select("id", "source", "at", "left", "source_left", "own", "other").mapInArrow(run, SPAN)


def _shingle_blocks(
    source: DataFrame, chains: DataFrame, size: int, scratch: Scratch
) -> DataFrame:
    """(want, block, cell) for all documents of chains."""
    wanted = _staged(scratch, chains.select(F.explode(F.array("id", "source")).alias("id")).distinct(), "wanted")
    # Rows that repeat an id repeat its text; one of them stands for all.
    texts = words.of_ids(source, wanted).dropDuplicates(["id"])
    cut = words.per_text(texts, "text", BLOCKS, _blocks(size), ["id"], 4 << 20)
    return cut.select(F.col("row.id").alias("want"), F.posexplode("found.blocks").alias("block", "cell"))


def _requests(chains: DataFrame, width: int) -> DataFrame:
    """The blocks that each piece of a chain needs, of both documents."""
    step = PIECE - width + 1
    pieces = chains.withColumn(
        "lo", F.explode(F.expr(f"sequence(lo, greatest(lo, hi - {width - 1}), {step}L)"))
    ).withColumn("hi", F.least("hi", F.col("lo") + PIECE - 1))
    side = lambda own, want, shift: F.struct(
        F.lit(own).alias("own"),
        want.alias("want"),
        F.floor((F.col("lo") - shift) / BLOCK).alias("first"),
        F.floor((F.col("hi") - shift) / BLOCK).alias("last"),
    )
    sides = F.array(
        side(True, F.col("id"), F.lit(0)), side(False, F.col("source"), F.col("diagonal"))
    )
    return (
        pieces.withColumn("side", F.explode(sides))
        .select(*_GROUP, "side.own", "side.want", F.explode(F.sequence("side.first", "side.last")).alias("block"))
        .withColumn("block", F.col("block").cast("int"))
    )


def _joined(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document as one."""
    ordered = Window.partitionBy("id").orderBy("start_word", "end_word")
    reached = F.max("end_word").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    new = (reached.isNull() | (F.col("start_word") > reached)).cast("int")
    runs = spans.withColumn("new", new).withColumn("run", F.sum("new").over(ordered))
    return runs.groupBy("id", "run").agg(
        F.min("start_word").alias("start_word"),
        F.max("end_word").alias("end_word"),
        F.min("source").alias("source"),
    ).drop("run")


def without_spans(docs: DataFrame, spans: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the words of their spans, and the white space behind them, cut out.

    All rows and columns stay; a text without spans is unchanged.  ``spans`` must be a written table;
    up to ``BROADCAST_SPANS`` of them are broadcast, more are joined by a shuffle.
    """
    lists = spans.groupBy(id).agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("spans"))
    lists = lists.select(F.col(id).alias("_span_id"), F.col("spans").alias("_spans"))
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{id}`").cast("long").alias("_id"))
    few = spans.count() <= BROADCAST_SPANS
    lists = F.broadcast(lists) if few else lists
    joined = packed.join(lists, F.col("_id") == F.col("_span_id"), "left").select("row", "_spans")
    kept = joined.schema["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, spans = batch.column("row"), batch.column("_spans")
            column = row.field(row.type.get_field_index(text))
            if spans.null_count < len(spans):
                bodies = zip(column.to_pylist(), spans.to_pylist(), strict=True)
                cut = [_cut(body, cuts) if cuts and body else body for body, cuts in bodies]
                column = pa.array(cut, column.type)
            yield pa.RecordBatch.from_arrays([row, column], ["row", "cut"])

    schema = T.StructType([kept, T.StructField("cut", T.StringType())])
    names = [
        F.col("cut").alias(name) if name == text else F.col("row")[name].alias(name)
        for name in docs.columns
    ]
    return joined.mapInArrow(run, schema).select(*names)


def _cut(body: str, spans: list) -> str:
    raw = body.encode()
    data = np.frombuffer(raw, np.uint8)
    _, starts, ends = words.runs(data, np.array([0, len(raw)]), words.NOT_SPACE)
    kept, at = [], 0
    for span in spans:
        lo, hi = min(span["start_word"], len(starts)), min(span["end_word"], len(starts))
        if lo < hi:
            kept.append(raw[at : starts[lo]])
            at = int(starts[hi]) if hi < len(starts) else len(raw)
    kept.append(raw[at:])
    return b"".join(kept).decode()
