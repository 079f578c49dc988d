"""Words, lines and shingles of whole texts as NumPy arrays, read straight from Arrow buffers.

All operators of this subpackage that run Python do so inside ``mapInArrow``: Spark partitions and
shuffles the rows, these helpers turn one Arrow column into arrays of 64-bit hashes without a
Python object per word.  Work arrays cover ``BLOCK`` bytes at a time, so that memory does not grow
with the batch or with one very long text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1 << 20

_BYTES = np.arange(256)
#: Bytes of words: anything but the ASCII white space 9-13 and 32.
NOT_SPACE = (_BYTES != 32) & ((_BYTES < 9) | (_BYTES > 13))
#: Bytes of words: ASCII letters and digits, and every byte of a character beyond ASCII.
ALNUM = (
    ((_BYTES >= 48) & (_BYTES <= 57))
    | ((_BYTES >= 65) & (_BYTES <= 90))
    | ((_BYTES >= 97) & (_BYTES <= 122))
    | (_BYTES >= 128)
)
#: Bytes of a line: anything but the line break.
IN_LINE = _BYTES != 10

_SAME = np.arange(256, dtype=np.uint64)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next block."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        grown = np.full(max(n, BLOCK), base, np.uint64)
        grown[0] = 1
        _powers[base] = known = np.cumprod(grown, dtype=np.uint64)
    return known[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    return values ^ (values >> np.uint64(33))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _cuts(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about BLOCK that end at a row's end or outside a run."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + BLOCK, n)
        if end < n:
            row_end = bounds[np.searchsorted(bounds, end, "right") - 1]
            if row_end > at:
                end = int(row_end)
            else:
                gap, reach = np.empty(0, np.int64), BLOCK
                while not len(gap) and end < n:
                    window = data[end : end + reach]
                    gap = np.flatnonzero(~inside[window])
                    if len(gap):
                        end += int(gap[0])
                    else:
                        end = min(end + len(window), n)
                    reach *= 2
        yield at, end
        at = end


def runs(
    data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, lower: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every maximal run of ``inside`` bytes within a row.

    With the table of word bytes the runs are words, with that of line bytes non-empty lines.
    Equal runs have equal hashes; ``lower`` folds A-Z first.
    """
    fold = _LOWER if lower else _SAME
    hashes, starts, ends = [], [], []
    for at, end in _cuts(data, bounds, inside):
        block = data[at:end]
        flags = np.zeros(len(block) + 2, bool)
        flags[1:-1] = inside[block]
        edge = flags[1:] != flags[:-1]
        first, last = edge & flags[1:], edge & flags[:-1]
        # A row that starts inside a run of the row before cuts it in two.
        rows = bounds[np.searchsorted(bounds, at, "right") : np.searchsorted(bounds, end, "left")]
        rows = rows - at
        joined = rows[flags[rows] & flags[rows + 1]]
        first[joined] = True
        last[joined] = True
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        if not len(s):
            continue
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((fold[block] + np.uint64(1)) * _power(_BASE, len(block)), out=sums[1:])
        value = (sums[e] - sums[s]) * _power(_INVERSE, len(block))[s]
        hashes.append(mix(value))
        starts.append(s + at)
        ends.append(e + at)
    if not hashes:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def row_ranges(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index of the first run of each row, and the number of runs at the end."""
    return np.searchsorted(starts, bounds, "left")


def row_of(firsts: np.ndarray) -> np.ndarray:
    """Row number of every run."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def sums_by_row(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of the runs' values in every row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[firsts[1:]] - total[firsts[:-1]]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive runs from each run on; the last ``size - 1`` have none."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[i : i + n]
    return mix(out)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which ``range_hashes`` takes the hash of any range of values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges: ranges of equal values have equal hashes wherever they start."""
    return (sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts]


def list_column(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def batches_of_rows(batch: pa.RecordBatch, text: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``limit`` bytes of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    if batch.num_rows == 0:
        return
    group = np.cumsum(lengths.astype(np.int64)) // limit
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def per_text(
    docs: DataFrame,
    text: str,
    found: T.StructType,
    function: Callable[[pa.Array], pa.StructArray],
    keep: list[str] | None = None,
    limit: int = 8 << 20,
) -> DataFrame:
    """Run ``function`` over the text column; give ``row`` (the kept columns) and ``found``.

    The input columns travel inside one struct, so that no name of theirs can clash with another.
    """
    names = list(docs.columns) if keep is None else keep
    kept_type = T.StructType([docs.schema[name] for name in names])
    row = (
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row")
        if names
        else F.struct(F.lit(0).alias("none")).alias("row")
    )
    # A kept text does not travel a second time.
    place = names.index(text) if text in names and docs.schema[text].dataType == T.StringType() else None
    packed = docs.select(row) if place is not None else docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", kept_type if names else packed.schema["row"].dataType),
                           T.StructField("found", found)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text") if place is None else batch.column("row").field(place)
            for lo, hi in batches_of_rows(batch, column, limit):
                part = batch.column("row").slice(lo, hi - lo)
                out = function(column.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([part, out], ["row", "found"])

    return packed.mapInArrow(run, schema)


#: Ids that are broadcast to a semi join; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def of_ids(docs: DataFrame, ids: DataFrame, id: str = "id") -> DataFrame:
    """The rows of the given (distinct, written) ids, without a shuffle of texts where ids are few."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, id, "left_semi")


def unpacked(df: DataFrame, *names: str) -> DataFrame:
    """The kept columns and the named fields of ``found``."""
    return df.select("row.*", *[F.col("found")[name].alias(name) for name in names])
