"""Benchmark decontamination with an FM-index per training shard.

Words are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.  A
window is ``size`` consecutive words of a benchmark item, or the whole item when it has fewer words
(but some).  Each task lays the words of its documents out as shards of at most ``SHARD`` words
(neighbours overlap by a window, so a long document is searched whole), builds an index per shard,
searches all windows backward and merges the located spans per document.

The benchmark reaches the tasks as broadcast blocks of at most ``BLOCK_WORDS`` words of windows; a
larger benchmark gives more blocks, which every task searches one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .fm_index import FMIndex

SIZE = 13
SHARD = 1 << 20
BLOCK_WORDS = 4_000_000
#: A document is contaminated when this many times its hit words reach its words.
SHARE = 20

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("span_starts", T.ArrayType(T.IntegerType())),
        T.StructField("span_ends", T.ArrayType(T.IntegerType())),
        T.StructField("byte_starts", T.ArrayType(T.IntegerType())),
        T.StructField("byte_ends", T.ArrayType(T.IntegerType())),
    ]
)


class Phrases:
    """Windows of some benchmark items as matrices of word numbers, one per window length."""

    def __init__(self, items: list[tuple[str, str]], size: int) -> None:
        texts = pa.array([text for _, text in items], pa.large_string())
        data, bounds = words.utf8(texts)
        hashes, starts, _ = words.runs(data, bounds, words.ALNUM, lower=True)
        firsts = words.row_ranges(starts, bounds)
        self.names = [name for name, _ in items]
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        numbers = numbers.astype(np.int64) + 1
        found: dict[int, tuple[list[np.ndarray], list[int]]] = {}
        for item, (lo, hi) in enumerate(zip(firsts[:-1], firsts[1:], strict=True)):
            length = min(size, hi - lo)
            for at in range(lo, hi - length + 1) if length else ():
                rows, owners = found.setdefault(int(length), ([], []))
                rows.append(numbers[at : at + length])
                owners.append(item)
        #: (windows, owners of each window as flat numbers and bounds) per length.
        self.groups = []
        for rows, owners in found.values():
            matrix, inverse = np.unique(np.stack(rows), axis=0, return_inverse=True)
            pairs = np.unique(np.stack((inverse.ravel(), np.array(owners)), axis=1), axis=0)
            edges = np.searchsorted(pairs[:, 0], np.arange(len(matrix) + 1))
            self.groups.append((matrix, pairs[:, 1], edges))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of known words, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


def _search(phrases: Phrases, column: pa.Array, size: int) -> tuple:
    """Hit flags of all words, (row, item) pairs, and the layout of the words."""
    data, bounds = words.utf8(column)
    hashes, starts, ends = words.runs(data, bounds, words.ALNUM, lower=True)
    firsts = words.row_ranges(starts, bounds)
    rows = words.row_of(firsts)
    # One filler after each document keeps phrases from crossing into the next.
    text = np.zeros(len(hashes) + len(bounds), np.int32)
    place = np.arange(len(hashes)) + rows
    text[place] = phrases.symbols(hashes)
    marks = np.zeros(len(text) + 1, np.int64)
    pairs = [np.empty((0, 2), np.int64)]
    for at in range(0, len(text), SHARD):
        shard = text[at : at + SHARD + size - 1]
        if not shard.any():
            continue
        index = FMIndex(shard, len(phrases.vocabulary) + 1, size)
        for matrix, owners, edges in phrases.groups:
            lo, hi = index.search(matrix)
            which, position = index.locate(lo, hi)
            if not len(which):
                continue
            position += at
            np.add.at(marks, position, 1)
            np.add.at(marks, position + matrix.shape[1], -1)
            # Each (row, window) once before its owners are listed.
            row = np.searchsorted(place, position)
            met = np.unique(np.stack((rows[row], which), axis=1), axis=0)
            many = edges[met[:, 1] + 1] - edges[met[:, 1]]
            base = np.repeat(edges[met[:, 1]] - (np.cumsum(many) - many), many)
            pairs.append(
                np.stack((np.repeat(met[:, 0], many), owners[base + np.arange(len(base))]), axis=1)
            )
    hit = np.cumsum(marks)[:-1][place] > 0
    return hit, np.unique(np.concatenate(pairs), axis=0), firsts, starts, ends, bounds


def _found(names: list[str], hit, pairs, firsts, starts, ends, bounds) -> pa.StructArray:
    n = len(firsts) - 1
    rows = words.row_of(firsts)
    new_row = np.zeros(len(hit) + 1, bool)
    new_row[firsts] = True
    first = np.flatnonzero(hit & (new_row[:-1] | ~np.concatenate(([False], hit[:-1]))))
    last = np.flatnonzero(hit & (new_row[1:] | ~np.concatenate((hit[1:], [False]))))
    spans = np.bincount(rows[first], minlength=n)
    as_list = lambda v: words.list_column(pa.array(v, pa.int32()), spans)
    per_item = np.bincount(pairs[:, 0], minlength=n)
    items = np.array(names, dtype=object)[pairs[:, 1]].tolist()
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(firsts), pa.int64()),
            pa.array(words.sums_by_row(hit, firsts), pa.int64()),
            words.list_column(pa.array(items, pa.string()), per_item),
            as_list(first - firsts[rows[first]]),
            as_list(last + 1 - firsts[rows[first]]),
            as_list(starts[first] - bounds[rows[first]]),
            as_list(ends[last] - bounds[rows[first]]),
        ],
        [field.name for field in FOUND],
    )


def _annotate(shared: list, size: int, column: pa.Array) -> pa.StructArray:
    """Search all blocks of the benchmark and join what they find."""
    names: list[str] = []
    pairs, hit = [], None
    for block in shared:
        flags, met, *layout = _search(block.value, column, size)
        hit = flags if hit is None else hit | flags
        pairs.append(met + np.array([0, len(names)]))
        names += block.value.names
    joined = np.concatenate(pairs)
    joined = joined[np.argsort(joined[:, 0], kind="stable")]
    return _found(names, hit, joined, *layout)


def _blocks(benchmark: DataFrame, item: str, text: str, size: int) -> Iterator[list]:
    """The items in blocks of a bounded number of window words."""
    block, filled = [], 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(text).cast("string"))
    for name, body in rows.where(F.col(text).isNotNull()).toLocalIterator():
        # Every second byte at most begins a word, and a word begins one window.
        block.append((name, body))
        filled += size * (len(body) // 2 + 1)
        if filled >= BLOCK_WORDS:
            yield block
            block, filled = [], 0
    if block:
        yield block


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    size: int = SIZE,
) -> DataFrame:
    """``row`` (the kept columns) and ``found`` for every document.

    ``found`` has n_words, n_hit (words inside any occurrence of a window), items (names of the
    items with occurring windows, sorted as strings, each once), and the merged spans as word
    positions (span_*) and UTF-8 byte positions (byte_*).  A null or empty text has no words, an
    item without words has no window, repeated items count by their name, repeated documents are
    judged each.  An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    blocks = list(_blocks(benchmark, item, item_text, size)) or [[]]
    shared = [spark.sparkContext.broadcast(Phrases(block, size)) for block in blocks]
    df = words.per_text(docs, text, FOUND, lambda c: _annotate(shared, size, c), keep, 6 << 20)
    return df.withColumn(
        "found", F.col("found").withField("items", F.array_sort(F.array_distinct("found.items")))
    )


def judged(
    docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, share: int = SHARE, **names
) -> DataFrame:
    """Kept columns and n_words, n_hit, items, contaminated (n_hit > 0, share * n_hit >= n_words)."""
    df = contamination(docs, benchmark, keep=keep, **names)
    return words.unpacked(df, "n_words", "n_hit", "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )
