"""Ranked lexical search: impact vectors ordered by length, pruned by bounds, rescored in integers.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.  The
impact of a term on a document is the whole integer that one occurrence of the term in a query adds
to its score; a document's impact vector holds the impacts of the terms that any query uses.

The vectors are sorted by their Euclidean length over the whole table and packed into buckets.  The
buckets of the longest vectors give every query a first threshold, the score of its k-th best so far.
For the others: a bucket whose longest vector times the query's length stays below the threshold is
left out (before it is read, where that holds for all queries; of a bucket that stays in, its shorter
vectors); inside, the query's weightiest coordinates are taken from the vectors and the rest is
bounded, by Cauchy-Schwarz and by the bucket's largest coordinates; survivors are scored exactly.
Bounds are computed in doubles with a margin, so that rounding drops nothing.

Queries are worked on in blocks of a bounded number of terms, each with its own pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliplake.runtime import Scratch

from . import words

TOP = 20
#: Terms of the queries of one block, repeats included (one longer query makes a larger block).
BLOCK_TERMS = 2_000_000
#: Documents and vector entries of a bucket.
BUCKET, BUCKET_ENTRIES = 4096, 1 << 20
#: Buckets that give the first thresholds.
SEEDS = 4
#: Coordinates of a query that are taken from the vectors before the rest is bounded.
FOCUS = 3
#: Share by which bounds in doubles are raised.
MARGIN = 1 + 1e-9

_ints, _longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
TERMS = T.StructType([T.StructField("n", T.LongType()), T.StructField("terms", _longs), T.StructField("tfs", _ints)])


def _lists(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column without nulls, and the bounds of its rows."""
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))))
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False), bounds.astype(np.int64)


def _counted(column: pa.Array, vocabulary: np.ndarray | None) -> pa.StructArray:
    """Number of terms per text, and (term, count): hashes, or places in the vocabulary."""
    data, bounds = words.utf8(column)
    hashes, starts, _ = words.runs(data, bounds, words.ALNUM, lower=True)
    firsts = words.row_ranges(starts, bounds)
    rows, n = words.row_of(firsts), len(bounds) - 1
    if vocabulary is not None:
        at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
        known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
        rows, values = rows[known], at[known].astype(np.int64)
    else:
        values = hashes.view(np.int64)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(new)
    tfs = np.diff(first, append=len(rows)).astype(np.int32)
    per_row = np.bincount(rows[first], minlength=n)
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(firsts), pa.int64()),
            words.list_column(pa.array(values[first]), per_row),
            words.list_column(pa.array(tfs), per_row),
        ],
        TERMS.names,
    )


class Queries:
    """The queries of a block: terms as places in their common vocabulary, and counts."""

    def __init__(self, rows: list) -> None:
        """``rows`` holds (number, term hashes, counts), each with a term at least."""
        self.numbers = np.array([row[0] for row in rows], np.int64)
        hashes = [np.array(row[1], np.int64).view(np.uint64) for row in rows]
        self.vocabulary, places = np.unique(np.concatenate(hashes), return_inverse=True)
        edges = np.cumsum([0] + [len(h) for h in hashes])
        self.terms = [places[lo:hi] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        self.counts = [np.array(row[2], np.int64) for row in rows]
        self.lengths = np.array([np.sqrt(np.sum(c.astype(np.float64) ** 2)) for c in self.counts])


def _term_sums(counted: DataFrame) -> DataFrame:
    """In how many documents each term occurs; summed inside every task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            values, _ = _lists(batch.column("terms"), np.int64)
            met = np.bincount(values)
            if len(met) > len(total):
                total, met = met, total
            total[: len(met)] += met
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    parts = counted.select("terms").mapInArrow(run, "term long, df long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"))


def _vectors(counted: DataFrame, weights: np.ndarray, documents: int, terms: int) -> DataFrame:
    """Impact vectors and their lengths, for documents with an impact."""
    shared = counted.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType(
        [counted.schema["id"], T.StructField("norm", T.DoubleType()), T.StructField("terms", _ints), T.StructField("impacts", _longs)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, bounds = _lists(batch.column("terms"), np.int64)
            tf, _ = _lists(batch.column("tfs"), np.int64)
            n = batch.column("n").to_numpy()
            m = 75 + (25 * n * documents) // terms
            rows = words.row_of(bounds)
            impacts = shared.value[places] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[rows]))
            some = impacts > 0
            rows, places, impacts = rows[some], places[some].astype(np.int32), impacts[some]
            per_row = np.bincount(rows, minlength=len(n))
            norms = np.sqrt(np.bincount(rows, impacts.astype(np.float64) ** 2, len(n)))
            lists = [words.list_column(pa.array(v), per_row) for v in (places, impacts)]
            out = pa.RecordBatch.from_arrays([batch.column("id"), pa.array(norms), *lists], schema.names)
            yield out.filter(pa.array(per_row > 0))

    return counted.where(F.size("terms") > 0).mapInArrow(run, schema)


def _buckets(vectors: DataFrame) -> DataFrame:
    """Vectors by descending length, packed; one row per bucket, numbered."""
    # Equal vectors have equal lengths; their ids spread them over tasks.
    salt = F.xxhash64("id")
    ordered = vectors.repartitionByRange(F.desc("norm"), salt).sortWithinPartitions(F.desc("norm"))
    kind = vectors.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("max_norm", T.DoubleType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("norms", T.ArrayType(T.DoubleType())),
            T.StructField("sizes", _ints),
            T.StructField("terms", _ints),
            T.StructField("impacts", _longs),
        ]
    )

    def packed(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        column = lambda name: rows.column(name).combine_chunks()
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        sizes = pc.list_value_length(column("terms")).cast(pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows.column("norm")[0].as_py()]),
                one(column("id")),
                one(column("norm")),
                one(sizes),
                one(column("terms").flatten()),
                one(column("impacts").flatten()),
            ],
            schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows, entries = [], 0, 0
        for batch in batches:
            sizes = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                fit = int(np.searchsorted(sizes, before + BUCKET_ENTRIES - entries, "right"))
                end = min(max(fit, at + (not rows)), at + BUCKET - rows, batch.num_rows)
                if end > at:
                    waiting.append(batch.slice(at, end - at))
                    rows, entries = rows + end - at, entries + int(sizes[end - 1]) - before
                if end < batch.num_rows or rows == BUCKET:
                    yield packed(pa.Table.from_batches(waiting))
                    waiting, rows, entries = [], 0, 0
                at = end
        if waiting:
            yield packed(pa.Table.from_batches(waiting))

    return ordered.mapInArrow(run, schema).withColumn("bucket", F.monotonically_increasing_id())


class Bucket:
    """Vectors of one bucket, by document in order of length and by term."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        values = lambda name: batch.column(name)[row].values
        self.ids = values("ids")
        self.norms = values("norms").to_numpy(zero_copy_only=False)
        sizes = values("sizes").to_numpy(zero_copy_only=False)
        terms = values("terms").to_numpy(zero_copy_only=False)
        impacts = values("impacts").to_numpy(zero_copy_only=False)
        docs = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.docs, self.impacts = docs[order], impacts[order]
        self.terms, self.starts = np.unique(terms[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(terms))
        self.largest = np.maximum.reduceat(self.impacts, self.starts)
        place = np.empty(len(self.ids), np.int64)
        place[pc.sort_indices(self.ids).to_numpy()] = np.arange(len(self.ids))
        #: Order of the documents by id.
        self.place = place

    def best(self, terms: np.ndarray, counts: np.ndarray, length: float, limit: int, k: int):
        """Documents and scores of the k best that reach the limit; ties by id."""
        none = np.empty(0, np.int64)
        # Shorter vectors cannot reach the limit.
        reach = int(np.searchsorted(-self.norms * length * MARGIN, -limit, "right"))
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        there = self.terms[at] == terms
        at, counts = at[there], counts[there]
        if not reach or not len(at):
            return none, none
        bound = counts * self.largest[at].astype(np.float64)
        if bound.sum() * MARGIN < limit:
            return none, none
        # Exact weightiest coordinates; the rest is bounded in two ways.
        order = np.argsort(-bound, kind="stable")
        at, counts, bound = at[order], counts[order], bound[order]
        known, used = np.zeros(reach), np.zeros(reach)
        for a, c in zip(at[:FOCUS], counts[:FOCUS], strict=True):
            docs, impacts = self.docs[self.starts[a] : self.ends[a]], self.impacts[self.starts[a] : self.ends[a]]
            docs, impacts = docs[: np.searchsorted(docs, reach)], impacts[: np.searchsorted(docs, reach)].astype(np.float64)
            known[docs] += c * impacts
            used[docs] += impacts**2
        left = np.sqrt(np.maximum(self.norms[:reach] ** 2 * MARGIN - used, 0))
        rest = np.minimum(left * np.sqrt(np.sum(counts[FOCUS:].astype(np.float64) ** 2)), bound[FOCUS:].sum())
        alive = np.zeros(len(self.norms), bool)
        alive[:reach] = (known + rest) * MARGIN >= limit
        if not alive.any():
            return none, none
        slices = [slice(self.starts[a], self.ends[a]) for a in at]
        docs = np.concatenate([self.docs[s] for s in slices])
        gains = np.concatenate([self.impacts[s] * c for s, c in zip(slices, counts, strict=True)])
        kept = alive[docs]
        scores = np.zeros(len(self.norms), np.int64)
        np.add.at(scores, docs[kept], gains[kept])
        found = np.flatnonzero(scores >= limit)
        if len(found) > k:
            kth = np.partition(scores[found], len(found) - k)[len(found) - k]
            found = found[scores[found] >= kth]
            found = found[np.lexsort((self.place[found], -scores[found]))[:k]]
        return found, scores[found]


def _searched(buckets: DataFrame, queries, limits, k: int) -> DataFrame:
    """The k best of every bucket for every query (number, id, score), as far as they reach the
    query's limit, which rises with what a task has seen."""
    kind = buckets.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("id", kind), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        limit = limits.value.copy()
        top = [np.empty(0, np.int64)] * len(limit)
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = Bucket(batch, row)
                numbers, found, scores = [], [], []
                for q in np.flatnonzero(bucket.norms[0] * block.lengths * MARGIN >= limit):
                    docs, reached = bucket.best(block.terms[q], block.counts[q], block.lengths[q], int(limit[q]), k)
                    if not len(docs):
                        continue
                    numbers.append(np.full(len(docs), block.numbers[q]))
                    found.append(docs)
                    scores.append(reached)
                    top[q] = np.sort(np.concatenate((top[q], reached)))[-k:]
                    if len(top[q]) == k:
                        limit[q] = max(limit[q], top[q][0])
                if numbers:
                    ids = bucket.ids.take(pa.array(np.concatenate(found)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(numbers)), ids, pa.array(np.concatenate(scores))], schema.names
                    )

    return buckets.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by_item = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)


def _block(scratch: Scratch, docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """The k best documents (number, id, score, rank) for the queries of one block."""
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(queries.vocabulary)
    counted = words.per_text(docs, "text", TERMS, lambda c: _counted(c, vocabulary.value), ["id"])
    counted = scratch.staged(counted.select("row.id", "found.*"), "counted")
    documents, terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(queries.vocabulary), np.int64)
    for term, many in _term_sums(counted).collect():
        df[term] = many
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    buckets = _buckets(_vectors(counted, weights, documents, max(terms, 1)))
    buckets = scratch.staged(buckets, "buckets")
    shared = context.broadcast(queries)
    limits = np.ones(len(queries.numbers), np.int64)
    longest = [row[0] for row in buckets.orderBy(F.desc("max_norm"), "bucket").select("bucket").limit(SEEDS).collect()]
    seeds = _searched(buckets.where(F.col("bucket").isin(longest)), shared, context.broadcast(limits), k)
    seeds = scratch.staged(_ranked(seeds, k), "seeds")
    place = {number: q for q, number in enumerate(queries.numbers.tolist())}
    for number, score in seeds.where(F.col("rank") == k).select("number", "score").collect():
        limits[place[number]] = score
    least = float(np.min(limits / queries.lengths)) / MARGIN
    others = buckets.where(~F.col("bucket").isin(longest) & (F.col("max_norm") >= least))
    found = _searched(others, shared, context.broadcast(limits), k).unionByName(seeds.drop("rank"))
    return scratch.staged(_ranked(found, k), "ranked")


def search(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = TOP,
) -> DataFrame:
    """The k highest-scoring documents of every item: item, rank, id, score.

    Scores above 0 only, highest first, ties by ascending id (null ids last, repeated ids in any
    order).  Null texts have no terms: such documents are not counted, such items give no rows.
    Rows of items that repeat are ranked each; repeated documents stand in the ranking each.  Empty
    tables give no rows.  Ids may be of any type that sorts; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    asked = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text"))
    asked = words.per_text(asked, "text", TERMS, lambda c: _counted(c, None), ["item"])
    asked = asked.select("row.item", "found.*").where("n > 0")
    asked = scratch.staged(asked.withColumn("number", F.monotonically_increasing_id()), "items")
    size = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_TERMS)
    results = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block)
        rows = rows.select("number", "terms", "tfs").collect()
        if rows:
            results.append(_block(scratch, docs, Queries(rows), k))
    if not results:
        ranked = asked.select("number").limit(0).withColumn("id", F.lit(None).cast(docs.schema["id"].dataType))
        ranked = ranked.withColumns({"score": F.lit(0).cast("long"), "rank": F.lit(1)})
    else:
        ranked = results[0]
        for more in results[1:]:
            ranked = ranked.unionByName(more)
    found = ranked.join(asked.select("number", "item"), "number")
    return scratch.result(found.select("item", "rank", "id", "score"), "search")
