"""Toxicity by two class-conditional Kneser-Ney bigram models with shared backoff counts.

Counts.  C(u, w) is the number of documents of a class in which word w follows word u (the first word
follows a start mark), C(u) its sum over w.  K(w) is the number of different words before w in a class,
the Kneser-Ney continuation count: a word that one text, or copies of one text, repeat counts once
for each new context.  All labelled rows given are counted exactly, by word hashes of 64 bits.

Backoff.  Both classes share q(w), the continuation counts of both together.  Each class has

    p(w)     = max(0, K(w) - D) / K           + mass      * q(w)
    p(w | u) = max(0, C(u, w) - D) / C(u)     + mass of u * p(w)

where the mass is what the absolute discounts D leave over, so that every p sums to 1.  D is what the
counts of both classes let expect of a class, x = K * q(w) or C(u) * (share of w after u in both), plus
``OFFSET`` + ``DEVIATIONS`` * sqrt(x + (``SPREAD`` * x)^2).  Rare expressions, and those that are common to both classes,
are thus wholly left to the shared backoff; only what a class truly has more of is its own.  Contexts
of frequent words saturate, the sooner the larger a class is; D of a word therefore leaves no more of
K(w) than the same discount leaves of its plain count C(w), the sum of C(u, w) over u.  And copies of
one text teach nothing: words and pairs that keep anything so far are counted once more by the
different words before them (one word further back for pairs, two words for words), as Kneser-Ney
counts do below the highest order, and the same discount of these counts is the bound.  How many
different three-word sequences a class has, which that needs, is counted exactly as well.

Score.  The mean over the words of a text of log p(word | before, toxic) - log p(word | before,
ordinary), less what it is for words that neither class has more of.  The limit on it is the one with fewest errors on the labelled rows, from a histogram of
fixed size; the logistic curve through (limit, ``THRESHOLD``) gives the score.

q(w) cancels in nearly all ratios.  What is left is a list of words, contexts and pairs with a
difference each, which add up to the ratio; it is broadcast in blocks of ``ENTRIES``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import Scratch, staged
from . import words

#: The discount above what is expected; counts spread by chance, and by language and topic as well.
DEVIATIONS, OFFSET, SPREAD = 3.0, 2.0, 0.25
THRESHOLD = 0.7
#: Differences (16 bytes each) that are broadcast at once.
ENTRIES = 2_000_000
#: Labels of more rows are joined by a shuffle instead of a broadcast.
BROADCAST_ROWS = 1_000_000
#: The histogram of mean log-ratios: bins of this width up to this bound on both sides.
BIN, BOUND = 0.002, 4.0
#: Bytes of text that are worked on at once.
CHUNK = 2 << 20
#: Kinds of facts and of differences: of a word, of a context, of a word after its context.
WORD, CONTEXT, PAIR = 0, 1, 2
#: Passes in which three-word sequences are counted, each those of one remainder of their hash, all of
#: them together; more passes need less disk at once.
ONE_IN = 1

COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("u", "w", "n_0", "n_1")])
RATIO = T.StructType([T.StructField("ratio", T.DoubleType())])


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, of the word before it (0 at the start of a text), bounds by row."""
    data, bounds = words.utf8(column)
    hashes, starts, _ = words.runs(data, bounds, words.ALNUM, lower=True)
    firsts = words.row_ranges(starts, bounds)
    before = np.zeros(len(hashes), np.uint64)
    before[1:] = hashes[:-1]
    before[firsts[:-1][np.diff(firsts) > 0]] = 0
    return hashes, before, firsts


def _keys(kind: int, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One number for a word, a context or a pair."""
    seed = words.mix(u + np.uint64(kind)) if kind != WORD else np.zeros(len(w), np.uint64)
    return words.mix(seed * np.uint64(0x9E3779B97F4A7C15) + (w if kind != CONTEXT else np.uint64(1)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by pair of words and class, of some megabytes of text at a time."""
    for batch in batches:
        column, labels = batch.column("text"), batch.column("label").to_numpy(zero_copy_only=False)
        for lo, hi in words.batches_of_rows(batch, column, CHUNK):
            w, u, firsts = _tokens(column.slice(lo, hi - lo))
            row = words.row_of(firsts)
            pair = _keys(PAIR, u, w)
            order = np.lexsort((row, pair))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (pair[order][1:] != pair[order][:-1]) | (row[order][1:] != row[order][:-1])
            once = order[fresh]
            at = np.flatnonzero(np.diff(pair[once], prepend=np.uint64(0)) != 0) if len(once) else once
            if len(once) and (not len(at) or at[0] != 0):
                at = np.concatenate(([0], at))
            toxic = labels[lo:hi].astype(np.int64)[row[once]]
            n_1 = np.add.reduceat(toxic, at) if len(at) else toxic
            n = np.diff(np.append(at, len(once)))
            first = once[at]
            columns = [u[first].view(np.int64), w[first].view(np.int64), n - n_1, n_1]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS.names)


def facts_of(rows: DataFrame) -> DataFrame:
    """(kind, u, w, n_0, n_1, c_0, c_1) by class: K(w) and C(w) of words, C(u) of contexts, C(u, w) of
    frequent pairs.

    Pairs that no class has more than ``OFFSET`` times keep nothing after the discount and go.
    """
    # Both classes of a count travel in one number, the toxic documents in its upper half.
    one = (F.shiftleft("n_1", 32) + F.col("n_0")).alias("n")
    pairs = rows.mapInArrow(_count, COUNTS).select("u", "w", one).groupBy("u", "w").agg(F.sum("n").alias("n"))
    none = F.lit(0).cast("long")
    n_0, n_1 = F.col("n").bitwiseAND((1 << 32) - 1), F.shiftright("n", 32)
    once = (n_0 > 0).cast("long") + F.shiftleft((n_1 > 0).cast("long"), 32)
    names = ("kind", "u", "w", "n", "c")

    def fact(kind: int, *values: Column) -> Column:
        return F.struct(*[value.alias(name) for value, name in zip((F.lit(kind), *values), names, strict=True)])

    of_word = fact(WORD, none, F.col("w"), once, F.col("n"))
    of_context = fact(CONTEXT, F.col("u"), none, F.col("n"), none)
    of_pair = fact(PAIR, F.col("u"), F.col("w"), F.col("n"), none)
    frequent = F.greatest(n_0, n_1) > OFFSET
    each = F.when(frequent, F.array(of_word, of_context, of_pair)).otherwise(F.array(of_word, of_context))
    facts = (
        pairs.select(F.explode(each).alias("fact")).select("fact.*")
        .groupBy(*names[:3]).agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    )
    halves = [
        half.alias(f"{name}_{kind}")
        for name in ("n", "c")
        for kind, half in enumerate((F.col(name).bitwiseAND((1 << 32) - 1), F.shiftright(name, 32)))
    ]
    return facts.select(*names[:3], *halves)


def _left(count: Column, expected: Column) -> Column:
    """What the absolute discount leaves of a count."""
    spread = F.sqrt(expected + (SPREAD * expected) * (SPREAD * expected))
    return F.greatest(count - expected - OFFSET - DEVIATIONS * spread, F.lit(0.0))


SEEN = T.StructType(
    [T.StructField("kind", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in ("u", "w", "before", "label")]]
)


def _before(u: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Hash of the word two before each word, 0 at the start of a text."""
    t = np.zeros(len(u), np.uint64)
    t[1:] = u[:-1]
    t[firsts[:-1][np.diff(firsts) > 0]] = 0
    return t


def _seen(table):
    """What stands before the asked words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, labels = batch.column("text"), batch.column("label").to_numpy(zero_copy_only=False)
            for lo, hi in words.batches_of_rows(batch, column, CHUNK):
                w, u, firsts = _tokens(column.slice(lo, hi - lo))
                if not len(w):
                    continue
                t = _before(u, firsts)
                label = labels[lo:hi].astype(np.int64)[words.row_of(firsts)]
                none = np.zeros(len(w), np.uint64)
                parts = []
                for kind, own_u, own_w, before in ((WORD, none, w, _keys(PAIR, t, u)), (PAIR, u, w, t)):
                    met = np.flatnonzero(np.isin(_keys(kind, u, w), table.value)) if len(table.value) else np.empty(0, int)
                    _, once = np.unique(_keys(PAIR, before[met] * np.uint64(2) + label[met].astype(np.uint64), _keys(PAIR, own_u[met], own_w[met])), return_index=True)
                    met = met[once]
                    parts.append([np.full(len(met), kind), *(x[met].view(np.int64) for x in (own_u, own_w, before)), label[met]])
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                types = [field.type for field in pa.schema([("k", pa.int32()), *[(n, pa.int64()) for n in "uwbl"]])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(columns, types, strict=True)], SEEN.names)

    return run


def _triples(part: int, parts: int):
    """Hashes of the three-word sequences of one remainder, the class in the lowest bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, labels = batch.column("text"), batch.column("label").to_numpy(zero_copy_only=False)
            for lo, hi in words.batches_of_rows(batch, column, CHUNK):
                w, u, firsts = _tokens(column.slice(lo, hi - lo))
                whole = _keys(PAIR, _before(u, firsts), _keys(PAIR, u, w))
                label = labels[lo:hi].astype(np.uint64)[words.row_of(firsts)]
                if parts > 1:
                    own = (whole >> np.uint64(32)) % np.uint64(parts) == part
                    whole, label = whole[own], label[own]
                found = np.unique((whole << np.uint64(1)) | label)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["triple"])

    return run


def triple_counts(rows: DataFrame) -> list[int]:
    """How many different three-word sequences each class has, start marks included."""
    toxic, found = F.col("triple").bitwiseAND(1), [0, 0]
    for part in range(ONE_IN):
        triples = rows.mapInArrow(_triples(part, ONE_IN), "triple long").distinct()
        counts = triples.agg(F.sum(1 - toxic), F.sum(toxic)).first()
        found = [n + (more or 0) for n, more in zip(found, counts, strict=True)]
    return found


def _contexts_of(rows: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """(kind, u, w, m_0, m_1): how many different contexts the asked words and pairs have by class."""
    spark = rows.sparkSession
    blocks = max(1, -(-asked.count() // ENTRIES))
    found = []
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("kind", "u", "w"), F.lit(blocks)) == number).toArrow()
        table = spark.sparkContext.broadcast(np.sort(_keys_of(own)))
        each = rows.mapInArrow(_seen(table), SEEN).groupBy("kind", "u", "w", "before").agg(
            F.max((F.col("label") == 0).cast("long")).alias("m_0"), F.max((F.col("label") == 1).cast("long")).alias("m_1")
        )
        counted = each.groupBy("kind", "u", "w").agg(F.sum("m_0").alias("m_0"), F.sum("m_1").alias("m_1"))
        found.append(scratch.staged(counted, "contexts"))
        table.unpersist()
    return reduce(DataFrame.union, found)


def _keys_of(found: pa.Table) -> np.ndarray:
    """The keys of rows with kind, u and w."""
    kind = found.column("kind").to_numpy()
    u, w = (found.column(c).to_numpy().view(np.uint64) for c in ("u", "w"))
    keys = np.zeros(len(kind), np.uint64)
    for one in (WORD, CONTEXT, PAIR):
        keys[kind == one] = _keys(one, u[kind == one], w[kind == one])
    return keys


def differences(facts: DataFrame, rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, float]:
    """(kind, u, w, value) of all values but 0, and the log-ratio of words that have none.

    The log-ratio of w after u is that constant and the sum of the values of w, of u and of the pair.
    """
    known = facts.where(F.col("kind") == WORD).select("w", "n_0", "n_1", "c_0", "c_1")
    sums = known.agg(*[F.coalesce(F.sum(name), F.lit(0)) for name in ("n_0", "n_1", "c_0", "c_1")]).first()
    k_0, k_1, c_0, c_1 = sums
    empty = facts.sparkSession.createDataFrame([], "kind int, u long, w long, value double")
    if not k_0 or not k_1:
        return empty, 0.0
    none = F.lit(0).cast("long")
    q = (F.col("n_0") + F.col("n_1")) / F.lit(float(k_0 + k_1))
    plain = (F.col("c_0") + F.col("c_1")) / F.lit(float(c_0 + c_1))
    for kind, total, count in ((0, k_0, c_0), (1, k_1, c_1)):
        left = F.least(
            _left(F.col(f"n_{kind}"), q * float(total)), _left(F.col(f"c_{kind}"), plain * float(count))
        )
        known = known.withColumn(f"left_{kind}", left)
    own_words = scratch.staged(known.where("left_0 > 0 or left_1 > 0"), "own-words")

    contexts = facts.where(F.col("kind") == CONTEXT).select("u", F.col("n_0").alias("c_0"), F.col("n_1").alias("c_1"))
    pairs = facts.where(F.col("kind") == PAIR).select("u", "w", "n_0", "n_1").join(contexts, "u")
    share = (F.col("n_0") + F.col("n_1")) / (F.col("c_0") + F.col("c_1"))
    for kind in (0, 1):
        expected = share * F.col(f"c_{kind}")
        pairs = pairs.withColumn(f"x_{kind}", expected).withColumn(f"left_{kind}", _left(F.col(f"n_{kind}"), expected))
    own_pairs = scratch.staged(pairs.where("left_0 > 0 or left_1 > 0"), "own-pairs")

    asked = own_words.select(F.lit(WORD).alias("kind"), none.alias("u"), "w").union(own_pairs.select(F.lit(PAIR), "u", "w"))
    seen = _contexts_of(rows, asked, scratch)
    triples = [float(n) for n in triple_counts(rows)]
    of_word = seen.where(F.col("kind") == WORD).select("w", "m_0", "m_1")
    found = own_words.join(of_word, "w")
    all_contexts = (F.col("m_0") + F.col("m_1")) / F.lit(sum(triples))
    bounded = [
        F.least(F.col(f"left_{kind}"), _left(F.col(f"m_{kind}"), all_contexts * triples[kind])).alias(f"left_{kind}")
        for kind in (0, 1)
    ]
    found = found.select("w", "n_0", "n_1", *bounded).where("left_0 > 0 or left_1 > 0")
    found = found.select("w", q.alias("q"), (F.col("left_0") / k_0).alias("own_0"), (F.col("left_1") / k_1).alias("own_1"))
    found = scratch.staged(found, "kept-words")
    mass = [1 - (x or 0.0) for x in found.agg(F.sum("own_0"), F.sum("own_1")).first()]
    p = [(F.col(f"own_{kind}") + mass[kind] * F.col("q")).alias(f"p_{kind}") for kind in (0, 1)]
    constant = float(np.log(mass[1]) - np.log(mass[0]))

    of_pair = seen.where(F.col("kind") == PAIR).select("u", "w", "m_0", "m_1")
    bounded = []
    for kind in (0, 1):
        n, m = F.col(f"n_{kind}"), F.col(f"m_{kind}")
        # The expectation shrinks with the count.
        left = F.least(F.col(f"left_{kind}"), _left(m, F.col(f"x_{kind}") * m / n))
        bounded.append(F.when(n > 0, left / F.col(f"c_{kind}")).otherwise(0.0).alias(f"pair_{kind}"))
    kept = own_pairs.join(of_pair, ["u", "w"]).select("u", "w", *bounded).where("pair_0 > 0 or pair_1 > 0")
    kept = scratch.staged(kept, "kept-pairs")
    masses = kept.groupBy("u").agg(*[(1 - F.sum(f"pair_{kind}")).alias(f"mass_{kind}") for kind in (0, 1)])
    # A context may leave no mass at all; a trace of it keeps the ratio finite.
    masses = masses.select("u", *[F.greatest(f"mass_{kind}", F.lit(1e-9)).alias(f"mass_{kind}") for kind in (0, 1)])
    of_context = F.log("mass_1") - F.log("mass_0")
    ratio_of_word = F.log("p_1") - F.log("p_0")
    # A word of a kept pair may have nothing of its own.
    every = known.select("w", q.alias("q")).join(kept.select("w").distinct(), "w", "left_semi")
    every = every.join(found.select("w", "own_0", "own_1"), "w", "left").na.fill(0.0, ["own_0", "own_1"]).select("w", *p)
    full = [F.col(f"pair_{kind}") + F.col(f"mass_{kind}") * F.col(f"p_{kind}") for kind in (0, 1)]
    ratio_of_pair = F.log(full[1]) - F.log(full[0]) - of_context - ratio_of_word
    out = (
        found.select("w", *p).select(F.lit(WORD).alias("kind"), none.alias("u"), "w", (ratio_of_word - constant).alias("value"))
        .union(masses.select(F.lit(CONTEXT), "u", none, of_context))
        .union(kept.join(masses, "u").join(every, "w").select(F.lit(PAIR), "u", "w", ratio_of_pair))
    )
    return out.where("value <> 0"), constant


class Model:
    """Blocks of differences, the limit on their mean and the slope of the curve."""

    def __init__(self, entries: DataFrame, blocks: int) -> None:
        self.entries, self.blocks = entries, blocks
        self.limit, self.slope = BOUND, 1.0
        self._shared = {}

    def block(self, spark: SparkSession, number: int):
        """Broadcast (sorted keys, values) of one block, at most about ``ENTRIES`` of them."""
        if number not in self._shared:
            own = F.pmod(F.xxhash64("kind", "u", "w"), F.lit(self.blocks)) == number
            found = self.entries.where(own).toArrow()
            keys = _keys_of(found)
            order = np.argsort(keys)
            values = found.column("value").to_numpy()[order]
            self._shared[number] = spark.sparkContext.broadcast((keys[order], values))
        return self._shared[number]

    def score(self, ratio: Column) -> Column:
        """Score column from the mean log-ratio: THRESHOLD at the limit."""
        base = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        return 1 / (1 + F.exp(-(F.lit(base) + self.slope * (ratio - self.limit))))


def _mean_ratio(table):
    def found(column: pa.Array) -> pa.StructArray:
        w, u, firsts = _tokens(column)
        keys, values = table.value
        total = np.zeros(len(w) + 1)
        if len(keys):
            for kind in (WORD, CONTEXT, PAIR):
                asked = _keys(kind, u, w)
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                met = np.flatnonzero(keys[at] == asked)
                total[1 + met] += values[at[met]]
        total = np.cumsum(total)
        counts = np.diff(firsts)
        mean = (total[firsts[1:]] - total[firsts[:-1]]) / np.maximum(counts, 1)
        return pa.StructArray.from_arrays([pa.array(np.round(mean, 9))], ["ratio"])

    return found


def ratios(docs: DataFrame, model: Model, text: str, keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``found.ratio`` (mean log-ratio; 0 for texts without words).

    Models of several blocks take a pass over the texts for each, so that one block is held at a time.
    """
    spark = docs.sparkSession
    if model.blocks == 1:
        return words.per_text(docs, text, RATIO, _mean_ratio(model.block(spark, 0)), keep, CHUNK)
    names = list(docs.columns) if keep is None else keep
    kept = F.struct(*[F.col(f"`{name}`") for name in names]) if names else F.struct(F.lit(0).alias("none"))
    packed = docs.select(kept.alias("row"), F.col(f"`{text}`").alias("text"), F.lit(0.0).alias("ratio"))
    for number in range(model.blocks):
        shared = model.block(spark, number)
        one = words.per_text(packed, "text", RATIO, _mean_ratio(shared), None, CHUNK)
        ratio = (F.col("row.ratio") + F.col("found.ratio")).alias("ratio")
        packed = staged(one.select("row.row", "row.text", ratio), f"ratios{number}")
        model._shared.pop(number).unpersist()
    return packed.select("row", F.struct("ratio").alias("found"))


def fit(labelled: DataFrame, text: str = "text", label: str = "label") -> Model:
    """Train on all labelled rows; a null label counts as none, a null text as empty.

    Without words in both classes nothing can be told apart and every text scores below THRESHOLD.
    """
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col(text).cast("string").alias("text"), F.col(label).cast("int").alias("label")
    ).where("label in (0, 1)")
    scratch = Scratch(spark)
    facts = scratch.staged(facts_of(rows), "facts")
    # The shuffles of the pairs make room for those of the triples.
    scratch.drop()
    entries = staged(differences(facts, rows, scratch)[0], "differences")
    scratch.drop("facts", "own-words", "own-pairs", "contexts", "kept-words", "kept-pairs")
    model = Model(entries, max(1, -(-entries.count() // ENTRIES)))
    scored = ratios(rows, model, "text", ["label"])
    bins = F.round(F.least(F.greatest("found.ratio", F.lit(-BOUND)), F.lit(BOUND)) / BIN).cast("int")
    histogram = (
        scored.groupBy(bins.alias("bin")).agg(
            F.count(F.when(F.col("row.label") == 0, 1)).alias("n_0"),
            F.count(F.when(F.col("row.label") == 1, 1)).alias("n_1"),
        )
    ).orderBy("bin").collect()
    model.limit = _limit([(r["bin"] * BIN, r["n_0"], r["n_1"]) for r in histogram])
    model.slope = float(np.log(9)) / max(model.limit, BIN)
    return model


def _limit(bins: list[tuple[float, int, int]]) -> float:
    """The middle of the widest gap among cuts with fewest errors; above 0, where evidence is none."""
    best, at = None, BOUND
    missed, wrong = 0, sum(n for value, n, _ in bins)
    places = [value for value, _, _ in bins]
    for i, (value, ordinary, toxic) in enumerate(bins):
        if value > 0:
            errors = missed + wrong
            gap = value - max(places[i - 1], 0.0) if i else value
            if best is None or (errors, -gap) < best:
                best, at = (errors, -gap), value - gap / 2
        missed += toxic
        wrong -= ordinary
    return at


def training_rows(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                  label: str = "toxic", remainder: int | None = None) -> DataFrame:
    """(text, label) of the labelled documents, without those of one remainder of crc32(id) by 3.

    Of an id that is labelled several times the largest label counts; null ids and labels count as none.
    """
    known = labels.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{label}`").alias("label"))
    own = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    if remainder is not None:
        known = known.where(fold("_id") != remainder)
        own = own.where(fold("_id") != remainder)
    known = known.where("label is not null").groupBy("_id").agg(F.max("label").alias("label"))
    if known.count() <= BROADCAST_ROWS:
        return own.join(F.broadcast(known), "_id").select("text", "label")
    return staged(own.join(known, "_id").select("text", "label"), "labelled")


def fold(id: str) -> Column:
    """Remainder of crc32 of the id as text by 3."""
    return F.crc32(F.col(id).cast("string")) % 3


def toxicity(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns), score (0 to 1) and predicted (1 from THRESHOLD on).

    A text without words, null or empty, has no evidence: a mean log-ratio of 0, below the limit.
    Equal texts score alike, whole texts are read, an empty table gives an empty result.
    """
    return (
        ratios(docs, model, text, keep)
        .select("row", model.score(F.col("found.ratio")).alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )
