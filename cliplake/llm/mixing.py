"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source has a weight and may be repeated ``epochs`` times at most.  The water level is the
number of words per unit of weight at which the targets, each clamped at its cap, add up to the
budget: clamping a source and sharing its excess by weight, again and again, ends there.  It is
found from running sums over the sources in the order in which they reach their caps.

A source's target is met by whole repetitions of all its documents and one more of a part of them:
documents are taken in the order of a seeded hash until the rest is filled.  Hash prefixes cut every
source into 65,536 bins; running sums go over bins, and only the one bin of a source in
which the rest ends is looked at row by row.  So no source, however large, meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BUDGET, EPOCHS = 1.5, 2.0
SEED = "mix"
#: Hex digits of the hash that name a bin.
BIN_DIGITS = 4


def targets(sizes: DataFrame, weights: Sequence[float], budget: float, epochs: float) -> DataFrame:
    """Target of each source from (source, source_size), one row per source.

    Weights repeat over the sources in code point order, null last.  The windows run over the
    sources, not over rows of the corpus.
    """
    position = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((position - 1) % len(weights) + 1).cast("int")
    )
    capped = sizes.select("source", "source_size", weight.alias("weight")).withColumn(
        "cap", F.col("source_size") * F.lit(float(epochs))
    )
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(budget))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    return (
        capped.withColumn("level", level)
        .withColumn("level", F.greatest(F.max("level").over(everything), F.lit(0.0)))
        .select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))
    )


def _order_key(id: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))))


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    epochs: float = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every row.

    size is the number of words (runs without ASCII white space) of the whole text, 0 for null;
    copies says how often the mix takes the document, taken is copies * size.  A source's taken words
    differ from its target by half of its largest document at most.  Null is a source of its own.
    Rows that repeat an id are rows of their own; a source without words has the target 0 and no copies,
    an empty table gives an empty result.  Reruns agree, whatever the partitioning.
    """
    rows = staged(
        docs.select(
            F.col(f"`{id}`").alias("id"),
            F.col(f"`{source}`").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ).withColumn("key", _order_key("id", seed)),
        "sizes",
    )
    in_bin = F.substring("key", 1, BIN_DIGITS)
    bins = rows.groupBy("source", in_bin.alias("bin")).agg(F.sum("size").alias("bin_size"))
    of_source = targets(
        bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, budget, epochs
    )
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(running), F.lit(0)))
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    plan = (
        bins.withColumnRenamed("source", "of")
        .join(of_source, F.col("of").eqNullSafe(F.col("source")))
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("of", "bin", "bin_size", "before", "source_size", "target", "whole", "rest")
    )
    # Keyed by source and bin, so a large source is spread over its bins.
    placed = rows.join(
        plan, F.col("source").eqNullSafe(F.col("of")) & (in_bin == F.col("bin"))
    ).drop("of")
    ends_here = (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("bin_size") > F.col("rest"))
    settled = placed.where(~ends_here).withColumn(
        "more", (F.col("before") + F.col("bin_size") <= F.col("rest")) & (F.col("rest") > 0)
    )
    inner = Window.partitionBy("source", "bin").orderBy("key", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    reached = F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0))
    ending = placed.where(ends_here).withColumn(
        "more", (reached + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    )
    copies = (F.col("whole") + F.col("more").cast("long")).cast("long")
    return settled.unionByName(ending).select(
        F.col("id").alias(id),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
