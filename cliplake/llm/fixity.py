"""Merkle fixity audit of record archives.

Every archive is a sequence of records with byte offsets.  Records are hashed, the records that begin
in one range of ``RANGE`` bytes are hashed together in offset order (an empty range has no leaf), and
``FANOUT`` neighbouring nodes at a time are hashed into the next level up to one root per archive.

Two replicas are compared from the roots down: only the children of nodes whose hashes differ, or
that one side lacks, are looked at, and in the last step only the records of differing ranges.
All levels are groupings by (archive, node), whose groups hold at most ``FANOUT`` nodes or the
records of one range.  Replicas meet in groupings too, so null archives and ids are values like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Scratch

RANGE = 1 << 16
FANOUT = 16


def records(
    df: DataFrame, id: str, archive: Column, order: str, target: str, payload: str
) -> DataFrame:
    """(archive, id, offset, length, digest): records laid out one after the other per archive.

    A record is a header line with its target and payload length, the payload and two line ends; null
    counts as empty.  Archives must be bounded (a block of ids, a size limit), as they are files.
    Records without an archive are one archive of their own; null places come first, ties by digest.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    head = F.concat(F.lit("WARC/1.1 "), F.coalesce(F.col(target), F.lit("")), F.lit(" "), F.octet_length(body).cast("string"), F.lit("\r\n"))
    record = F.concat(head, body, F.lit("\r\n\r\n"))
    rows = df.select(
        archive.alias("archive"),
        F.col(id).alias("id"),
        F.col(order).alias("place"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record.cast("binary"), 256).alias("digest"),
    )
    before = Window.partitionBy("archive").orderBy("place", "digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return rows.select("archive", "id", offset.alias("offset"), "length", "digest")


def tree(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """(archive, level, node, hash) of all levels over records (archive, offset, length, digest).

    Level 0 has a node per non-empty range.  All archives have as many levels as the longest needs.
    """
    listed = F.struct("offset", "length", "digest")
    level = scratch.staged(
        leaves.groupBy("archive", F.floor(F.col("offset") / RANGE).alias("node"))
        .agg(F.sort_array(F.collect_list(listed)).alias("parts"))
        .select(
            "archive",
            "node",
            F.sha2(
                F.concat_ws("|", F.transform("parts", lambda p: F.concat_ws(":", p["offset"], p["length"], p["digest"]))).cast("binary"),
                256,
            ).alias("hash"),
        ),
        "leaves",
    )
    top = level.agg(F.max("node")).first()[0] or 0
    levels, number = [level.withColumn("level", F.lit(0))], 0
    while top > 0:
        top //= FANOUT
        number += 1
        level = (
            level.groupBy("archive", F.floor(F.col("node") / FANOUT).alias("parent"))
            .agg(F.sort_array(F.collect_list(F.struct("node", "hash"))).alias("parts"))
            .select(
                "archive",
                F.col("parent").alias("node"),
                F.sha2(
                    F.concat_ws("|", F.transform("parts", lambda p: F.concat_ws(":", p["node"], p["hash"]))).cast("binary"),
                    256,
                ).alias("hash"),
            )
        )
        levels.append(level.withColumn("level", F.lit(number)))
    whole = levels[0]
    for one in levels[1:]:
        whole = whole.unionByName(one)
    return whole.select("archive", "level", "node", "hash")


def _of_nodes(side: DataFrame, nodes: DataFrame, *by: str) -> DataFrame:
    """Rows whose archive and node (by the given names) are among the nodes; nulls are equal."""
    wanted = nodes.select(*[F.col(name).alias(f"_{name}") for name in by])
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in by]
    return side.join(wanted, same[0] & same[1], "left_semi")


def audit(mine: DataFrame, replica: DataFrame) -> DataFrame:
    """(archive, id, offset, status) of the records that differ between two replicas.

    Both are tables of (archive, id, offset, length, digest).  status is ``changed`` (other digest or
    length at this offset), ``missing`` (only in mine) or ``added`` (only in the replica).  Records that
    repeat an offset are told apart by id, those that repeat both are one row, which differs when
    any of them does, or their number.  Null archives, ids and offsets equal each other.  Two empty
    or equal replicas give no row.  Other columns are not read.
    """
    scratch = Scratch(mine.sparkSession)
    names = ("archive", "id", "offset", "length", "digest")
    # Records are hashed once; trees and the last step read what is written.
    sides = [scratch.staged(side.select(*names), "records") for side in (mine, replica)]
    trees = [scratch.staged(tree(side, scratch), "tree") for side in sides]
    height = max(side.agg(F.max("level")).first()[0] or 0 for side in trees)
    left, right = trees
    nodes = left.select("*", F.col("hash").alias("a"), F.lit(None).cast("string").alias("b")).union(
        right.select("*", F.lit(None).cast("string"), "hash")
    )
    suspects = None
    for level in range(height, -1, -1):
        here = nodes.where(F.col("level") == level)
        if suspects is not None:
            parents = suspects.select("archive", F.col("node").alias("parent"))
            here = _of_nodes(here.withColumn("parent", F.floor(F.col("node") / FANOUT)), parents, "archive", "parent")
        pair = here.groupBy("archive", "node").agg(F.max("a").alias("a"), F.max("b").alias("b"))
        suspects = pair.where(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "node")
    bad = scratch.staged(suspects, "suspects")

    def within(side: DataFrame, sign: int) -> DataFrame:
        ranged = side.withColumn("node", F.floor(F.col("offset") / RANGE))
        return _of_nodes(ranged, bad, "archive", "node").select(*names, F.lit(sign).alias("n"))

    both = within(sides[0], 1).union(within(sides[1], -1)).groupBy(*names).agg(F.sum("n").alias("n"))
    found = (
        both.where("n <> 0")
        .groupBy("archive", "id", "offset")
        .agg(F.max("n").alias("most"), F.min("n").alias("least"))
        .select(
            "archive",
            "id",
            "offset",
            F.when(F.col("least") > 0, "missing").when(F.col("most") < 0, "added").otherwise("changed").alias("status"),
        )
    )
    return scratch.result(found, "fixity")
