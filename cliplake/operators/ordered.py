"""Order-dependent operators on groups of any size.

A plain window partitioned by a group sorts that whole group in one task, so a single video or
clip that holds a third of the table would hold up the job.  The operators here cut every group
into slices along its sort order.  Rows are sorted per (group, slice); only one small row per
slice (a count, a sum, its first and last row) is handled per whole group.

``slice_id`` must never decrease along the sort order, and the sort order must be total.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cliplake.params import ROWS_PER_SLICE
from cliplake.runtime import Scratch, staged


def slice_of(position: Column, rows: int = ROWS_PER_SLICE) -> Column:
    """Slice number of a position that counts or measures along the sort order."""
    return F.floor(position / rows)


def _with_headers(sliced: DataFrame, headers: DataFrame) -> DataFrame:
    """Put one header row of group facts in front of each slice, marked ``_header``.

    The facts meet their rows in the window that sorts the slice anyway, so no join is needed and
    null keys need no care.
    """
    marked = headers.withColumn("_header", F.lit(True))
    rows = sliced.withColumn("_header", F.lit(False))
    return rows.unionByName(marked, allowMissingColumns=True)


def _behind_header(keys: list[str], order: list[str]) -> WindowSpec:
    return (
        Window.partitionBy(*keys, "_slice")
        .orderBy(F.desc("_header"), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_id: Column,
    amount: Column,
    name: str,
) -> DataFrame:
    """Add the sum of ``amount`` from the first row of the group up to this row."""
    sliced = df.withColumn("_slice", slice_id).withColumn("_amount", amount)
    slices_before = (
        Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    starts = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.sum("_amount").alias("_total"))
        .select(*keys, "_slice", F.sum("_total").over(slices_before).alias("_amount"))
    )
    summed = F.sum("_amount").over(_behind_header(keys, order))
    return (
        _with_headers(sliced, starts)
        .withColumn(name, summed)
        .where(~F.col("_header"))
        .select(*df.columns, name)
    )


def group_aggregate(
    df: DataFrame,
    keys: list[str],
    slice_id: Column,
    partial: dict[str, Column],
    total: dict[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Add aggregates of the whole group to each of its rows.

    ``partial`` aggregates every slice, ``total`` combines these over the given window of all
    slices of the group.  A plain join on the group key would send all rows of a large group to
    one task; here rows meet their totals per (keys, slice).
    """
    sliced = df.withColumn("_slice", slice_id)
    whole = Window.partitionBy(*keys)
    facts = (
        sliced.groupBy(*keys, "_slice")
        .agg(*[column.alias(name) for name, column in partial.items()])
        .select(*keys, "_slice", *[build(whole).alias(name) for name, build in total.items()])
    )
    from_header = {
        name: F.first(name, ignorenulls=True).over(_behind_header(keys, [])) for name in total
    }
    return (
        _with_headers(sliced, facts)
        .withColumns(from_header)
        .where(~F.col("_header"))
        .select(*df.columns, *total)
    )


def number_rows(
    df: DataFrame, keys: list[str], order: list[str], slice_id: Column, name: str
) -> DataFrame:
    """Add the 0-based position of each row inside its group."""
    counted = running_sum(df, keys, order, slice_id, F.lit(1).cast("bigint"), name)
    return counted.withColumn(name, F.col(name) - 1)


def with_edge_rows(
    df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None
) -> DataFrame:
    """Deal rows to tasks by ranges of (keys, order) and exchange the rows at the edges.

    Adds ``_range``, the range of a row, and ``_copied``: the last row of the range before and the
    first of the range behind are copied into each range.  Windows that look one row back or ahead
    can then run per (``_range``, keys); drop the copied rows afterwards.  Ranges follow the rows, not
    the clock, so a group of any size and density spreads over tasks.  The dealt rows are written, as
    the ranges of a second run could differ; only the numbers of the ranges reach the driver.
    """
    by = [*keys, *order]
    dealt = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    placed = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    row = F.struct(*by, *[column for column in df.columns if column not in by])
    edges = placed.groupBy("_range").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    numbers = sorted(number for (number,) in placed.select("_range").distinct().collect())
    before = dict(zip(numbers[1:], numbers))
    behind = dict(zip(numbers, numbers[1:]))

    def neighbour(of: dict[int, int]) -> Column:
        places = [F.lit(of.get(number)).cast("int") for number in range(max(numbers, default=0) + 1)]
        return F.get(F.array(*places), F.col("_range"))

    moves = F.array(
        F.struct(neighbour(before).alias("to"), F.col("first").alias("row")),
        F.struct(neighbour(behind).alias("to"), F.col("last").alias("row")),
    )
    copies = (
        edges.select(F.explode(moves).alias("move"))
        .where("move.to is not null")
        .select("move.row.*", F.col("move.to").alias("_range"), F.lit(True).alias("_copied"))
    )
    return placed.withColumn("_copied", F.lit(False)).unionByName(copies)


def slice_window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, "_slice").orderBy(*order)


def with_previous_row(
    df: DataFrame, position: str, rows: int = ROWS_PER_SLICE
) -> DataFrame:
    """Copy the last row of each slice into the next one, marked ``_copied``.

    For positions that count 0, 1, 2, ... without gaps: the last row of a slice is known by its
    position, so the input is read once.
    """
    own = slice_of(F.col(position), rows)
    following = slice_of(F.col(position) + 1, rows)
    targets = F.array_distinct(F.array(own, following))
    return df.withColumn("_slice", F.explode(targets)).withColumn(
        "_copied", F.col("_slice") != own
    )


def with_position(df: DataFrame, order: list[str | Column], name: str, scratch: Scratch) -> DataFrame:
    """Number all rows from 0 in a global order, without one task that sees them all.

    Rows are dealt to tasks by ranges of the order and sorted there; the row numbers of a task start
    behind the rows of all tasks before it, of which only the counts reach the driver.  Equal rows
    get different numbers, in any order; give a total order for numbers that do not change.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of this number are the task's, the lower count its rows.
    placed = scratch.staged(dealt.withColumn(name, F.monotonically_increasing_id()), "placed")
    task = F.shiftright(name, 33)
    counts = placed.groupBy(task.alias("task")).count().orderBy("task").collect()
    starts, before = [0] * (1 + max((number for number, _ in counts), default=0)), 0
    for number, rows in counts:
        starts[number] = before - (number << 33)
        before += rows
    shifts = F.array(*[F.lit(start).cast("bigint") for start in starts])
    return placed.withColumn(name, F.col(name) + F.get(shifts, task.cast("int")))
