"""Scalable dense sequence numbers and running totals over a global order.

A global ``row_number() OVER (ORDER BY …)`` runs in one task.  Instead:

1. range-partition on the order and sort within partitions (one shuffle),
2. stamp each row with ``monotonically_increasing_id`` (partition index in
   the upper bits, row index in the lower 33 bits) and write the rows as a
   parquet stage table in the shared checkpoint folder: the stamp is then
   fixed even if an executor is lost and a task re-runs, and later passes
   read only the columns they need,
3. count rows (or sum weights) per partition — a table with one row per
   partition, whose size is bounded by the partition count,
4. broadcast those offsets and add the position inside the partition.

The caller passes a total order; rows equal on every order column are
interchangeable, so their relative numbering does not change the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_ROW_BITS = 33


def _sorted_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def ordered(df: DataFrame, order: Sequence[str | Column], num_partitions: int | None = None) -> DataFrame:
    """The staged rows of a global order, with ``_pid`` (range partition) and ``_pos`` (place in it)."""
    cols = _sorted_cols(order)
    # without a count adaptive execution merges small ranges
    spread = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    staged = (spread.sortWithinPartitions(*cols)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    staged = materialize(staged, "seq")
    return (staged.withColumn("_pid", F.shiftright("_mid", _ROW_BITS).cast("int"))
                   .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1)))


def _offsets(ordered: DataFrame, weight: Column) -> DataFrame:
    per = ordered.groupBy("_pid").agg(F.sum(weight).alias("_w"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded, safe to window in one task and broadcast
    return per.select("_pid", F.coalesce(F.sum("_w").over(w), F.lit(0)).cast("bigint").alias("_off"))


def with_sequential_id(df: DataFrame, order: Sequence[str | Column], name: str = "id",
                       start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, … following ``order`` (dense, gap-free)."""
    rows = ordered(df, order, num_partitions)
    offsets = _offsets(rows, F.lit(1).cast("bigint"))
    return (rows.join(F.broadcast(offsets), "_pid")
                   .withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint"))
                   .drop("_mid", "_pid", "_pos", "_off"))


def with_running_total(df: DataFrame, order: Sequence[str | Column], weight: str,
                       name: str = "cum", num_partitions: int | None = None) -> DataFrame:
    """Add inclusive running sum of ``weight`` along a global order: a window
    inside each range partition of the staged rows, and partition offsets."""
    rows = ordered(df, order, num_partitions)
    inside = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_in", F.sum(F.col(weight).cast("bigint")).over(inside))
    offsets = _offsets(rows, F.col(weight).cast("bigint"))
    return (local.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, (F.col("_off") + F.col("_in")).cast("bigint"))
                 .drop("_mid", "_pid", "_pos", "_off", "_in"))


def expanded_ranks(df: DataFrame, col: str, name: str = "rank", rows_per_task: int = 1_000_000,
                   piece: int = 10_000) -> DataFrame:
    """The values of ``col`` with their ranks 1..n in ascending order; equal values
    take consecutive ranks.

    Values are counted (combined map-side) and only distinct values are sorted; a
    running total of the counts gives each its ranks, and these are written out in
    pieces of ``piece`` ranks dealt over tasks.  No task gets all rows of a value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = with_running_total(counts, [col], "_n", name="_last").select(
        col, (F.col("_last") - F.col("_n") + 1).alias("_first"), "_last")
    total = materialize(total, "ranks")
    rows = total.agg(F.coalesce(F.max("_last"), F.lit(0))).first()[0]
    pieces = total.select(col, "_last", F.explode(F.sequence("_first", "_last", F.lit(piece).cast("bigint"))).alias("_at"))
    # a given count: merged by size, these few rows would expand in one task
    dealt = pieces.repartition(max(1, -(-rows // rows_per_task)), "_at")
    end = F.least(F.col("_at") + piece - 1, "_last")
    return dealt.select(col, F.explode(F.sequence("_at", end)).alias(name))
