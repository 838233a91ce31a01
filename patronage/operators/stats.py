"""Exact interpolated quantiles, by one distributed path at every size.

1. Values are counted: one row per group and distinct value, combined
   map-side, so repeated values cost nothing further.
2. The counted values are range-partitioned by group and value and staged with
   their partition number; a window inside a partition gives running counts.
3. Counts per group and partition (a row per partition) give each partition's
   offset.
4. One aggregate reads the order statistics around every interpolation point
   of every group.

No task holds more than its own range of distinct values, whatever their
number or a group's share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def group_quantiles(df: DataFrame, by: Sequence[str], value: str | Column, probs: Sequence[float]) -> DataFrame:
    """One row per group of ``by`` with an array ``quantiles`` (linear
    interpolation, like ``quantile_cont``; null values are left out)."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    key = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    counts = (df.select(key.alias("_g"), v.alias("_v")).where(F.col("_v").isNotNull())
              .groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")))
    ranged = materialize(counts.repartitionByRange("_g", "_v").withColumn("_pid", F.spark_partition_id()), "quantiles")
    sums = ranged.groupBy("_g", "_pid").agg(F.sum("_n").alias("_sum"))
    group = Window.partitionBy("_g")  # rows: partitions that hold the group
    offsets = sums.select(
        "_g", "_pid",
        F.coalesce(F.sum("_sum").over(group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_sum").over(group).alias("_total"))
    inside = Window.partitionBy("_g", "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = ranged.withColumn("_in", F.sum("_n").over(inside)).join(offsets, ["_g", "_pid"])
    end = F.col("_off") + F.col("_in")
    begin = end - F.col("_n")

    def between(p: float) -> Column:
        h = (F.col("_total") - 1) * F.lit(float(p))

        def at(k: Column) -> Column:
            return F.max(F.when((begin <= k) & (k < end), F.col("_v")))

        low, high = at(F.floor(h)), at(F.ceil(h))
        return low + (F.max(h) - F.max(F.floor(h))) * (high - low)

    out = cum.groupBy("_g").agg(F.array(*[between(p) for p in probs]).alias("quantiles"))
    return out.select(*[F.col(f"_g.{c}").alias(c) for c in by], "quantiles")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """The quantiles of several columns, all from one pass over ``df``: one row per column reaches the driver."""
    long = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("c", "v"))
    rows = group_quantiles(long, ["c"], "v", probs).collect()
    found = {r["c"]: list(r["quantiles"]) for r in rows}
    return {c: found.get(i, [None] * len(probs)) for i, c in enumerate(cols)}


def quantile_edges(df: DataFrame, c: str | Column, probs: Sequence[float], method: str = "exact",
                   accuracy: int = 100_000) -> list[Column]:
    """The quantiles of one column as literal Columns.

    method: ``exact``, or ``approx`` (``percentile_approx``) where the caller asks for a sketch.
    """
    if method == "approx":
        v = (F.col(c) if isinstance(c, str) else c).cast("double")
        arr = df.select(F.percentile_approx(v, [float(p) for p in probs], accuracy)).scalar()
        return [F.element_at(arr, i + 1) for i in range(len(probs))]
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    named = df.select((F.col(c) if isinstance(c, str) else c).alias("v"))
    return [F.lit(x).cast("double") for x in quantiles(named, ["v"], probs)["v"]]


def median_of(df: DataFrame, c: str | Column) -> Column:
    return quantile_edges(df, c, [0.5])[0]
