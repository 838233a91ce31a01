"""A05 / A31 by mergeable sketches: distinct counts that roll up.

Exact distinct counts of months don't add up to a year's, so each period is
counted anew from all lines.  A HyperLogLog sketch per period is a few kilobytes;
sketches of months merge into those of quarters and years without the lines.
The estimate's relative standard error is at most ``error(lg)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 12


def error(lg: int = LG) -> float:
    """The relative standard error of a sketch with 2 ** lg registers."""
    return 1.04 / 2 ** (lg / 2)


def distinct_sketches(df: DataFrame, by: dict[str, Column], cols: Sequence[str], lg: int = LG) -> DataFrame:
    """One row per period (``by``: name -> expression): rows and a sketch per column
    (``<col>_sketch``); nulls don't count.  Store it; new periods are appended."""
    held = df.select(*[e.alias(n) for n, e in by.items()], *[F.col(c).cast("string").alias(c) for c in cols])
    return held.groupBy(*by).agg(F.count(F.lit(1)).alias("lines"),
                                 *[F.hll_sketch_agg(c, lg).alias(f"{c}_sketch") for c in cols])


def rolled_up(sketches: DataFrame, by: dict[str, Column], cols: Sequence[str]) -> DataFrame:
    """Sketches of larger periods, merged from those of smaller ones."""
    held = sketches.select(*[e.alias(n) for n, e in by.items()], "lines", *[f"{c}_sketch" for c in cols])
    return held.groupBy(*by).agg(F.sum("lines").alias("lines"),
                                 *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in cols])


def estimates(sketches: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The sketches read as (estimated) distinct counts."""
    names = [c for c in sketches.columns if c not in {f"{c}_sketch" for c in cols}]
    return sketches.select(*names, *[F.hll_sketch_estimate(f"{c}_sketch").alias(c) for c in cols])
