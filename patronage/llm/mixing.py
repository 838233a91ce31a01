"""Mixing sources to target weights with a time-varying curriculum.

Each source has a weight schedule: knots (progress, weight) over training
progress 0..1, linear in between.

1. Integrate: a source's weight is the area under its schedule.  Sources
   share the words of all documents in proportion to these areas; a target
   stops at ``max_repeat`` times the source's own words and the excess goes
   to the others by weight, until none is above.
2. Lay the documents of a source on a line of words, in hash order, the whole
   source again and again up to its target.  The start of each document is a
   distributed prefix sum: range partitions, sums per partition, offsets.
3. Invert: the words that a source has fed by progress ``u`` are its target
   times the normalised integral of its schedule.  A copy whose middle lies at
   word ``x`` of the line is trained at the ``u`` where that demand is ``x``.
4. Range-sort the copies by position (``training_order``).

A source may hold any share of the rows: no step gathers one source's
documents in a task.  Only tables with one row per source, or per source and
range partition, pass through a window over one partition.

Defined cases: null or empty text has size 0 and is never taken; a null
source is one source, last in order; repeated rows are rows of their own;
null ids sort first; an empty table gives an empty mix; a source without
words has target 0; when every weight is 0 all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, packed, row_hashes, text_of

Schedule = Sequence[tuple[float, float]]

# Areas 5, 2 and 1: the heavy sources fade out, the light ones grow.
CURRICULUM: tuple[Schedule, ...] = (
    ((0.0, 7.5), (1.0, 2.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


def area(schedule: Schedule) -> float:
    return float(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])))


def _checked(schedule: Schedule) -> Schedule:
    at = [u for u, _ in schedule]
    if len(at) < 2 or at[0] != 0 or at[-1] != 1 or any(b <= a for a, b in zip(at, at[1:])):
        raise ValueError("a schedule needs knots at rising progress from 0 to 1")
    if any(w < 0 for _, w in schedule):
        raise ValueError("weights can't be negative")
    return schedule


def _segments(schedule: Schedule) -> Column:
    """Array of segments: start, weight there, slope, share of the area before."""
    whole, done, out = area(schedule) or 1.0, 0.0, []
    for (u0, w0), (u1, w1) in zip(schedule, schedule[1:]):
        out.append(F.struct(F.lit(float(u0)).alias("u"), F.lit(w0 / whole).alias("w"),
                            F.lit((w1 - w0) / (u1 - u0) / whole).alias("a"), F.lit(done / whole).alias("c")))
        done += (u1 - u0) * (w0 + w1) / 2
    return F.array(*out)


def demand_time(segments: Column, share: Column) -> Column:
    """Progress at which a schedule has fed ``share`` (0..1) of its area."""
    s = F.element_at(F.filter(segments, lambda x: x["c"] <= share), -1)
    need = share - s["c"]
    root = s["w"] + F.sqrt(F.greatest(F.lit(0.0), s["w"] * s["w"] + 2 * s["a"] * need))
    return F.least(F.lit(1.0), s["u"] + F.when(need > 0, 2 * need / root).otherwise(F.lit(0.0)))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, cycle: Sequence[Schedule], by_source: dict[str, Schedule],
                   max_repeat: float) -> DataFrame:
    """(_key, source_size, target, _plan) from (source, size) rows."""
    plans = [_checked(s) for s in cycle]
    n = len(plans)
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    t = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = t.withColumn("_plan", ((F.row_number().over(order) - 1) % n).cast("int"))
    for source, schedule in sorted(by_source.items()):
        plans.append(_checked(schedule))
        t = t.withColumn("_plan", F.when(F.col("source") == source, F.lit(len(plans) - 1)).otherwise(F.col("_plan")))
    t = t.withColumn("_w", F.element_at(F.array(*[F.lit(area(p)) for p in plans]), F.col("_plan") + 1))
    t = t.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    # sources stop at their cap in order of cap / weight; the level at the
    # first that does not stop is the common words-per-weight of the rest
    t = t.withColumn("_r", F.when(F.col("_w") > 0, F.col("_cap") / F.col("_w")))
    fill = Window.orderBy(F.col("_r").asc_nulls_last(), F.col("source").isNull(), F.col("source"))
    whole = Window.partitionBy()
    t = t.withColumn("_level", F.try_divide(
        F.sum("source_size").over(whole)
        - F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        F.sum("_w").over(fill.rowsBetween(0, Window.unboundedFollowing))))
    below = F.col("_r") > F.col("_level")
    t = t.withColumn("_level", F.min(F.when(below, F.struct("_r", F.col("source").isNull().alias("_n"), "source", "_level"))).over(whole)["_level"])
    target = F.when(F.col("_w") > 0, F.least(F.col("_cap"), F.col("_w") * F.col("_level"))).otherwise(F.lit(0.0))
    return t.select(_key(F.col("source")).alias("_key"), "source_size", target.alias("target"), "_plan")


def mix(docs: DataFrame, cycle: Sequence[Schedule] = CURRICULUM, by_source: dict[str, Schedule] | None = None,
        max_repeat: float = 3.0, whole: bool = False, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and
    ``copies``: an array of (position, words), one entry for each time that the
    mix takes the document.  Columns named in ``carry`` are kept too; they also
    order rows that agree on id, source and size.

    Sources in code-point order (null last) get the schedules of ``cycle`` in
    turn; ``by_source`` overrides.  ``whole=False`` cuts the last copy of a
    source so that it meets its target to the word; ``whole=True`` takes a
    copy if the middle of it lies within the target.
    """
    by_source, within = by_source or {}, ["_h", "doc_id", "size", *carry]
    every = [*cycle, *[s for _, s in sorted(by_source.items())]]
    spread = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10)
    sized = materialize(docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"),
        F.regexp_count(text_of(docs[text_col]), F.lit(WORD)).cast("long").alias("size"),
        *carry,
    ).withColumn("_h", spread.cast("long")).withColumn("_key", _key(F.col("source"))), "mix-sizes")
    ranged = materialize(sized.drop("source").repartitionByRange("_key", *within)
                         .withColumn("_pid", F.spark_partition_id()), "mix-ranges")
    sums = ranged.groupBy("_pid", "_key").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_pid", "_key", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    plan = offsets.join(source_targets(sized, cycle, by_source, max_repeat), "_key")
    inside = Window.partitionBy("_pid", "_key").orderBy(*within).rowsBetween(
        Window.unboundedPreceding, -1)
    laid = ranged.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(plan, ["_pid", "_key"])

    size, target = F.col("size"), F.col("target")
    most = int(-(-max_repeat // 1))
    starts = F.transform(F.sequence(F.lit(0), F.lit(max(0, most - 1))),
                         lambda e: e * F.col("source_size") + F.col("_off") + F.col("_in"))
    if whole:
        starts = F.filter(starts, lambda x: (size > 0) & (x + size / 2 <= target))
        words = lambda x: size
    else:
        starts = F.filter(starts, lambda x: (size > 0) & (x < F.floor(target)))
        words = lambda x: F.least(size, F.floor(target) - x)
    segments = F.element_at(F.array(*[_segments(s) for s in every]), F.col("_plan") + 1)
    copies = F.transform(starts, lambda x: F.struct(
        demand_time(segments, (x + words(x) / 2) / target).alias("position"), words(x).alias("words")))
    return laid.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda s, c: s + c["words"]).alias("taken"), "copies",
        *carry)


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it whole, range-sorted
    by training position (ties by id).  Columns stay as they are."""
    hashes = row_hashes(docs)
    flat = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[source_col].alias("source"),
                       *hashes)
    copies = mix(flat, whole=True, carry=("_h1", "_h2"), **options).select(
        "_h1", "_h2", F.explode("copies.position").alias("_at"))
    # rows that agree in every column count as often as they occur
    once = docs.select(packed(docs), *hashes).dropDuplicates(["_h1", "_h2"])
    order = ["_at", F.col("_row")[id_col], "_h1", "_h2"]
    return once.join(copies, ["_h1", "_h2"]).repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*")
