"""Records of large JSON arrays, cut at record ends over byte ranges.

A JSON file that is one array (or one object around an array) is a single row
to Spark's multi-line reader, so one task parses all of it.  Here the file is
read as text that ends at each ``}``; Spark splits such text over byte ranges.
Whether a ``}`` ends a record depends on what stands before it: is it inside a
string, and how deep?

1. A chunk's quotes (escape pairs taken out) flip "inside a string"; its brackets
   outside strings change the depth.  Both changes are known for either state at
   its start, so each byte range sums its own and one row per range gives all
   ranges their state (prefix sums over the ranges of a file).
2. A chunk ends a record when its ``}`` is outside strings and brings the depth
   back to that of the array.  Chunks between two ends are one record, also
   across byte ranges.  Records behind the array's ``]`` belong to other fields.
3. Records are written as JSON lines, which Spark reads with a given schema or
   infers one; any number of tasks reads them.

All of it is column expressions and aggregates.  A byte range (a file split) is
sorted by one task; no file and no array is ever one row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, stage_root

#: Fields whose array holds the records.
WRAPPERS = ("carts", "orders")
_LIST_HEAD = r"^\s*\["
# scalar fields may stand before the array
_WRAPPER_HEAD = r'^\s*\{[^{}\[\]]*"(?:' + "|".join(WRAPPERS) + r')"\s*:\s*\['


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block, row (order), text, quotes, and the change of depth when the
    chunk begins outside (d0) or inside (d1) a string."""
    raw = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("text"))
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    strings = r'"[^"]*("|$)'
    out0 = F.regexp_replace(bare, strings, "")
    out1 = F.regexp_replace(F.regexp_replace(bare, r'^[^"]*("|$)', ""), strings, "")
    quotes = _count(bare, '"') % 2
    rows = raw.select("*", quotes.alias("quotes"), out0.alias("out0"), out1.alias("out1"))

    def change(out: str, ends_outside: Column) -> Column:
        return _count(F.col(out), "{[") - _count(F.col(out), "]}") - ends_outside.cast("int")

    return rows.select("file", "block", "row", "text", "quotes", change("out0", F.col("quotes") == 0).alias("d0"),
                       change("out1", F.col("quotes") == 1).alias("d1"))


def shapes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, depth): the depth of each file's record array: 1 for a list, 2 for an
    object around it, null for anything else."""
    first = spark.read.option("lineSep", "}").text(paths).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"),
        F.substring("value", 1, 1 << 16).alias("text"))
    heads = first.groupBy("file").agg(F.min_by("text", "row").alias("text"))
    return heads.select("file", F.when(F.col("text").rlike(_LIST_HEAD), 1).when(
        F.col("text").rlike(_WRAPPER_HEAD), 2).alias("depth"))


def _before(df: DataFrame, value: Column, name: str) -> DataFrame:
    """One row per byte range: the sum of ``value`` over the file's ranges before."""
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


def records(spark: SparkSession, paths: list[str], depths: DataFrame) -> DataFrame:
    """One row per record of the files in ``depths`` (file, depth): its JSON text on one line."""
    inside = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    chunks = _chunks(spark, paths).join(depths.where("depth is not null"), "file")
    # state relative to the start of the byte range
    chunks = chunks.withColumn("turned", F.coalesce(F.sum("quotes").over(inside), F.lit(0)) % 2)
    even = F.col("turned") == 0
    blocks = chunks.groupBy("file", "block").agg(
        F.sum("quotes").alias("q"), F.sum(F.when(even, F.col("d0")).otherwise(F.col("d1"))).alias("from0"),
        F.sum(F.when(even, F.col("d1")).otherwise(F.col("d0"))).alias("from1"))
    blocks = _before(blocks, F.col("q"), "state").withColumn("state", F.col("state") % 2)
    blocks = _before(blocks, F.when(F.col("state") == 0, F.col("from0")).otherwise(F.col("from1")), "start")
    known = chunks.join(blocks.select("file", "block", "state", "start"), ["file", "block"])
    known = known.withColumn("state", (F.col("state") + F.col("turned")) % 2).withColumn(
        "change", F.when(F.col("state") == 0, F.col("d0")).otherwise(F.col("d1")))
    known = known.withColumn("after", F.col("start") + F.sum("change").over(upto)).withColumn(
        "ends", ((F.col("state") + F.col("quotes")) % 2 == 0) & (F.col("after") == F.col("depth")))
    # between records, a bracket first closes the array
    known = known.withColumn("closes", (F.col("after") - F.col("change") == F.col("depth")) & (F.col("state") == 0)
                             & F.col("text").rlike(r"^\s*\]"))
    known = materialize(known.select("file", "block", "row", "text", "ends", "closes", F.coalesce(
        F.sum(F.col("ends").cast("int")).over(inside), F.lit(0)).alias("place")), "json-chunks")
    counts = _before(known.groupBy("file", "block").agg(F.sum(F.col("ends").cast("int")).alias("n")), F.col("n"), "before")
    numbered = known.join(counts.select("file", "block", "before"), ["file", "block"]).withColumn(
        "record", F.col("before") + F.col("place"))
    closed = numbered.where("closes").groupBy("file").agg(F.min("record").alias("closed"))
    parts = numbered.join(closed, "file", "left").where("closed is null or record < closed")
    whole = parts.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "text"))).alias("parts"), F.bool_or("ends").alias("ended"))
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    head = F.when(F.col("record") == 0, F.regexp_replace(F.regexp_replace(text, _LIST_HEAD, ""), _WRAPPER_HEAD, "")
                  ).otherwise(text)
    # a line break can't stand inside a JSON string
    return whole.where("ended").select("file", "record", F.regexp_replace(
        F.regexp_replace(head, r"^[\s,]+", ""), r"[\r\n]+", " ").alias("value"))


def as_lines(spark: SparkSession, paths: list[str], depths: DataFrame) -> str:
    """The records as a folder of JSON lines."""
    path = f"{stage_root(spark)}/json-lines-{uuid.uuid4().hex}"
    records(spark, paths, depths).select("value").write.text(path)
    return path
