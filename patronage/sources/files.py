"""File scans and sinks.

Raw layers are read as all-string columns (no inference: one pass, and a
dirty value never flips a column's type); typing happens in cleaning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import json_records as JR


def expand_paths(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The qualified paths that a path, a glob or a list of them stands for, each
    once however many globs match it, in order of name; what matches nothing adds none."""
    jvm = spark.sparkContext._jvm  # type: ignore[union-attr]
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # type: ignore[union-attr]
    found = set()
    for p in [path] if isinstance(path, str) else path:
        glob = jvm.org.apache.hadoop.fs.Path(p)
        for status in glob.getFileSystem(conf).globStatus(glob) or ():
            found.add(status.getPath().toString())
    # a folder's files are read with it
    return sorted(p for p in found if not any(p.startswith(f"{q}/") for q in found))


def _hadoop_exists(spark: SparkSession, path: str) -> bool:
    return bool(expand_paths(spark, path))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             with_file: bool = False) -> DataFrame | None:
    """CSV with header; all columns strings unless a schema is given.

    ``path`` may be a glob or a list of globs (several folders of
    ``customers_*.csv``); a file that several match is read once, and a path
    that matches nothing is skipped.
    """
    paths = expand_paths(spark, path)
    if not paths:
        return None
    reader = spark.read.option("header", True).option("inferSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(paths)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def read_json_records(spark: SparkSession, path: str | Sequence[str],
                      schema: T.StructType | str | None = None) -> DataFrame | None:
    """JSON whose top level is a list of records, ``{"carts": [...]}``,
    ``{"orders": [...]}`` or one record; returns one row per record.

    Lists and wrapped lists are cut into records over byte ranges
    (``json_records``), so a large file is read by many tasks; a file of any
    other shape is one record, unless its array stands behind nested fields.
    Values are strings unless ``schema`` declares the records."""
    paths = expand_paths(spark, path)
    if not paths:
        return None
    depths = materialize(JR.shapes(spark, paths), "json-shapes")
    found = {r.depth for r in depths.select("depth").distinct().collect()}
    parts = []

    def reader(multi: bool):
        r = spark.read.option("multiLine", multi).option("primitivesAsString", True)
        return r.schema(schema) if schema is not None else r

    if found & {1, 2}:
        parts.append(reader(False).json(JR.as_lines(spark, paths, depths)))
    if None in found:
        rest = [r.file for r in depths.where("depth is null").collect()]
        df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(rest)
        for wrapper in JR.WRAPPERS:
            field = next((f for f in df.schema.fields if f.name == wrapper), None)
            if field is not None and isinstance(field.dataType, T.ArrayType) \
                    and isinstance(field.dataType.elementType, T.StructType):
                df = df.select(F.inline(F.col(wrapper)))
                break
        else:
            df = reader(True).json(rest)
        parts.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_source(spark: SparkSession, spec) -> DataFrame | None:
    if not spec.path:
        return None
    if spec.fmt == "csv":
        return read_csv(spark, spec.path)
    if spec.fmt == "json":
        return read_json_records(spark, spec.path)
    if spec.fmt == "parquet":
        return spark.read.parquet(spec.path) if _hadoop_exists(spark, spec.path) else None
    raise ValueError(f"unknown format {spec.fmt}")


def pad_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: present columns cast, absent ones NULL."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), header: bool = True) -> None:
    """Stage sink.  ``mode="ignore"`` skips an existing target."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)


def write_groups(df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = 1_000_000,
                 mode: str = "overwrite", fmt: str = "parquet", header: bool = True) -> None:
    """One folder per group (values of ``by``), files of at most
    ``rows_per_file`` rows.

    A group of n rows is dealt into n / rows_per_file pieces (rounded up) by row
    hash and a piece is written by one task: a group that holds a third of the
    rows is written by many tasks, and a small one isn't written by all of them."""
    by = list(by)
    groups = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_pieces"))
    same = [df[c].eqNullSafe(F.col(f"_g_{c}")) for c in by]
    cut = groups.select("_pieces", *[F.col(c).alias(f"_g_{c}") for c in by])
    dealt = df.join(cut, reduce(lambda a, b: a & b, same)).withColumn(
        "_piece", F.pmod(F.xxhash64(*df.columns), F.col("_pieces"))).select(*df.columns, "_piece")
    w = (dealt.repartition(*by, "_piece").drop("_piece").write.mode(mode)
         .option("maxRecordsPerFile", rows_per_file).partitionBy(*by))
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)


def convert_json_to_table(spark: SparkSession, src: str, dst: str, fmt: str = "parquet") -> bool:
    """JSON -> tabular file, skipped when the target already exists."""
    if _hadoop_exists(spark, dst):
        return False
    df = read_json_records(spark, src)
    if df is None:
        return False
    write_stage(df, dst, fmt=fmt, mode="ignore")
    return True


def save_table(df: DataFrame, name: str, mode: str = "overwrite", jdbc: dict | None = None,
               batch_size: int = 5000, dry_run: bool = False, partition_by: Sequence[str] = (),
               bucket_by: tuple[int, Sequence[str]] | None = None) -> str:
    """Warehouse sink — a catalog table, or a JDBC table in batches.

    ``bucket_by=(n, cols)`` writes a bucketed, sorted table: two tables
    bucketed the same way on the join key (fact and customer dimension on
    ``customer_key``) are joined later without shuffling either side."""
    if dry_run:
        return f"dry run: {name} prepared"
    if jdbc:
        (df.write.mode(mode).format("jdbc").options(**jdbc)
           .option("dbtable", name).option("batchsize", batch_size).save())
    else:
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            n, cols = bucket_by
            w = w.bucketBy(n, *cols).sortBy(*cols)
        w.saveAsTable(name)
    return name
