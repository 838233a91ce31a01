"""A stored warehouse that takes new lines without reading all of its fact.

Layout of a store: a folder per dimension; ``fact_sales`` by calendar month of
the line (``month=yyyy-MM``, ``none`` without a date), each row with a 64-bit
hash of its business key; ``loads``, one row per load with the fact keys it
reserved.

A load
1. maps its lines to surrogate keys: unseen members are appended to the
   dimensions, keys of old members never change;
2. reads the fact's hashes of the months in the batch only (a filter on the
   partition column), and of those the rows whose hash is in the batch;
3. drops lines whose key is loaded: equal in hash and, null-safe, in every
   column of the key;
4. reserves the next fact keys in ``loads``, then appends the rest.

A load that fails may be run again: members and lines it wrote are found as
loaded, and keys it reserved are skipped.  One load runs at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, stage_root
from ..sources.files import write_groups
from .keys import with_sequential_id
from .warehouse import DECLARED, FACT_ORDER, Warehouse, date_parts, keep_first

#: The fact's columns that name a line; members stand for their values since their keys never change.
LINE_KEY = ("transaction_id", "date_id", "customer_key", "category_id", "quantity", "unit_price", "total_amount")


def key_hash(cols: tuple[str, ...] = LINE_KEY) -> Column:
    """64 bits that name a line by its key; a null is a value of its own."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def month_of(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none"))


def _typed(lines: DataFrame) -> DataFrame:
    """Lines in the types of the fact table: they are compared as stored."""
    types = {"quantity": "int", "unit_price": "decimal(10,2)", "total_amount": "decimal(15,2)", "date": "date"}
    return lines.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


@dataclass
class StoredWarehouse(Warehouse):
    """The tables of a store as they were when it was opened."""

    path: str
    #: The fact with ``month`` and ``key_hash``.
    fact_stored: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.fact_stored.sparkSession

    def loaded_like(self, keyed: DataFrame) -> DataFrame:
        """Stored keys of lines that may be among ``keyed`` (LINE_KEY, month, key_hash)."""
        months = [r.month for r in keyed.select("month").distinct().collect()]  # calendar months
        return (self.fact_stored.where(F.col("month").isin(months)).select("key_hash", *LINE_KEY)
                .join(keyed.select("key_hash").distinct(), "key_hash", "left_semi"))

    def load(self, lines: DataFrame, staged: bool = False) -> StoredWarehouse:
        """The store with those of ``lines`` that it hadn't; lines that repeat
        within ``lines`` are lines of their own.  ``staged``: they are read from
        a stage table already."""
        lines = _typed(lines) if staged else materialize(_typed(lines), "load-lines")
        categories = self._extended("dim_category", "category_id", "category", lines.select("category"))
        locations = self._extended("dim_location", "location_id", "country", lines.select("country"))
        dates = self._extended("dim_date", "date_id", "date", lines.select("date"))
        customers = self._with_customers(lines, locations)
        keyed = (lines.select(*FACT_ORDER)
                 .join(customers.select("customer_id", "customer_key"), "customer_id", "left")
                 .join(categories.select("category", "category_id"), "category", "left")
                 .join(F.broadcast(dates.select("date", "date_id")), "date", "left")  # calendar days
                 .withColumn("month", month_of("date")).withColumn("key_hash", key_hash()))
        keyed = materialize(keyed, "load-keyed")
        old = self.loaded_like(keyed).select(*[F.col(c).alias(f"_{c}") for c in ("key_hash", *LINE_KEY)])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LINE_KEY],
                      F.col("key_hash") == F.col("_key_hash"))
        # numbered from 0 on a stage table, whose rows are then counted
        numbered = with_sequential_id(keyed.join(old, same, "left_anti"), list(FACT_ORDER), name="sales_id", start=0)
        start = self._reserve(numbered.count())
        numbered = numbered.withColumn("sales_id", F.col("sales_id") + F.lit(start))
        write_groups(_stored_form(numbered), f"{self.path}/fact_sales", ["month"], mode="append")
        return open_store(self.spark, self.path)

    def _reserve(self, rows: int) -> int:
        """The first of ``rows`` new fact keys; later loads start behind them."""
        loads = self.spark.read.parquet(f"{self.path}/loads")
        first = loads.select(F.coalesce(F.max("last"), F.lit(0))).first()[0] + 1
        row = [(uuid.uuid4().hex, first, first + rows - 1)]
        self.spark.createDataFrame(row, "load string, first long, last long").write.mode("append").parquet(
            f"{self.path}/loads")
        return first

    def _extended(self, table: str, key: str, value: str, values: DataFrame) -> DataFrame:
        """A small dimension with its unseen values appended, keys going on."""
        old = getattr(self, table)
        fresh = values.where(F.col(value).isNotNull()).distinct().join(old.select(value), value, "left_anti")
        start = old.select(F.coalesce(F.max(key), F.lit(0))).scalar()
        fresh = with_sequential_id(fresh, [value], name="_seq").withColumn(key, (F.col("_seq") + start).cast("int"))
        parts = date_parts(value) if table == "dim_date" else []
        return self._appended(table, fresh.select(key, value, *parts))

    def _with_customers(self, lines: DataFrame, locations: DataFrame) -> DataFrame:
        first = keep_first(lines, "customer_id", ["gender", "age", "country"],
                           ["transaction_id", "date", "category", "quantity", "unit_price"])
        fresh = first.where(F.col("customer_id").isNotNull()).join(
            self.dim_customer.select("customer_id"), "customer_id", "left_anti").join(locations, "country", "left")
        start = self.dim_customer.select(F.coalesce(F.max("customer_key"), F.lit(0))).scalar()
        fresh = with_sequential_id(fresh, ["customer_id"], name="_seq").select(
            (F.col("_seq") + start).cast("int").alias("customer_key"), "customer_id", "gender",
            F.col("age").cast("int"), F.col("location_id").cast("int"))
        return self._appended("dim_customer", fresh)

    def _appended(self, table: str, fresh: DataFrame) -> DataFrame:
        fresh = materialize(fresh, f"load-{table}")
        if not fresh.isEmpty():
            fresh.write.mode("append").parquet(f"{self.path}/{table}")
        return getattr(self, table).unionByName(fresh)


def _stored_form(fact: DataFrame) -> DataFrame:
    return fact.select(F.col("sales_id").cast("bigint"), "transaction_id", F.col("date_id").cast("int"),
                       F.col("customer_key").cast("int"), F.col("category_id").cast("int"),
                       F.col("quantity").cast("int"), F.col("unit_price").cast("decimal(10,2)"),
                       F.col("total_amount").cast("decimal(15,2)"), "key_hash", "month")


def create_store(wh: Warehouse, path: str) -> StoredWarehouse:
    """Write a warehouse as a store; ``path`` is a folder on shared storage."""
    path = path.rstrip("/")
    for name in ("dim_date", "dim_category", "dim_location", "dim_customer"):
        getattr(wh, name).write.parquet(f"{path}/{name}")
    fact = (wh.fact_sales.join(F.broadcast(wh.dim_date.select("date_id", "date")), "date_id", "left")
            .withColumn("month", month_of("date")).withColumn("key_hash", key_hash()))
    write_groups(_stored_form(fact), f"{path}/fact_sales", ["month"])
    spark = wh.fact_sales.sparkSession
    stored = _read_fact(spark, path)
    stored.agg(F.lit("first").alias("load"), F.lit(1).cast("long").alias("first"),
               F.coalesce(F.max("sales_id"), F.lit(0)).alias("last")).write.parquet(f"{path}/loads")
    return open_store(spark, path)


def _read_fact(spark: SparkSession, path: str) -> DataFrame:
    # the schema is given: a store without lines has no file to infer it from
    return spark.read.schema(f"{DECLARED['fact_sales']}, key_hash BIGINT, month STRING").parquet(f"{path}/fact_sales")


def open_store(spark: SparkSession, path: str) -> StoredWarehouse:
    path = path.rstrip("/")
    dims = {name: spark.read.schema(DECLARED[name]).parquet(f"{path}/{name}")
            for name in ("dim_date", "dim_category", "dim_location", "dim_customer")}
    stored = _read_fact(spark, path)
    declared = [f.name for f in T.StructType.fromDDL(DECLARED["fact_sales"])]
    return StoredWarehouse(**dims, fact_sales=stored.select(*declared), path=path, fact_stored=stored)


def incremental_load(wh: Warehouse, lines: DataFrame, path: str | None = None,
                     staged: bool = False) -> StoredWarehouse:
    """Load ``lines`` into a warehouse, which is stored first (at ``path``) unless it is a store."""
    if not isinstance(wh, StoredWarehouse):
        spark = wh.fact_sales.sparkSession
        wh = create_store(wh, path or f"{stage_root(spark)}/store-{uuid.uuid4().hex}")
    return wh.load(lines, staged)
