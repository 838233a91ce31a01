"""Star schema: four dimensions, one fact table, FK checks, incremental load.

Surrogate keys come from ``keys.with_sequential_id`` (range partitioning +
per-partition offsets), never from a single-partition window.  Dimension
joins carry no broadcast hints except for ``dim_date``, whose size is bounded
by the number of calendar days; the others are left to AQE, which broadcasts
a side only after measuring it below ``autoBroadcastJoinThreshold`` and
otherwise keeps a shuffle join (with skew splitting on the fact side).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .keys import with_sequential_id
from .skew import SALT, cut_by_salt

# Column names of the declared star schema.
FACT_ORDER = ("transaction_id", "date", "customer_id", "category", "quantity", "unit_price", "total_amount")


@dataclass
class Warehouse:
    dim_date: DataFrame
    dim_category: DataFrame
    dim_location: DataFrame
    dim_customer: DataFrame
    fact_sales: DataFrame
    #: Fact and customers with salts, bucketed alike (``persist_warehouse``).
    salted: tuple[DataFrame, DataFrame] | None = field(default=None, kw_only=True)

    def fact_with_customers(self) -> DataFrame:
        """fact x customer: on (key, salt) where the tables were stored with salts."""
        if self.salted is None:
            return self.fact_sales.join(self.dim_customer, "customer_key")
        fact, customers = self.salted
        return fact.join(customers, ["customer_key", SALT]).drop(SALT)

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_category": self.dim_category,
                "dim_location": self.dim_location, "dim_customer": self.dim_customer,
                "fact_sales": self.fact_sales}

    def register(self) -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


class LineWarehouse(Warehouse):
    """The star schema of sales lines; a table is built when it is asked for.

    The lines are staged once, numbered in fact order.  That number is the
    fact's key and orders a customer's lines, so the first profile of a
    customer is an aggregate over fixed-width columns (a hash aggregate).
    ``staged``: the lines are read from a stage table already.
    """

    def __init__(self, lines: DataFrame, staged: bool = False):
        self.lines = lines.withColumn("date", F.col("date").cast("date"))
        self.on_stage = staged

    @cached_property
    def staged(self) -> DataFrame:
        return self.lines if self.on_stage else materialize(self.lines, "warehouse-lines")

    @cached_property
    def numbered(self) -> DataFrame:
        return with_sequential_id(self.staged, list(FACT_ORDER), name="sales_id")

    @cached_property
    def _small(self) -> dict[str, DataFrame]:
        return small_dims(self.staged)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._small["date"].select(F.col("_k").alias("date_id"), F.col("_d").alias("date"), *date_parts("_d"))

    @cached_property
    def dim_category(self) -> DataFrame:
        return self._small["category"].select(F.col("_k").alias("category_id"), F.col("_s").alias("category"))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._small["country"].select(F.col("_k").alias("location_id"), F.col("_s").alias("country"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        genders = self._small["gender"].select(F.col("_k").alias("_gender"), F.col("_s").alias("gender"))
        coded = (self.numbered.select("sales_id", "customer_id", "gender", "age", "country")
                 .join(genders, "gender", "left").join(self.dim_location, "country", "left"))      # J03
        located = first_of(coded, "customer_id", ["_gender", "age", "location_id"], "sales_id").join(
            genders, "_gender", "left")
        keyed = with_sequential_id(located, ["customer_id"], name="customer_key")
        return keyed.select(F.col("customer_key").cast("int"), "customer_id", "gender",
                            F.col("age").cast("int"), F.col("location_id").cast("int"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return build_fact(self.numbered, self.dim_customer, self.dim_category, self.dim_date)


def date_parts(d: str = "date") -> list:
    """Calendar attributes of a date column."""
    c = F.col(d)
    return [
        F.date_format(c, "yyyyMMdd").cast("int").alias("date_key"),
        F.dayofmonth(c).alias("day"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.quarter(c).alias("quarter"),
        F.year(c).alias("year"),
        (F.weekday(c) >= 5).alias("is_weekend"),
    ]


def keep_first(lines: DataFrame, key: str, cols: list[str], order: list[str]) -> DataFrame:
    """First row per ``key`` by an explicit order, as an aggregate
    (partial, skew-safe) rather than a window over the whole group."""
    ordered = F.struct(*[F.col(c) for c in order])
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), ordered).alias("_first")
    return lines.groupBy(key).agg(picked).select(key, *[F.col(f"_first.{c}").alias(c) for c in cols])


def first_of(lines: DataFrame, key: str, cols: list[str], order: str) -> DataFrame:
    """The values of each key's first line by a number; fixed-width columns
    keep it a hash aggregate, combined map-side."""
    return lines.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in cols])


def build_fact(numbered: DataFrame, dim_customer: DataFrame, dim_category: DataFrame,
               dim_date: DataFrame) -> DataFrame:
    """J04-J06 + W03: map business keys to surrogate keys of lines that carry sales_id."""
    f = numbered.select("sales_id", *FACT_ORDER)
    f = f.join(dim_customer.select("customer_id", "customer_key"), "customer_id", "left")   # J04
    f = f.join(dim_category.select("category", "category_id"), "category", "left")         # J05
    # dim_date: at most one row per calendar day -> bounded, broadcast is safe
    f = f.join(F.broadcast(dim_date.select("date", "date_id")), "date", "left")            # J06
    return f.select(F.col("sales_id").cast("bigint"), "transaction_id", F.col("date_id").cast("int"),
                    F.col("customer_key").cast("int"), F.col("category_id").cast("int"),
                    F.col("quantity").cast("int"), F.col("unit_price").cast("decimal(10,2)"),
                    F.col("total_amount").cast("decimal(15,2)"))


SMALL = ("date", "category", "country", "gender")


def small_dims(lines: DataFrame) -> dict[str, DataFrame]:
    """Keys 1..n of the distinct values of the small columns, all from ONE
    pass over the lines: (_k, _s, _d) per column.  The rank inside a column is
    the global place minus the place of the column's first value."""
    def value(k: int, c: str) -> Column:
        text, day = (F.lit(None).cast("string"), F.col(c)) if c == "date" else (F.col(c), F.lit(None).cast("date"))
        return F.struct(F.lit(k).alias("_dim"), text.alias("_s"), day.alias("_d"))

    vals = (lines.select(F.explode(F.array(*[value(k, c) for k, c in enumerate(SMALL)])).alias("x")).select("x.*")
            .where(F.col("_s").isNotNull() | F.col("_d").isNotNull()).distinct())
    keyed = materialize(with_sequential_id(vals, ["_dim", "_d", "_s"], name="_g"), "warehouse-small")
    starts = keyed.groupBy("_dim").agg(F.min("_g").alias("_start"))  # one row per column
    ranked = keyed.join(F.broadcast(starts), "_dim").withColumn("_k", (F.col("_g") - F.col("_start") + 1).cast("int"))
    return {c: ranked.where(F.col("_dim") == k).select("_k", "_s", "_d") for k, c in enumerate(SMALL)}


def build_warehouse(lines: DataFrame, staged: bool = False) -> Warehouse:
    return LineWarehouse(lines, staged)


def referential_checks(wh: Warehouse) -> DataFrame:
    """Orphan counts for every declared foreign key (0 = consistent)."""
    f = wh.fact_sales
    checks = [
        ("dim_customer.location_id", wh.dim_customer.where(F.col("location_id").isNotNull()),
         wh.dim_location, "location_id"),
        ("fact_sales.date_id", f, wh.dim_date, "date_id"),
        ("fact_sales.customer_key", f, wh.dim_customer, "customer_key"),
        ("fact_sales.category_id", f, wh.dim_category, "category_id"),
    ]
    parts = []
    for name, child, parent, key in checks:
        orphans = child.select(key).join(parent.select(key), key, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphans"))
                     .select(F.lit(name).alias("foreign_key"), F.col("orphans").cast("bigint")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The declared columns of the star schema and each table's key.
DECLARED = {
    "dim_date": ("date_id INT, date DATE, date_key INT, day INT, month INT, month_name STRING, quarter INT, "
                 "year INT, is_weekend BOOLEAN"),
    "dim_category": "category_id INT, category STRING",
    "dim_location": "location_id INT, country STRING",
    "dim_customer": "customer_key INT, customer_id STRING, gender STRING, age INT, location_id INT",
    "fact_sales": ("sales_id BIGINT, transaction_id STRING, date_id INT, customer_key INT, category_id INT, "
                   "quantity INT, unit_price DECIMAL(10,2), total_amount DECIMAL(15,2)"),
}
PRIMARY_KEYS = {"dim_date": "date_id", "dim_category": "category_id", "dim_location": "location_id",
                "dim_customer": "customer_key", "fact_sales": "sales_id"}


def schema_checks(wh: Warehouse) -> DataFrame:
    """Per table its rows, rows without a key, keys that occur twice or
    more, and whether its columns are the declared ones in name and type."""
    parts = []
    for name, df in wh.tables().items():
        key = PRIMARY_KEYS[name]
        declared = T.StructType.fromDDL(DECLARED[name])
        same = [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in df.schema]
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
            F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).cast("bigint").alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), "*", F.lit(same).alias("as_declared")))
    return reduce(DataFrame.unionByName, parts)


# --- star joins over the warehouse (J07-J09, S08) -----------------------------
def star_join_rfm(wh: Warehouse) -> DataFrame:
    """Fact x customer x date x category, positive amounts."""
    return (wh.fact_with_customers().where(F.col("total_amount") > 0)
             .join(F.broadcast(wh.dim_date), "date_id")
             .join(wh.dim_category, "category_id")
             .select("customer_id", "transaction_id", "total_amount", "date", "age", "gender", "category"))


def star_join_dates(wh: Warehouse) -> DataFrame:
    """Fact x customer x date, positive amounts."""
    return (wh.fact_with_customers().where(F.col("total_amount") > 0).join(F.broadcast(wh.dim_date), "date_id")
             .select("customer_id", "date", "transaction_id", "total_amount"))


def star_join_categories(wh: Warehouse) -> DataFrame:
    """Fact x customer x category x date, date projected as transaction_date."""
    return (wh.fact_with_customers().where(F.col("total_amount") > 0).join(wh.dim_category, "category_id")
             .join(F.broadcast(wh.dim_date), "date_id")
             .select("customer_id", "transaction_id", "category", F.col("date").alias("transaction_date")))


def persist_warehouse(wh: Warehouse, database: str, buckets: int, mode: str = "overwrite") -> Warehouse:
    """Write the five tables to the catalog, the fact with salts, and
    ``customer_by_salt``, the customers once per salt of theirs.  These two are
    bucketed (and sorted) on (customer_key, salt) with the same bucket count, so
    the largest star join reads both sides already co-partitioned — no shuffle
    of the fact, and a customer with more than a bucket's share of lines lies in
    several buckets.  The other tables are plain (joined by measured-size broadcast)."""
    from ..sources.files import save_table

    spark = wh.fact_sales.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    small = ("dim_date", "dim_category", "dim_location", "dim_customer")
    for name in small:
        save_table(getattr(wh, name), f"{database}.{name}", mode=mode)
    fact, customers = cut_by_salt(wh.fact_sales, wh.dim_customer, "customer_key", "sales_id", buckets)
    for df, name in ((fact, "fact_sales"), (customers, "customer_by_salt")):
        save_table(df.repartition(buckets, "customer_key", SALT), f"{database}.{name}", mode=mode,
                   bucket_by=(buckets, ["customer_key", SALT]))
    fact, customers = spark.table(f"{database}.fact_sales"), spark.table(f"{database}.customer_by_salt")
    declared = [f.name for f in T.StructType.fromDDL(DECLARED["fact_sales"])]
    return Warehouse(*[spark.table(f"{database}.{name}") for name in small], fact.select(*declared),
                     salted=(fact, customers))
