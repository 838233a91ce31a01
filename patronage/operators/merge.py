"""Merge of the transformed sources into one sales-line table (U01, P21-P27,
J02, A04).

The harmonised profile is one ``groupBy(customer_id)`` whose first-non-null
values use ``min_by`` over an explicit total order (source rank, transaction
id, date) — row order does not exist in Spark.  Joining it back is a
shuffle join on customer id; a hot customer (the guest id 0 can hold a third
of all lines) is split by AQE's skew-join handling on the line side, while
the profile side has exactly one row per id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_pick, hash_range, id_before_dot

MERGED_COLUMNS = (
    "transaction_id", "date", "customer_id", "age", "gender", "country",
    "category", "quantity", "unit_price", "total_amount",
)
# Default country list for customers without one (a caller may pass its own).
DEFAULT_COUNTRIES = (
    "United Kingdom", "France", "Germany", "Spain", "Netherlands",
    "Australia", "Vietnam", "United States", "Japan", "Brazil",
)
MERGE_AGE = (18, 80)
SOURCE_RANK = {"Kaggle": 0, "UCI": 1, "ORD": 2}


def union_sources(frames: Sequence[DataFrame | None]) -> DataFrame:
    """Union by name; absent columns NULL, absent sources ignored."""
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("no source data")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def _rank_of(source_col: str, ranks: dict[str, int]):
    expr = None
    for name, r in ranks.items():
        cond = F.col(source_col) == name
        expr = F.when(cond, F.lit(r)) if expr is None else expr.when(cond, F.lit(r))
    return expr.otherwise(F.lit(len(ranks))) if expr is not None else F.lit(0)


def first_non_null(value: str, order, prefer_known: bool = False):
    """Value at the lowest ``order`` among rows where it is known."""
    known = F.col(value).isNotNull()
    if prefer_known:
        known = known & (F.col(value) != "Unknown")
    return F.min_by(F.col(value), F.when(known, order))


def customer_profiles(lines: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES,
                      ranks: dict[str, int] = SOURCE_RANK) -> DataFrame:
    """One row per customer: harmonised age / gender / country."""
    order = F.struct(_rank_of("source", ranks).alias("r"), F.col("transaction_id"), F.col("date"))
    prof = lines.groupBy("customer_id").agg(
        first_non_null("gender", order).alias("gender"),
        first_non_null("age", order).alias("age"),
        first_non_null("country", order, prefer_known=True).alias("country"),
    )
    cid = F.col("customer_id")
    return prof.select(
        "customer_id",
        F.when(F.col("age").isNull() | (F.col("age") == 0),
               hash_range(cid, MERGE_AGE[0], MERGE_AGE[1], salt="age:").cast("double"))
         .otherwise(F.col("age")).alias("age"),
        F.coalesce(F.col("gender"), hash_pick(cid, ("Male", "Female"), salt="gender:")).alias("gender"),
        F.when(F.col("country").isNull() | (F.col("country") == "Unknown"),
               hash_pick(cid, countries, salt="country:")).otherwise(F.col("country")).alias("country"),
    )


def merge_sources(frames: Sequence[DataFrame | None], countries: Sequence[str] = DEFAULT_COUNTRIES,
                  keep_source: bool = False, ranks: dict[str, int] = SOURCE_RANK,
                  per_row: bool = True) -> DataFrame:
    """Union, normalise ids and dates, harmonise profiles, recompute totals.

    ``keep_source`` adds ``source`` and ``timestamp``, the landed time before
    it is cut to a day.  With ``per_row`` every total is quantity x unit price;
    without it landed totals stay if no line lacks one, and one missing total
    (or none landed) recomputes all.
    """
    full = union_sources(frames)
    landed = None
    if not per_row and "total_amount" in full.columns:
        landed = F.col("total_amount").cast("string").try_cast("double").cast("decimal(15,2)")
        full = full.withColumn("_landed", landed)
        whole = full.select(F.count_if(F.col("_landed").isNull()) == 0).scalar()
    for c in ("country", "gender", "age", "category", "source"):
        if c not in full.columns:
            full = full.withColumn(c, F.lit(None).cast("double" if c == "age" else "string"))
    full = (full.withColumn("timestamp", F.col("date").cast("timestamp_ntz"))
                .withColumn("date", F.to_date("date"))                                   # P24
                .withColumn("transaction_id", F.col("transaction_id").cast("string"))
                .withColumn("customer_id", id_before_dot("customer_id")))              # P25
    profile = customer_profiles(full, countries, ranks)
    lines = full.drop("age", "gender", "country").join(profile, "customer_id", "left")  # J02
    qty = F.coalesce(F.col("quantity").cast("string").try_cast("double"), F.lit(0.0))
    price = F.coalesce(F.col("unit_price").cast("string").try_cast("double"), F.lit(0.0))
    amount = (F.col("quantity") * F.col("unit_price")).cast("decimal(15,2)")
    lines = (lines.withColumn("quantity", qty.cast("int"))
                  .withColumn("unit_price", price.cast("decimal(10,2)"))
                  .withColumn("total_amount",                                          # P26
                              amount if landed is None else F.when(whole, F.col("_landed")).otherwise(amount))
                  .withColumn("age", F.round("age").cast("int")))
    cols = [c for c in MERGED_COLUMNS if c in lines.columns]                             # P27
    if keep_source:
        cols += ["source", "timestamp"]
    return lines.select(*cols)
