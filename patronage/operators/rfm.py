"""Recency / frequency / monetary features, scores and segments.

All per-customer work is one ``groupBy`` (partial aggregation map-side, so a
hot customer such as the guest id 0 is pre-combined before the shuffle).
Dataset-wide constants (reference date, quantile edges) are lazy scalar
subqueries: Spark computes each once as its own job and inlines the value —
no cross join, no driver round trip, no single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (
    days_between, edge_score, gender_code, rank_ntile, segment_of, shift_old_years,
)
from ..session import materialize
from .keys import with_sequential_id
from .stats import median_of, quantiles


def positive_sales(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Keep sales lines with a positive amount (returns and zero lines out)."""
    return df.filter(F.col(amount) > 0)


def realign_years(df: DataFrame, date: str = "date", before_year: int = 2015, years: int = 13) -> DataFrame:
    return df.withColumn(date, shift_old_years(date, before_year, years))


def rfm(df: DataFrame, customer: str = "customer_id", date: str = "date",
        txn: str = "transaction_id", amount: str = "total_amount",
        ref_offset_days: int = 1, money_type: str = "decimal(18,2)", stage: bool = True,
        exclude_guests: bool = False, guest: str = "0") -> DataFrame:
    """Registered-customer RFM.  ``exclude_guests`` leaves out the lines of the
    walk-in id ``guest``, and with them their dates.

    Recency = days from (latest date in the data + ``ref_offset_days``) to the
    customer's last date; Frequency = distinct transactions; Monetary = sum.
    """
    if exclude_guests:
        df = df.where(F.col(customer) != guest)
    # The reference date is the max of the per-customer last dates: with the
    # aggregate staged, the lines are read once and the reference is a scan
    # of the (much smaller) customer table, not a second pass over the input.
    agg = df.groupBy(customer).agg(
        F.max(F.col(date).cast("date")).alias("_last"),
        F.countDistinct(txn).cast("bigint").alias("Frequency"),
        F.sum(amount).cast(money_type).alias("Monetary"),
    )
    if stage:
        agg = materialize(agg, "rfm-agg")
    ref = agg.select(F.date_add(F.max("_last"), ref_offset_days)).scalar()
    return agg.select(customer, F.datediff(ref, F.col("_last")).cast("bigint").alias("Recency"),
                      "Frequency", "Monetary")


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "input") -> None:
    """Fail before planning when named columns are absent, listing them."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required column(s): {', '.join(missing)}")


def rfm_by_rows(df: DataFrame, customer: str = "customer_id", date: str = "date",
                amount: str = "total_amount", stage: bool = True) -> DataFrame:
    """Guest / upload RFM: reference = latest timestamp (no extra day),
    Recency in whole days (floor), Frequency = number of rows."""
    require_columns(df, [date, customer, amount], "upload")
    agg = df.groupBy(customer).agg(
        F.max(F.col(date).cast("timestamp_ntz")).alias("_last"),
        F.count(F.lit(1)).cast("bigint").alias("Frequency"),
        F.sum(F.col(amount).cast("double")).alias("Monetary"),
    )
    if stage:
        agg = materialize(agg, "rfm-rows-agg")
    ref = agg.select(F.max("_last")).scalar()
    return agg.select(customer, days_between(ref, "_last").alias("Recency"), "Frequency", "Monetary")


def score_columns(df: DataFrame, q: int = 5, reverse_recency: bool = True,
                  method: str = "edges", order: Sequence[str] = ("customer_id",), stage: bool = True) -> DataFrame:
    """Add R_Score, F_Score, M_Score (1..q).

    ``method="edges"``: interpolated quantile edges, right-closed bins (a value
    takes the lowest bin whose upper edge >= value, defined even when edges tie).
    ``method="rank"``: rank each value (ties broken by ``order``), then cut the
    rank at interpolated edges — every label is used even for tied values.
    """
    require_columns(df, ["Recency", "Frequency", "Monetary"], "RFM table")
    probs = [i / q for i in range(1, q)]
    if stage:  # one write; the quantile passes then scan a small stage table
        df = materialize(df, "rfm-scores-in")
    out = df
    found = quantiles(df, ["Recency", "Frequency", "Monetary"], probs) if method == "edges" else {}
    for src, dst in (("Recency", "R_Score"), ("Frequency", "F_Score"), ("Monetary", "M_Score")):
        rev = reverse_recency and src == "Recency"
        if method == "edges":
            edges = [F.lit(x).cast("double") for x in found[src]]
            out = out.withColumn(dst, edge_score(src, edges, reverse=rev))
        elif method == "rank":
            n = df.select(F.count(F.lit(1))).scalar()
            keyed = with_sequential_id(out, [src, *order], name="_rn")
            sc = rank_ntile("_rn", n, q)
            out = keyed.withColumn(dst, (F.lit(q + 1) - sc).cast("int") if rev else sc).drop("_rn")
        else:
            raise ValueError(f"unknown method {method!r}")
    return out


def rfm_code(r: str | Column = "R_Score", f: str | Column = "F_Score", m: str | Column = "M_Score") -> Column:
    """Concatenated score code, e.g. '543'."""
    return F.concat(*[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in (r, f, m)])


def segment_scores(df: DataFrame) -> DataFrame:
    """Add RFM_Score code and the rule-cascade Segment."""
    return (df.withColumn("RFM_Score", rfm_code())
              .withColumn("Segment", segment_of("R_Score", "F_Score", "M_Score")))


def category_shares_long(df: DataFrame, customer: str = "customer_id",
                         category: str = "category", amount: str = "total_amount") -> DataFrame:
    """Share of each customer's spend per category (long form)."""
    per = df.groupBy(customer, category).agg(F.sum(amount).alias("_s"))
    tot = df.groupBy(customer).agg(F.sum(amount).alias("_t"))
    return (per.join(tot, customer)
               .select(customer, category,
                       F.round(F.try_divide(F.col("_s").cast("double"), F.col("_t").cast("double")), 6).alias("share")))


def rfm_full(df: DataFrame, categories: Sequence[str], customer: str = "customer_id",
             date: str = "date", txn: str = "transaction_id", amount: str = "total_amount",
             category: str = "category", prefix: str = "Pct_", stage: bool = True) -> DataFrame:
    """RFM + category shares (wide) + demographics in ONE grouped pass.

    Category spend is a conditional sum per known category, so no pivot job,
    no extra joins; first non-null age / gender use ``min_by`` over an
    explicit order (``txn``, date) instead of row order.
    """
    total = F.sum(F.col(amount).cast("double"))
    cat_aggs = [
        F.coalesce(F.try_divide(F.sum(F.when(F.col(category) == c, F.col(amount).cast("double"))), total),
                   F.lit(0.0)).alias(f"{prefix}{c}")
        for c in categories
    ]
    order = F.struct(F.col(txn), F.col(date))
    agg = df.groupBy(customer).agg(
        F.max(F.col(date).cast("date")).alias("_last"),
        F.countDistinct(txn).cast("bigint").alias("Frequency"),
        total.alias("Monetary"),
        *cat_aggs,
        F.min_by(F.col("age"), F.when(F.col("age").isNotNull(), order)).cast("double").alias("age"),
        F.min_by(F.col("gender"), F.when(F.col("gender").isNotNull(), order)).alias("_gender"),
    )
    if stage:
        agg = materialize(agg, "rfm-full-agg")
    ref = agg.select(F.date_add(F.max("_last"), 1)).scalar()
    med = median_of(agg, "age")
    out = agg.withColumn("Recency", F.datediff(ref, F.col("_last")).cast("bigint")).drop("_last")
    return (out.withColumn("gender", gender_code("_gender")).drop("_gender")
               .withColumn("age", F.coalesce(F.col("age"), med)))
