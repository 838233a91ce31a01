"""Report frames behind the dashboard and charts (A05-A35, W01, W09, T02-T05,
J10, J16, M09, M29).

Grouped reports are single ``groupBy`` passes (partial aggregation, so hot
keys are pre-combined map-side); pivots use a *fixed* value list as
conditional counts, so no extra job discovers the columns; table-wide
constants are scalar subqueries.  Windows appear only over already
aggregated, bounded tables (months, clusters, segments).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import gram
from .keys import expanded_ranks, with_sequential_id
from .stats import group_quantiles, quantiles


def one_row(df: DataFrame) -> DataFrame:
    """Exactly one row derived from ``df`` (a global aggregate), to carry
    scalar results without joins."""
    return df.agg(F.count(F.lit(1)).alias("_rows"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Rows per value (sort on output with ``orderBy(col)``)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def shares(df: DataFrame, col: str) -> DataFrame:
    """A10: count and share of each value, and whether it is the top one."""
    counts = value_counts(df, col)
    total = df.select(F.count(F.lit(1))).scalar()
    top = counts.select(F.min_by(F.col(col), F.struct(-F.col("count"), F.col(col)))).scalar()
    return counts.select(col, "count", F.round(F.col("count") * 100.0 / total, 4).alias("percent"),
                         (F.col(col) == top).alias("is_top"))


def group_means(df: DataFrame, by: str | Sequence[str], cols: Sequence[str], nd: int = 2) -> DataFrame:
    """Rounded means per group."""
    return df.groupBy(by).agg(*[F.round(F.avg(c), nd).alias(c) for c in cols])


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Rows x fixed column values, missing combinations 0."""
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).cast("bigint").alias(v) for v in values])


def row_normalised(df: DataFrame, row: str, col: str, values: Sequence[str], nd: int = 4) -> DataFrame:
    """Crosstab normalised per row, in percent."""
    n = F.count(F.lit(1))
    return df.groupBy(row).agg(*[F.round(F.count_if(F.col(col) == v) * 100.0 / n, nd).alias(v) for v in values])


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values (ties by value) — a limit that *is* the feature."""
    return value_counts(df, col).orderBy(F.desc("count"), F.asc(col)).limit(k)


def in_top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose value is among the top k (semi join on a k-row table)."""
    return df.join(F.broadcast(top_k(df, col, k).select(col)), col, "left_semi")


def lifespan(df: DataFrame, customer: str = "customer_id", date: str = "date") -> DataFrame:
    """Days between a customer's first and last purchase."""
    return df.groupBy(customer).agg(F.datediff(F.max(date), F.min(date)).cast("bigint").alias("lifespan_days"))


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers clipped to the data, per group.

    Quartiles come from ``group_quantiles``: a group's values are spread over
    range partitions, so a group may hold any share of the rows."""
    q = group_quantiles(df, [by], value, [0.25, 0.5, 0.75])
    q = q.select(by, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    j = df.join(q, by)  # one row per group on the right
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col(value).cast("double")
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_low"), F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.count_if((v < lo) | (v > hi)).cast("bigint").alias("outliers"))


def quantiles_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles per column (long form)."""
    parts, found = [], quantiles(df, cols, probs)
    for c in cols:
        edges = [F.lit(x).cast("double") for x in found[c]]
        parts.append(one_row(df).select(F.lit(c).alias("column"),
                                        *[e.alias(f"p{int(round(p * 100)):02d}") for p, e in zip(probs, edges)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max — exact quartiles via
    ``quantiles``, one pass for all columns."""
    parts, found = [], quantiles(df, cols, [0.25, 0.5, 0.75])
    for c in cols:
        x = F.col(c).cast("double")
        q25, q50, q75 = (F.lit(v).cast("double") for v in found[c])
        parts.append(df.agg(
            F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        ).select("column", "count", "mean", "std", "min", q25.alias("p25"), q50.alias("p50"),
                 q75.alias("p75"), "max"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_values(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """NULLs per column in one pass, reshaped long; plus a TOTAL row."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).cast("bigint").alias(c) for c in cols])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "missing")
    if only_positive:
        long = long.where(F.col("missing") > 0)
    total = wide.select(F.lit("TOTAL").alias("column"),
                        sum((F.col(f"`{c}`") for c in cols), F.lit(0)).cast("bigint").alias("missing"))
    return long.unionByName(total)


def completeness(df: DataFrame) -> DataFrame:
    """Percent of non-NULL cells."""
    cols = df.columns
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cols), F.lit(0))
    cells = F.count(F.lit(1)) * len(cols)
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.lit(len(cols)).cast("bigint").alias("columns"),
                  F.round(F.try_divide((cells - nulls) * 100.0, cells), 4).alias("completeness_pct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows."""
    rows = df.select(F.count(F.lit(1))).scalar()
    distinct = df.distinct().select(F.count(F.lit(1))).scalar()
    return one_row(df).select(rows.cast("bigint").alias("rows"), (rows - distinct).cast("bigint").alias("duplicates"))


def column_types(df: DataFrame) -> DataFrame:
    """Type and non-null count per column (types from the schema)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).cast("bigint").alias(c) for c in df.columns])
    stack = counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "non_null")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    tcol = None
    for name, t in types.items():
        cond = F.col("column") == name
        tcol = F.when(cond, F.lit(t)) if tcol is None else tcol.when(cond, F.lit(t))
    return stack.withColumn("type", tcol)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], right-closed, every bin listed."""
    x = F.col(col).cast("double")
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    width = (hi - lo) / bins
    idx = F.least(F.greatest(F.ceil((x - lo) / width) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = one_row(df).select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (all_bins.join(counts, "bin", "left")
                    .select("bin", F.round(lo + F.col("bin") * width, 6).alias("lower"),
                            F.round(lo + (F.col("bin") + 1) * width, 6).alias("upper"),
                            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def correlations(df: DataFrame, cols: Sequence[str], nd: int = 6, most: int = 8) -> DataFrame:
    """Pearson correlation of every pair of columns, long form; rows where
    either is null don't count for a pair.  Up to ``most`` columns it is one
    aggregation of ``corr`` calls; more would be too many for generated code and
    take the sums of a Gram matrix instead (``gram.correlations``)."""
    if len(cols) > most:
        return gram.correlations(df, cols, nd)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [F.col(f"`{a}|{b}`") for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("col_a"), F.split("pair", r"\|")[1].alias("col_b"),
                       F.round("corr", nd).alias("corr"))


def high_value_share(df: DataFrame, col: str = "Segment", pattern: str = "(?i)diamond|vip") -> DataFrame:
    """Percent of rows whose label matches the pattern."""
    return df.agg(F.round(F.avg(F.col(col).rlike(pattern).cast("double")) * 100.0, 4).alias("high_value_pct"))


def revenue_concentration(df: DataFrame, amount: str = "Monetary", customer: str = "customer_id",
                          top_pcts: Sequence[float] = (1.0, 5.0, 10.0, 20.0)) -> DataFrame:
    """Share of revenue held by the top x % of customers (ranked by spend)."""
    ranked = with_sequential_id(df.select(customer, amount), [F.desc(amount), F.asc(customer)], name="_rank")
    n = df.select(F.count(F.lit(1))).scalar()
    total = df.select(F.sum(F.col(amount).cast("double"))).scalar()
    aggs = []
    for p in top_pcts:
        k = F.ceil(n * p / 100.0)
        aggs.append(F.sum(F.when(F.col("_rank") <= k, F.col(amount).cast("double"))).alias(f"s{p}"))
    wide = ranked.agg(*aggs)
    parts = [wide.select(F.lit(float(p)).alias("top_pct"), F.ceil(n * p / 100.0).cast("bigint").alias("customers"),
                         F.round(F.coalesce(F.col(f"`s{p}`"), F.lit(0.0)) / total, 6).alias("revenue_share"))
             for p in top_pcts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def monthly_kpis(df: DataFrame, date: str = "date", txn: str = "transaction_id",
                 customer: str = "customer_id") -> DataFrame:
    """A31 + P40: monthly transactions and unique customers with month-over-month change."""
    m = df.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(
        F.countDistinct(txn).cast("bigint").alias("transactions"),
        F.countDistinct(customer).cast("bigint").alias("customers"))
    w = Window.orderBy("month")  # one row per month: bounded
    return m.select("month", "transactions", "customers",
                    (F.col("transactions") - F.lag("transactions").over(w)).cast("bigint").alias("transactions_change"),
                    (F.col("customers") - F.lag("customers").over(w)).cast("bigint").alias("customers_change"))


def source_comparison(df: DataFrame) -> DataFrame:
    """Rows, customers and amount per source."""
    return df.groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                    F.countDistinct("customer_id").cast("bigint").alias("customers"),
                                    F.sum("total_amount").cast("decimal(18,2)").alias("amount"))


def segment_profile(df: DataFrame, segment: str = "Segment") -> DataFrame:
    """Customers, mean R/F/M and revenue share per segment."""
    total = df.select(F.sum(F.col("Monetary").cast("double"))).scalar()
    return df.groupBy(segment).agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.round(F.avg("Recency"), 2).alias("Recency"), F.round(F.avg("Frequency"), 2).alias("Frequency"),
        F.round(F.avg("Monetary"), 2).alias("Monetary"),
        F.round(F.sum(F.col("Monetary").cast("double")) / total, 6).alias("revenue_share"))


def to_long(df: DataFrame, ids: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``) over every non-id column."""
    vals = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), vals, name, value)


def avg_tie_rank(col: str, ascending: bool = True) -> Column:
    """Average rank among ties over a (small, aggregated) table."""
    order = F.col(col).asc() if ascending else F.col(col).desc()
    w = Window.orderBy(order)
    peers = Window.partitionBy(F.col(col))
    return F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0


def tier_names(means: DataFrame, cluster: str = "Cluster",
               names: Sequence[str] = ("Diamond", "Standard")) -> DataFrame:
    """M09 (W01 + T04 + J13): rank clusters by R (desc), F, M (asc), sum the
    ranks into a score; the highest score gets the first name, and so on;
    clusters beyond the list are 'Tier n'.  ``means`` has one row per cluster."""
    scored = means.withColumn("Score", avg_tie_rank("Recency", ascending=False)
                              + avg_tie_rank("Frequency") + avg_tie_rank("Monetary"))
    ordered = scored.withColumn("_pos", F.row_number().over(Window.orderBy(F.desc("Score"), F.asc(cluster))))
    arr = F.array(*[F.lit(n) for n in names])
    name = F.when(F.col("_pos") <= len(names), F.element_at(arr, F.col("_pos").cast("int"))) \
            .otherwise(F.concat(F.lit("Tier "), F.col("_pos").cast("string")))
    return ordered.withColumn("Segment", name).drop("_pos")


def mode_per_group(df: DataFrame, by: str, col: str) -> DataFrame:
    """Most frequent value per group; ties -> smallest value."""
    counts = df.groupBy(by, col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(by).agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(f"modal_{col}"))


def argmax_row(df: DataFrame, key: str, value: str) -> DataFrame:
    """The row with the largest value (ties -> smallest key), as an aggregate."""
    return df.agg(F.min_by(F.struct(F.col(key), F.col(value)), F.struct(-F.col(value), F.col(key)))
                  .alias("_b")).select(F.col(f"_b.{key}").alias(key), F.col(f"_b.{value}").alias(value))


def skewness_table(df: DataFrame, cols: Sequence[str], nd: int = 6) -> DataFrame:
    """Bias-corrected sample skewness per column."""
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        n = F.count(x).cast("double")
        parts.append(df.agg(F.lit(c).alias("column"),
                            F.round(F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2), nd).alias("skewness")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ID_ALIASES = ("customer_id", "customerid", "id", "cust_id")


def resolve_id_column(df: DataFrame, aliases: Sequence[str] = ID_ALIASES) -> str:
    """The id column of an id list, by known aliases (case-insensitive)."""
    lower = {c.lower(): c for c in df.columns}
    for a in aliases:
        if a in lower:
            return lower[a]
    raise ValueError(f"no id column among {list(aliases)} in {df.columns}")


def enrich_ids(ids: DataFrame, master: DataFrame, master_key: str = "customer_id") -> DataFrame:
    """Master rows of the listed ids (semi join: an id listed twice
    does not duplicate rows; the join strategy is chosen by measured size)."""
    key = resolve_id_column(ids)
    wanted = ids.select(F.col(key).cast("string").alias(master_key)).distinct()
    return master.join(wanted, master_key, "left_semi")


def filter_ids(df: DataFrame, ids: Sequence[str], col: str = "customer_id") -> DataFrame:
    """Filtered scan (pushed to the parquet reader when ``df`` is a scan)."""
    return df.where(F.col(col).isin(list(ids)))


def segment_groups(labeled: DataFrame, label: str = "Segment", guest_id: str = "0") -> DataFrame:
    """Guest vs. per-label id groups (write with partitionBy)."""
    return labeled.select("customer_id", F.when(F.col("customer_id") == guest_id, F.lit("Guest"))
                          .otherwise(F.col(label)).alias("segment_group"))


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """First n rows in an explicit total order (repeatable)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def source_profile(sources: dict[str, DataFrame]) -> DataFrame:
    """Row and column count per source, one count per source."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(
        F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_values(df: DataFrame, selections: dict[str, Sequence]) -> DataFrame:
    """AND of IN-filters (empty selection = no filter on that column)."""
    for c, vals in selections.items():
        if vals:
            df = df.where(F.col(c).isin(list(vals)))
    return df


def split_valid(df: DataFrame, numeric: Sequence[str], date_col: str | None = None,
                fmt: str = "yyyy-MM-dd") -> tuple[DataFrame, DataFrame]:
    """Coerce; rows failing any coercion go to the rejected frame, as they came."""
    ok = F.lit(True)
    if date_col:
        ok = ok & F.try_to_timestamp(F.col(date_col), F.lit(fmt)).isNotNull()
    for c in numeric:
        ok = ok & F.col(c).cast("string").try_cast("double").isNotNull()
    valid = df.where(ok).withColumns({c: F.col(c).cast("string").try_cast("double") for c in numeric})
    if date_col:
        valid = valid.withColumn(date_col, F.try_to_timestamp(F.col(date_col), F.lit(fmt)))
    return valid, df.where(~ok)


def coerce_report(df: DataFrame, date_col: str, fmt: str, numeric: Sequence[str]) -> DataFrame:
    """Counts of valid and rejected rows and why, in one pass."""
    d = F.try_to_timestamp(F.col(date_col), F.lit(fmt))
    bad_num = F.lit(False)
    for c in numeric:
        bad_num = bad_num | F.col(c).cast("string").try_cast("double").isNull()
    return df.agg(F.count_if(d.isNotNull() & ~bad_num).cast("bigint").alias("valid_rows"),
                  F.count_if(d.isNull()).cast("bigint").alias("bad_dates"),
                  F.count_if(bad_num).cast("bigint").alias("bad_amounts"),
                  F.count_if(d.isNull() | bad_num).cast("bigint").alias("rejected_rows"))


def validation_rules(df: DataFrame, min_date: str, max_date: str) -> DataFrame:
    """Rule counters (date range, non-negative amount, required fields, returns)."""
    d = F.col("date")
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if((d < F.lit(min_date).cast("date")) | (d > F.lit(max_date).cast("date"))).cast("bigint")
         .alias("date_out_of_range"),
        F.count_if(F.col("total_amount") < 0).cast("bigint").alias("negative_amount"),
        F.count_if(F.col("transaction_id").isNull() | F.col("customer_id").isNull() | d.isNull()).cast("bigint")
         .alias("missing_required"),
        F.count_if(F.col("quantity") < 0).cast("bigint").alias("returns"))


def dedup_across_sources(df: DataFrame, key: Sequence[str], keep: Sequence[str], ranks: dict[str, int],
                         source: str = "source", time: str = "timestamp",
                         tiebreak: str = "transaction_id") -> DataFrame:
    """One row per business key, the earliest (then the best-ranked source,
    then the smallest id) — an aggregate, so a hot key is combined map-side
    instead of being sorted in one window partition."""
    rank = None
    for name, r in ranks.items():
        cond = F.col(source) == name
        rank = F.when(cond, F.lit(r)) if rank is None else rank.when(cond, F.lit(r))
    rank = rank.otherwise(F.lit(len(ranks)))
    best = F.min_by(F.struct(*[F.col(c) for c in keep]), F.struct(F.col(time), rank, F.col(tiebreak))).alias("_b")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_b.{c}").alias(c) for c in keep])


def qq_points(df: DataFrame, col: str, nd: int = 6) -> DataFrame:
    """Ordered values against normal quantiles at Filliben positions, with
    the least-squares line (slope, intercept, r) as constant columns.  Ranks come
    from the values' counts (``keys.expanded_ranks``), so a value that half of
    the rows hold is ranked by many tasks."""
    from ..functions.exprs import filliben_position, norm_ppf

    vals = df.select(F.col(col).cast("double").alias("ordered")).where(F.col("ordered").isNotNull())
    ranked = expanded_ranks(vals, "ordered", name="i")
    n = ranked.select(F.count(F.lit(1))).scalar()
    pts = ranked.select("i", norm_ppf(filliben_position("i", n)).alias("theoretical"), "ordered")
    slope = pts.select(F.regr_slope("ordered", "theoretical")).scalar()
    intercept = pts.select(F.regr_intercept("ordered", "theoretical")).scalar()
    r = pts.select(F.corr("ordered", "theoretical")).scalar()
    return pts.select("i", F.round("theoretical", nd).alias("theoretical"), "ordered",
                      F.round(slope, nd).alias("fit_slope"), F.round(intercept, nd).alias("fit_intercept"),
                      F.round(r, nd).alias("fit_r"))


def enrich_by_file(ids: DataFrame, master: DataFrame, file_col: str = "source_file",
                   master_key: str = "customer_id") -> DataFrame:
    """Master rows for every id file in ONE join (an id listed in several
    files yields one row per file); write with ``partitionBy(file_col)`` to get
    one ``full_info_<name>`` folder per file."""
    key = resolve_id_column(ids)
    wanted = ids.select(F.col(key).cast("string").alias(master_key), file_col).distinct()
    return master.join(wanted, master_key, "inner")
