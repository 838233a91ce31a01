"""Per-source cleaning with a row-level audit.

Order of work for one source (all lazy, one plan):

1. standardise names (rename map, then lower-case),
2. missing markers -> NULL in every column,
3. coerce numbers (``try_cast``) and parse dates with the source's formats —
   done *before* the critical-column drop so a non-numeric quantity is
   dropped rather than surviving as NULL,
4. drop rows missing a critical column,
5. fills: customer id -> '0' (guest), descriptive text -> 'Unknown',
   ``age`` / ``total_amount`` -> median of the kept rows,
6. rules: negative price -> absolute value, negative quantity counted as a
   return (kept), age outside [10, 100] -> median of the filled column,
   gender title-cased, anything but Male/Female -> 'Unknown',
7. full-row de-duplication.

``flag_source`` keeps boolean rule columns so that ``cleaning_audit`` counts
every rule in a single aggregation pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (
    COLUMN_MAPPING, CRITICAL_COLUMNS, MISSING_MARKERS, null_if_marker, title_gender,
)
from ..session import materialize
from .keys import ordered
from .stats import quantiles

NUMERIC_COLUMNS = ("quantity", "unit_price", "total_amount", "age")
TEXT_FILL_COLUMNS = ("description", "product_name", "category", "country")
MEDIAN_FILL_COLUMNS = ("age", "total_amount")
AGE_RANGE = (10, 100)


@dataclass(frozen=True)
class SourceSpec:
    """One landed source: how to read it and how to parse its dates."""

    name: str                       # lineage label written to ``source``
    date_formats: tuple[str, ...]   # Spark datetime patterns, tried in order
    rank: int = 0                   # order of the sources, and tie-break between them
    kind: str = "auto"              # retail (own categories) | online | orders (product names); auto: by columns
    path: str | None = None
    fmt: str = "csv"                # csv | json | parquet
    options: dict = field(default_factory=dict)


def standardize_columns(df: DataFrame, mapping: dict[str, str] = COLUMN_MAPPING) -> DataFrame:
    """Rename landed headers to canonical names, then lower-case all."""
    return df.select([F.col(f"`{c}`").alias(mapping.get(c, c).lower()) for c in df.columns])


def normalize_missing(df: DataFrame, markers: Sequence[str] = MISSING_MARKERS,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Every marker string becomes NULL (string columns only)."""
    cols = set(columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])
    return df.select([null_if_marker(c, markers).alias(c) if c in cols else F.col(c) for c in df.columns])


def parse_date(c: str, formats: Sequence[str]):
    """First format that parses wins; unparsable -> NULL."""
    parsed = [F.try_to_timestamp(F.col(c), F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def coerce_types(df: DataFrame, date_formats: Sequence[str]) -> DataFrame:
    """P07 + P08: numbers via ``try_cast``; dates via the source's formats."""
    out = df
    for c in NUMERIC_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("string").try_cast("double"))
    if "date" in df.columns:
        out = out.withColumn("date", parse_date("date", date_formats))
    return out


def flag_source(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Steps 1-3 plus boolean flags ``_missing_raw`` / ``_invalid`` / ``_keep``."""
    std = normalize_missing(standardize_columns(raw))
    crit = [c for c in CRITICAL_COLUMNS if c in std.columns]
    missing_raw = F.lit(False)
    for c in crit:
        missing_raw = missing_raw | F.col(c).isNull()
    typed = coerce_types(std.withColumn("_missing_raw", missing_raw), spec.date_formats)
    null_after = F.lit(False)
    for c in crit:
        null_after = null_after | F.col(c).isNull()
    return (typed.withColumn("_invalid", null_after & ~F.col("_missing_raw"))
                 .withColumn("_keep", ~null_after))


def _fill_and_fix(kept: DataFrame) -> DataFrame:
    """Steps 5-6 on kept rows; adds ``_imputed`` / ``_corrected`` counters.

    Counters are materialised as columns *before* the values they test are
    replaced (a later ``withColumn`` would otherwise see the filled column).
    """
    fills = [c for c in ("customer_id", *TEXT_FILL_COLUMNS, *MEDIAN_FILL_COLUMNS) if c in kept.columns]
    out = kept.withColumn("_imputed", sum((F.col(c).isNull().cast("int") for c in fills), F.lit(0)))
    if "customer_id" in out.columns:
        out = out.withColumn("customer_id", F.coalesce(F.col("customer_id").cast("string"), F.lit("0")))
    for c in TEXT_FILL_COLUMNS:
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit("Unknown")))
    lo, hi = AGE_RANGE
    numeric = [c for c in MEDIAN_FILL_COLUMNS if c in kept.columns]
    medians = {c: v[0] for c, v in quantiles(kept, numeric, [0.5]).items()} if numeric else {}
    for c, median in medians.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(median).cast("double")))
    corrected = F.lit(0)
    if "unit_price" in out.columns:
        corrected = corrected + F.coalesce((F.col("unit_price") < 0).cast("int"), F.lit(0))
    if "age" in out.columns:
        corrected = corrected + F.coalesce(((F.col("age") < lo) | (F.col("age") > hi)).cast("int"), F.lit(0))
    out = out.withColumn("_corrected", corrected)
    if "unit_price" in out.columns:
        out = out.withColumn("unit_price", F.abs("unit_price"))
    if "quantity" in out.columns:
        out = out.withColumn("_return", F.col("quantity") < 0)
    if "age" in out.columns:
        bad_age = (F.col("age") < lo) | (F.col("age") > hi)
        # filling with the median leaves the median where it was
        out = out.withColumn("age", F.when(bad_age, F.lit(medians["age"]).cast("double")).otherwise(F.col("age")))
    if "gender" in out.columns:
        out = out.withColumn("gender", title_gender("gender"))
    return out


def forward_fill(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """The last known value along a global order: a window inside each range
    partition, and before its first known value the one that the partitions
    before it end with (a row per partition)."""
    staged = ordered(df, order)
    inside = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    last = staged.where(F.col(col).isNotNull()).groupBy("_pid").agg(F.max_by(col, "_pos").alias("_end"))
    parts = staged.select("_pid").distinct().join(last, "_pid", "left")
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_pid", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    filled = staged.withColumn("_in", F.last(col, ignorenulls=True).over(inside)).join(
        F.broadcast(carried), "_pid")
    return filled.withColumn(col, F.coalesce("_in", "_carry")).select(*df.columns)


def impute(df: DataFrame, col: str, strategy: str, order: Sequence[str] = ()) -> DataFrame:
    """Fill nulls of a column: ``mean``, ``median``, ``mode`` (ties to the smallest
    value) or ``ffill`` along ``order``."""
    if strategy == "ffill":
        if not order:
            raise ValueError("a forward fill needs an order")
        return forward_fill(df, col, order)
    if strategy == "mean":
        value = df.agg(F.avg(col)).first()[0]
    elif strategy == "median":
        value = quantiles(df, [col], [0.5])[col][0]
    elif strategy == "mode":
        top = df.where(F.col(col).isNotNull()).groupBy(col).count().orderBy(F.desc("count"), col).first()
        value = top[0] if top else None
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df if value is None else df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


AUDIT_COLUMNS = ("_missing_raw", "_invalid", "_keep", "_imputed", "_corrected", "_return")


def clean_source(raw: DataFrame, spec: SourceSpec, stage: bool = True) -> DataFrame:
    """The whole clean chain for one landed source.

    With ``stage`` the typed, kept rows are written once as a stage table, so
    the dataset-wide medians and the final pass read it instead of
    re-running the scan and parse of the landed data.
    """
    flagged = flag_source(raw, spec)
    kept = flagged.filter("_keep").drop("_missing_raw", "_invalid", "_keep")
    # stage only when dataset-wide medians make several passes over the rows
    if stage and any(c in kept.columns for c in MEDIAN_FILL_COLUMNS):
        kept = materialize(kept, f"kept-{spec.name}")
    fixed = _fill_and_fix(kept)
    return fixed.drop(*[c for c in AUDIT_COLUMNS if c in fixed.columns]).dropDuplicates()


def cleaning_audit(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row of counters per source.  The flagged rows are staged, so the
    landed data is read once; the counters are one aggregation over them, one
    over the fixed rows and one over the rows without duplicates."""
    flagged = materialize(flag_source(raw, spec), f"flagged-{spec.name}")
    kept = flagged.filter("_keep").drop("_missing_raw", "_invalid", "_keep")
    fixed = _fill_and_fix(kept)
    cleaned_cols = [c for c in fixed.columns if c not in AUDIT_COLUMNS]
    ret = F.count_if(F.col("_return")) if "_return" in fixed.columns else F.lit(0)
    # a group per distinct cleaned row: its size, and what its rows were marked with
    groups = fixed.groupBy(*cleaned_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_imputed").alias("_i"), F.sum("_corrected").alias("_c"),
        ret.alias("_r"))
    done = groups.agg(F.count(F.lit(1)).alias("rows_out"), *[
        F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (
            ("_n", "kept"), ("_i", "imputed"), ("_c", "corrected"), ("_r", "returns"))]).first()
    return flagged.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_in"),
        F.count_if(F.col("_missing_raw")).cast("bigint").alias("rows_removed_missing"),
        F.count_if(F.col("_invalid")).cast("bigint").alias("rows_dropped_invalid"),
    ).select(
        F.lit(spec.name).alias("source"), "rows_in", "rows_removed_missing", "rows_dropped_invalid",
        *[F.lit(v).cast("bigint").alias(n) for n, v in (
            ("values_imputed", done["imputed"]), ("values_corrected", done["corrected"]),
            ("returns_kept", done["returns"]), ("duplicates_removed", done["kept"] - done["rows_out"]),
            ("rows_out", done["rows_out"]))],
    )
