"""Reusable column expressions built only from ``pyspark.sql.functions``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MISSING_MARKERS", "COLUMN_MAPPING", "CRITICAL_COLUMNS", "VALID_GENDERS",
    "SEGMENT_RULES", "as_col", "null_if_marker", "first_digit_run", "hash_int",
    "hash_pick", "hash_range", "shift_old_years", "segment_of", "edge_score",
    "rank_ntile", "days_between", "id_before_dot", "title_gender", "gender_code",
    "yeo_johnson", "box_cox", "norm_ppf", "filliben_position",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the source pipeline's for identical results.
# ---------------------------------------------------------------------------
# Strings treated as "missing" in every landed column (the integer -9 arrives
# as the string '-9' in an all-string raw layer).
MISSING_MARKERS = (
    "-9", "NULL", "null", "NA", "N/A", "", " ", "?", "nan", "NaN",
    "none", "None", "NAN", "Null", "missing", "Missing", "undefined",
)

# Landed header -> canonical column name; afterwards every name is lower-cased.
COLUMN_MAPPING = {
    "Transaction ID": "transaction_id",
    "Date": "date",
    "Customer ID": "customer_id",
    "Gender": "gender",
    "Age": "age",
    "Product Category": "category",
    "Quantity": "quantity",
    "Price per Unit": "unit_price",
    "Total Amount": "total_amount",
    "InvoiceNo": "transaction_id",
    "StockCode": "sku_code",
    "Description": "product_name",
    "InvoiceDate": "date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

# Rows missing any of these (those present) are dropped during cleaning.
CRITICAL_COLUMNS = ("quantity", "unit_price", "date")

VALID_GENDERS = ("Male", "Female")

# RFM score cascade: first rule whose three minimums all hold wins.
# (segment, min R score, min F score, min M score)
SEGMENT_RULES = (
    ("Champions", 4, 4, 4),
    ("Loyal Customers", 3, 3, 3),
    ("Potential Loyalists", 3, 1, 2),
    ("Promising", 2, 2, 2),
    ("Needs Attention", 2, 1, 1),
    ("At Risk", 1, 2, 2),
    ("Lost", 1, 1, 1),
)
SEGMENT_FALLBACK = "Others"
# ---------------------------------------------------------------------------


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_marker(c: str | Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    c = as_col(c)
    return F.when(c.isin(list(markers)), F.lit(None)).otherwise(c)


def first_digit_run(c: str | Column) -> Column:
    """First run of digits as BIGINT; none -> 0 (``CUST001`` -> 1)."""
    digits = F.regexp_extract(as_col(c).cast("string"), r"(\d+)", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def id_before_dot(c: str | Column) -> Column:
    """Null -> '0'; text before the first '.' (``17850.0`` -> ``17850``)."""
    return F.substring_index(F.coalesce(as_col(c).cast("string"), F.lit("0")), ".", 1)


def hash_int(c: str | Column, salt: str = "") -> Column:
    """Stable non-negative 32-bit integer from the md5 of the value.

    Deterministic across runs, engines and executors (unlike ``rand``), so a
    recomputed partition yields the same values after an executor loss.
    """
    text = F.concat(F.lit(salt), as_col(c).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_pick(c: str | Column, choices: Sequence[str], salt: str = "") -> Column:
    arr = F.array(*[F.lit(v) for v in choices])
    return F.element_at(arr, (hash_int(c, salt) % len(choices) + 1).cast("int"))


def hash_range(c: str | Column, lo: int, hi: int, salt: str = "") -> Column:
    """Integer in [lo, hi] chosen by hash of ``c``."""
    return (hash_int(c, salt) % (hi - lo + 1) + lo).cast("int")


def shift_old_years(d: str | Column, before_year: int = 2015, years: int = 13) -> Column:
    """Move dates older than ``before_year`` forward; 29 Feb clamps to 28 Feb."""
    d = as_col(d)
    return F.when(F.year(d) < before_year, F.add_months(d, 12 * years)).otherwise(d)


def segment_of(r: str | Column, f: str | Column, m: str | Column,
               rules=SEGMENT_RULES, fallback: str = SEGMENT_FALLBACK) -> Column:
    r, f, m = as_col(r), as_col(f), as_col(m)
    out = None
    for name, rmin, fmin, mmin in rules:
        cond = (r >= rmin) & (f >= fmin) & (m >= mmin)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(fallback))


def edge_score(v: str | Column, edges: Sequence[Column], reverse: bool = False) -> Column:
    """Bin index 1..len(edges)+1 for right-closed bins over sorted interior edges.

    A value lands in the lowest bin whose upper edge is >= value, which stays
    defined when edges tie (where a strict quantile cut would fail).
    """
    v = as_col(v)
    score = F.lit(1)
    for e in edges:
        score = score + F.when(e < v, 1).otherwise(0)
    n = len(edges) + 1
    return (F.lit(n + 1) - score).cast("int") if reverse else score.cast("int")


def rank_ntile(rn: str | Column, n: str | Column, q: int) -> Column:
    """Quantile cut of 1-based ranks ``rn`` out of ``n`` into ``q`` labels.

    Equals cutting rank-with-ties-by-arrival at interpolated edges; differs
    from ``ntile`` (which balances bucket sizes instead).
    """
    rn, n = as_col(rn), as_col(n)
    raw = F.ceil((rn - 1) * F.lit(q) / (n - 1))
    return F.when(n <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), raw)).cast("int")


def days_between(ref: str | Column, ts: str | Column) -> Column:
    """Whole days from ``ts`` to ``ref`` (floor), for timestamps or dates.

    Computed on wall-clock (NTZ) values, so no session time zone or DST
    shift enters the difference."""
    ref, ts = as_col(ref).cast("timestamp_ntz"), as_col(ts).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", ts, ref)
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def title_gender(c: str | Column, valid: Sequence[str] = VALID_GENDERS, other: str = "Unknown") -> Column:
    t = F.initcap(as_col(c))
    return F.when(t.isin(list(valid)), t).otherwise(F.lit(other))


def gender_code(c: str | Column) -> Column:
    """Male -> 1, Female -> 0, anything else -> -1."""
    c = as_col(c)
    return F.when(c == "Male", 1).when(c == "Female", 0).otherwise(-1).cast("int")


def yeo_johnson(x: str | Column, lam: float) -> Column:
    """Yeo-Johnson power transform for a fixed lambda."""
    x = as_col(x).cast("double")
    eps = 1e-12
    if abs(lam) < eps:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, lam) - 1.0) / lam
    if abs(lam - 2.0) < eps:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def box_cox(x: str | Column, lam: float) -> Column:
    """Box-Cox transform (input must be > 0) for a fixed lambda."""
    x = as_col(x).cast("double")
    if abs(lam) < 1e-12:
        return F.log(x)
    return (F.pow(x, lam) - 1.0) / lam


# Fixed coefficients of Acklam's rational approximation to the inverse normal CDF
# (relative error below 1.2e-9).
_ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
             1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
             6.680131188771972e+01, -1.328068155288572e+01)
_ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
             3.754408661907416e+00)
_P_LOW = 0.02425


def _horner(coefs, x: Column) -> Column:
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def norm_ppf(p: str | Column) -> Column:
    """Inverse standard-normal CDF as a column expression (0 < p < 1)."""
    p = as_col(p).cast("double")
    q_lo = F.sqrt(-2.0 * F.log(p))
    lower = _horner(_ACKLAM_C, q_lo) / (_horner(_ACKLAM_D, q_lo) * q_lo + 1.0)
    q_hi = F.sqrt(-2.0 * F.log(1.0 - p))
    upper = -_horner(_ACKLAM_C, q_hi) / (_horner(_ACKLAM_D, q_hi) * q_hi + 1.0)
    q = p - 0.5
    r = q * q
    central = _horner(_ACKLAM_A, r) * q / (_horner(_ACKLAM_B, r) * r + 1.0)
    return F.when(p < _P_LOW, lower).when(p > 1.0 - _P_LOW, upper).otherwise(central)


def filliben_position(i: str | Column, n: str | Column) -> Column:
    """Uniform order-statistic medians (Filliben) for 1-based rank i of n."""
    i, n = as_col(i).cast("double"), as_col(n).cast("double")
    last = F.pow(F.lit(0.5), 1.0 / n)
    return F.when(i == n, last).when(i == 1, 1.0 - last).otherwise((i - 0.3175) / (n + 0.365))
