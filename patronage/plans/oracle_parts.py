"""DuckDB SQL building blocks for the oracles (written independently of the
Spark operators; they only share fixed value lists and fixture texts)."""

from __future__ import annotations

from ..functions.exprs import MISSING_MARKERS
from ..sources import fixtures as X

MARKERS_SQL = ", ".join("'" + m.replace("'", "''") + "'" for m in MISSING_MARKERS)


def nul(c: str) -> str:
    return f"CASE WHEN {c} IN ({MARKERS_SQL}) THEN NULL ELSE {c} END"


def title(c: str) -> str:
    return f"(upper(substr({c}, 1, 1)) || lower(substr({c}, 2)))"


def gender_rule(c: str) -> str:
    return f"CASE WHEN {title(c)} IN ('Male', 'Female') THEN {title(c)} ELSE 'Unknown' END"


# Per-source cleaned frames (oracle versions), as SQL texts -----------------
def clean_retail_sql(raw_sql: str) -> str:
    return f"""
WITH raw AS ({raw_sql}),
t AS (SELECT {nul('transaction_id')} AS transaction_id,
             try_strptime({nul('date')}, '%Y-%m-%d') AS date,
             {nul('customer_id')} AS customer_id, {nul('gender')} AS gender,
             TRY_CAST({nul('age')} AS DOUBLE) AS age, {nul('category')} AS category,
             TRY_CAST({nul('quantity')} AS DOUBLE) AS quantity,
             TRY_CAST({nul('unit_price')} AS DOUBLE) AS unit_price,
             TRY_CAST({nul('total_amount')} AS DOUBLE) AS total_amount FROM raw),
k AS (SELECT * FROM t WHERE quantity IS NOT NULL AND unit_price IS NOT NULL AND date IS NOT NULL),
f AS (SELECT transaction_id, date, coalesce(customer_id, '0') AS customer_id, gender,
             coalesce(age, (SELECT median(age) FROM k)) AS age, coalesce(category, 'Unknown') AS category,
             quantity, abs(unit_price) AS unit_price,
             coalesce(total_amount, (SELECT median(total_amount) FROM k)) AS total_amount FROM k),
g AS (SELECT transaction_id, date, customer_id, {gender_rule('gender')} AS gender,
             CASE WHEN age < 10 OR age > 100 THEN (SELECT median(age) FROM f) ELSE age END AS age,
             category, quantity, unit_price, total_amount FROM f)
SELECT DISTINCT * FROM g
"""


CLEAN_RETAIL_SQL = clean_retail_sql(X.RAW_RETAIL_SQL)


def clean_online_sql(raw_sql: str, date_fmt: str) -> str:
    return f"""
WITH raw AS ({raw_sql}),
t AS (SELECT {nul('InvoiceNo')} AS transaction_id, {nul('StockCode')} AS sku_code,
             {nul('Description')} AS product_name, TRY_CAST({nul('Quantity')} AS DOUBLE) AS quantity,
             try_strptime({nul('InvoiceDate')}, '{date_fmt}') AS date,
             TRY_CAST({nul('UnitPrice')} AS DOUBLE) AS unit_price,
             {nul('CustomerID')} AS customer_id, {nul('Country')} AS country FROM raw),
k AS (SELECT * FROM t WHERE quantity IS NOT NULL AND unit_price IS NOT NULL AND date IS NOT NULL)
SELECT DISTINCT transaction_id, sku_code, coalesce(product_name, 'Unknown') AS product_name, quantity, date,
       abs(unit_price) AS unit_price, coalesce(customer_id, '0') AS customer_id,
       coalesce(country, 'Unknown') AS country
FROM k
"""


CLEAN_ONLINE_SQL = clean_online_sql(X.RAW_ONLINE_SQL, "%m/%d/%Y %H:%M")
CLEAN_ORDERS_SQL = clean_online_sql(X.RAW_ORDERS_SQL, "%m-%d-%Y %H:%M")


def H(salt: str, c: str) -> str:
    """DuckDB spelling of the md5-bucket hash."""
    return f"(('0x' || substr(md5('{salt}' || CAST({c} AS VARCHAR)), 1, 8))::BIGINT)"


def pick(salt: str, c: str, choices) -> str:
    arr = "[" + ", ".join("'" + x + "'" for x in choices) + "]"
    return f"{arr}[{H(salt, c)} % {len(choices)} + 1]"


DIGITS = r"coalesce(TRY_CAST(regexp_extract({c}, '(\d+)', 1) AS BIGINT), 0)"


def demo_fill(gender: str | None, age: str | None, cid: str = "customer_id") -> str:
    g = pick("gender:", cid, ("Male", "Female"))
    a = f"CAST({H('age:', cid)} % 58 + 18 AS DOUBLE)"
    gs = (f"CASE WHEN {gender} IS NULL OR {gender} = 'Unknown' THEN {g} ELSE {gender} END"
          if gender else g)
    ags = f"CASE WHEN coalesce({age}, 0) = 0 THEN {a} ELSE {age} END" if age else a
    return f"{gs} AS gender, {ags} AS age"


def keyword_case(c: str) -> str:
    from ..operators.transform import CANDIDATE_LABELS, DEFAULT_KEYWORDS
    parts = []
    for label in CANDIDATE_LABELS:
        words = DEFAULT_KEYWORDS.get(label)
        if words:
            parts.append(f"WHEN regexp_matches(lower({c}), '\\b(" + "|".join(words) + f")\\b') THEN '{label}'")
    return f"CASE WHEN {c} IS NULL THEN 'Other' " + " ".join(parts) + " ELSE 'Other' END"


TRANSFORMED_SQL = f"""
WITH cr AS ({CLEAN_RETAIL_SQL}),
co AS ({CLEAN_ONLINE_SQL}),
cd AS ({CLEAN_ORDERS_SQL}),
rt0 AS (SELECT transaction_id, date, {DIGITS.format(c='customer_id')} AS customer_id, gender, age,
               category, quantity, unit_price FROM cr),
rt AS (SELECT transaction_id, date, customer_id, {demo_fill('gender', 'age')}, category, quantity, unit_price,
              CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS sku_code, 'Kaggle' AS source FROM rt0),
off1 AS (SELECT coalesce(max(TRY_CAST(transaction_id AS BIGINT)), 0) + 1000 AS o FROM rt),
ot0 AS (SELECT CASE WHEN TRY_CAST(transaction_id AS BIGINT) IS NOT NULL
                    THEN CAST(TRY_CAST(transaction_id AS BIGINT) + (SELECT o FROM off1) AS VARCHAR)
                    ELSE transaction_id END AS transaction_id,
               date, {DIGITS.format(c='customer_id')} AS customer_id, product_name, quantity, unit_price,
               country, sku_code FROM co),
ot AS (SELECT transaction_id, date, customer_id, {demo_fill(None, None)}, {keyword_case('product_name')} AS category,
              quantity, unit_price, country, sku_code, 'UCI' AS source FROM ot0),
off2 AS (SELECT coalesce(max(TRY_CAST(transaction_id AS BIGINT)), (SELECT o - 1000 FROM off1)) + 1000 AS o FROM ot),
dt0 AS (SELECT CASE WHEN TRY_CAST(transaction_id AS BIGINT) IS NOT NULL
                    THEN CAST(TRY_CAST(transaction_id AS BIGINT) + (SELECT o FROM off2) AS VARCHAR)
                    ELSE transaction_id END AS transaction_id,
               date, {DIGITS.format(c='customer_id')} AS customer_id, product_name, quantity, unit_price, country FROM cd),
dt AS (SELECT transaction_id, date, customer_id, {demo_fill(None, None)}, {keyword_case('product_name')} AS category,
              quantity, unit_price, country, CAST(NULL AS VARCHAR) AS sku_code, 'ORD' AS source FROM dt0)
SELECT * FROM rt UNION ALL SELECT * FROM ot UNION ALL SELECT * FROM dt
"""


def merged_sql(countries, keep_source: bool = False) -> str:
    ctry = pick("country:", "customer_id", countries)
    return f"""
WITH u AS ({TRANSFORMED_SQL}),
n AS (SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(date AS DATE) AS date, date AS timestamp,
             split_part(coalesce(CAST(customer_id AS VARCHAR), '0'), '.', 1) AS customer_id,
             gender, age, country, category, quantity, unit_price,
             CASE source WHEN 'Kaggle' THEN 0 WHEN 'UCI' THEN 1 WHEN 'ORD' THEN 2 ELSE 3 END AS r, source FROM u),
p AS (SELECT customer_id,
             arg_min(gender, (r, transaction_id, date)) FILTER (WHERE gender IS NOT NULL) AS g,
             arg_min(age, (r, transaction_id, date)) FILTER (WHERE age IS NOT NULL) AS a,
             arg_min(country, (r, transaction_id, date)) FILTER (WHERE country IS NOT NULL AND country <> 'Unknown') AS c
      FROM n GROUP BY customer_id),
pf AS (SELECT customer_id,
              CASE WHEN a IS NULL OR a = 0 THEN CAST({H('age:', 'customer_id')} % 63 + 18 AS DOUBLE) ELSE a END AS age,
              coalesce(g, {pick('gender:', 'customer_id', ('Male', 'Female'))}) AS gender,
              CASE WHEN c IS NULL OR c = 'Unknown' THEN {ctry} ELSE c END AS country FROM p)
SELECT n.transaction_id, n.date, n.customer_id, CAST(round(pf.age) AS INT) AS age, pf.gender, pf.country,
       n.category, CAST(coalesce(n.quantity, 0) AS INT) AS quantity,
       CAST(coalesce(n.unit_price, 0) AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(coalesce(n.quantity, 0) AS INT) * CAST(coalesce(n.unit_price, 0) AS DECIMAL(10,2)) AS DECIMAL(15,2)) AS total_amount
       {", n.source, n.timestamp" if keep_source else ""}
FROM n LEFT JOIN pf ON n.customer_id = pf.customer_id
"""


# --- warehouse (DuckDB) -------------------------------------------------------
FACT_ORDER_SQL = "transaction_id, date, customer_id, category, quantity, unit_price, total_amount"
FIRST_ORDER_SQL = "(transaction_id, date, category, quantity, unit_price)"


def warehouse_ctes(src: str = "s", p: str = "") -> dict[str, str]:
    """CTEs ``{p}dd, {p}dc, {p}dl, {p}cu, {p}fs`` over the lines table ``src``."""
    return {
        f"{p}dd": f"""SELECT CAST(row_number() OVER (ORDER BY date) AS INT) AS date_id, date,
            CAST(strftime(date, '%Y%m%d') AS INT) AS date_key, CAST(day(date) AS INT) AS day,
            CAST(month(date) AS INT) AS month, monthname(date) AS month_name, CAST(quarter(date) AS INT) AS quarter,
            CAST(year(date) AS INT) AS year,
            isodow(date) >= 6 AS is_weekend
            FROM (SELECT DISTINCT CAST(date AS DATE) AS date FROM {src} WHERE date IS NOT NULL) x""",
        f"{p}dc": f"""SELECT CAST(row_number() OVER (ORDER BY category) AS INT) AS category_id, category
            FROM (SELECT DISTINCT category FROM {src} WHERE category IS NOT NULL) x""",
        f"{p}dl": f"""SELECT CAST(row_number() OVER (ORDER BY country) AS INT) AS location_id, country
            FROM (SELECT DISTINCT country FROM {src} WHERE country IS NOT NULL) x""",
        f"{p}cf": f"""SELECT customer_id, arg_min(gender, {FIRST_ORDER_SQL}) AS gender,
            arg_min(age, {FIRST_ORDER_SQL}) AS age, arg_min(country, {FIRST_ORDER_SQL}) AS country
            FROM {src} GROUP BY customer_id""",
        f"{p}cu": f"""SELECT CAST(row_number() OVER (ORDER BY customer_id) AS INT) AS customer_key, customer_id,
            gender, CAST(age AS INT) AS age, CAST(l.location_id AS INT) AS location_id
            FROM {p}cf LEFT JOIN {p}dl l USING (country)""",
        f"{p}fs": f"""SELECT CAST(row_number() OVER (ORDER BY x.transaction_id, x.date, x.customer_id, x.category,
                x.quantity, x.unit_price, x.total_amount) AS BIGINT) AS sales_id,
            x.transaction_id, d.date_id, c.customer_key, g.category_id, CAST(x.quantity AS INT) AS quantity,
            CAST(x.unit_price AS DECIMAL(10,2)) AS unit_price, CAST(x.total_amount AS DECIMAL(15,2)) AS total_amount
            FROM {src} x LEFT JOIN {p}cu c ON x.customer_id = c.customer_id
            LEFT JOIN {p}dc g ON x.category = g.category
            LEFT JOIN {p}dd d ON CAST(x.date AS DATE) = d.date""",
    }


def wh_sql(body: str, extra: dict[str, str] | None = None) -> str:
    parts = {"s": X.SALES_SQL, **warehouse_ctes()}
    parts.update(extra or {})
    inner = ",\n".join(f"{k} AS ({v.strip()})" for k, v in parts.items())
    return f"WITH {inner}\n{body}"


def norm_ppf_sql(p: str) -> str:
    """DuckDB spelling of the inverse normal CDF approximation."""
    from ..functions.exprs import _ACKLAM_A, _ACKLAM_B, _ACKLAM_C, _ACKLAM_D, _P_LOW

    def horner(cs, x):
        out = repr(cs[0])
        for c in cs[1:]:
            out = f"({out} * {x} + {c!r})"
        return out
    ql, qh = f"sqrt(-2.0 * ln({p}))", f"sqrt(-2.0 * ln(1.0 - {p}))"
    lower = f"{horner(_ACKLAM_C, ql)} / ({horner(_ACKLAM_D, ql)} * {ql} + 1.0)"
    upper = f"-{horner(_ACKLAM_C, qh)} / ({horner(_ACKLAM_D, qh)} * {qh} + 1.0)"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    central = f"{horner(_ACKLAM_A, r)} * {q} / ({horner(_ACKLAM_B, r)} * {r} + 1.0)"
    return f"CASE WHEN {p} < {_P_LOW} THEN {lower} WHEN {p} > 1.0 - {_P_LOW} THEN {upper} ELSE {central} END"
