"""Checked queries: one per operator of the inventory (ids in the key).

Importing this module fills ``registry.QUERIES`` / ``registry.ORACLE``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rfm as R
from ..sources import fixtures as X
from .registry import ctes, query

SALES = X.SALES_SQL
# DuckDB spelling of the year realignment (+13 years, 29 Feb clamps).
SHIFTED_SALES = f"""
SELECT transaction_id, customer_id, age, gender, country, category, quantity, unit_price, total_amount,
       CASE WHEN year(date) < 2015 THEN CAST(date + INTERVAL 13 YEAR AS DATE) ELSE date END AS date
FROM ({SALES}) s WHERE total_amount > 0
"""


# --- A01 + P28 + P29: flagship -------------------------------------------------
def flagship(spark, sf_dir):
    s = R.realign_years(R.positive_sales(X.sales(spark, sf_dir)))
    return R.rfm(s)


query("a01_rfm", ctes("""
SELECT customer_id,
       CAST((SELECT max(date) FROM p) + 1 - max(date) AS BIGINT) AS Recency,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS Frequency,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS Monetary
FROM p GROUP BY customer_id
""", p=SHIFTED_SALES))(flagship)


# --- Cleaning: P01-P15 -----------------------------------------------------------
from ..operators import cleaning as C  # noqa: E402
from ..sources import registry as SRC  # noqa: E402
from . import oracle_parts as O  # noqa: E402


@query("p01_standardise_columns", X.ALL_RETAIL_SQL)
def p01(spark, sf_dir):
    return C.standardize_columns(X.raw_retail(spark, sf_dir, every_line=True))


@query("p02_missing_markers", f"""
SELECT {O.nul('InvoiceNo')} AS transaction_id, {O.nul('StockCode')} AS sku_code,
       {O.nul('Description')} AS product_name, {O.nul('Quantity')} AS quantity,
       {O.nul('InvoiceDate')} AS date, {O.nul('UnitPrice')} AS unit_price,
       {O.nul('CustomerID')} AS customer_id, {O.nul('Country')} AS country
FROM ({X.ALL_ONLINE_SQL}) r
""")
def p02(spark, sf_dir):
    return C.normalize_missing(C.standardize_columns(X.raw_online(spark, sf_dir, every_line=True)))


@query("p15_clean_retail", O.clean_retail_sql(X.ALL_RETAIL_SQL))
def p15_retail(spark, sf_dir):
    return C.clean_source(X.raw_retail(spark, sf_dir, every_line=True), SRC.RETAIL)


@query("p15_clean_online", O.clean_online_sql(X.ALL_ONLINE_SQL, "%m/%d/%Y %H:%M"))
def p15_online(spark, sf_dir):
    return C.clean_source(X.raw_online(spark, sf_dir, every_line=True), SRC.ONLINE)


@query("p15_clean_orders", O.clean_online_sql(X.ALL_ORDERS_SQL, "%m-%d-%Y %H:%M"))
def p15_orders(spark, sf_dir):
    return C.clean_source(X.raw_orders(spark, sf_dir, every_line=True), SRC.ORDERS)


# --- Transform and merge: P16-P27, M24, U01, J01, J02, A04 -----------------------
from ..operators import merge as MG  # noqa: E402
from ..operators import transform as TR  # noqa: E402


def transformed_frames(spark, sf_dir):
    from ..session import materialize
    src = SRC.fixture_sources(spark, sf_dir)
    # cleaned sources are stage tables (read by the offsets and by the merge)
    cleaned = [(spec, materialize(C.clean_source(df, spec), f"clean-{name}")) for name, (spec, df) in src.items()]
    return TR.transform_sources(cleaned)


def merged_sales(spark, sf_dir):
    return MG.merge_sources(transformed_frames(spark, sf_dir))


@query("p20_transform_sources", O.TRANSFORMED_SQL)
def p20(spark, sf_dir):
    return MG.union_sources(transformed_frames(spark, sf_dir))


@query("m24_categorise_products", f"""
SELECT p_partkey, p_name, {O.keyword_case('p_name')} AS category FROM part
""")
def m24(spark, sf_dir):
    from ..sources.tables import read_table
    return TR.categorize(read_table(spark, sf_dir, "part").select("p_partkey", "p_name"), name="p_name")


@query("u01_merge_sources", O.merged_sql(MG.DEFAULT_COUNTRIES))
def u01(spark, sf_dir):
    return merged_sales(spark, sf_dir)


# --- Warehouse: P36, W02-W04, J03-J09, J15, S08, R01 -----------------------------
from ..operators import increment as INC  # noqa: E402
from ..operators import warehouse as WH  # noqa: E402


def warehouse(spark, sf_dir):
    return WH.build_warehouse(X.sales(spark, sf_dir))


@query("w02_dim_date", O.wh_sql("SELECT * FROM dd"))
def w02_date(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_date


@query("w02_dim_category", O.wh_sql("SELECT * FROM dc"))
def w02_category(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_category


@query("j03_dim_location", O.wh_sql("SELECT * FROM dl"))
def j03_location(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_location


@query("w04_dim_customer", O.wh_sql("SELECT * FROM cu"))
def w04_customer(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_customer


@query("w03_fact_sales", O.wh_sql("SELECT * FROM fs"))
def w03_fact(spark, sf_dir):
    return warehouse(spark, sf_dir).fact_sales


@query("j15_fk_checks", O.wh_sql("""
SELECT 'dim_customer.location_id' AS foreign_key, CAST(count(*) AS BIGINT) AS orphans FROM cu
  WHERE location_id IS NOT NULL AND location_id NOT IN (SELECT location_id FROM dl)
UNION ALL SELECT 'fact_sales.date_id', CAST(count(*) AS BIGINT) FROM fs WHERE date_id IS NULL OR date_id NOT IN (SELECT date_id FROM dd)
UNION ALL SELECT 'fact_sales.customer_key', CAST(count(*) AS BIGINT) FROM fs WHERE customer_key IS NULL OR customer_key NOT IN (SELECT customer_key FROM cu)
UNION ALL SELECT 'fact_sales.category_id', CAST(count(*) AS BIGINT) FROM fs WHERE category_id IS NULL OR category_id NOT IN (SELECT category_id FROM dc)
"""))
def j15(spark, sf_dir):
    return WH.referential_checks(warehouse(spark, sf_dir))


# Every positive line with its customer, day and category, from the keys alone.
STAR_RFM_SQL = """
SELECT customer_id, transaction_id, total_amount, date, age, gender, category
FROM fs JOIN cu USING (customer_key) JOIN dd USING (date_id) JOIN dc USING (category_id)
WHERE total_amount > 0
"""


@query("j07_star_join_rfm", O.wh_sql(STAR_RFM_SQL))
def j07(spark, sf_dir):
    return WH.star_join_rfm(warehouse(spark, sf_dir))


# What a star join gives back are the lines that the star was built from, so its
# oracle reads those lines and no star table.
@query("j08_star_join_dates", ctes("""
SELECT customer_id, CAST(date AS DATE) AS date, transaction_id, amount AS total_amount
FROM (SELECT *, CAST(total_amount AS DECIMAL(15,2)) AS amount FROM s) WHERE amount > 0
""", s=SALES))
def j08(spark, sf_dir):
    return WH.star_join_dates(warehouse(spark, sf_dir))


@query("j09_star_join_categories", ctes("""
SELECT CAST(date AS DATE) AS transaction_date, category, transaction_id, customer_id
FROM s WHERE category IS NOT NULL AND CAST(total_amount AS DECIMAL(15,2)) > 0
""", s=SALES))
def j09(spark, sf_dir):
    return WH.star_join_categories(warehouse(spark, sf_dir))


@query("s08_sql_source", O.wh_sql("""
SELECT category, year, quarter, CAST(count(*) AS BIGINT) AS lines, CAST(sum(quantity) AS BIGINT) AS units,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS revenue, CAST(count(DISTINCT customer_key) AS BIGINT) AS buyers
FROM fs JOIN dd USING (date_id) JOIN dc USING (category_id) GROUP BY ALL
"""))
def s08(spark, sf_dir):
    """SQL text against the registered warehouse tables (quarterly sales by category)."""
    warehouse(spark, sf_dir).register()
    return spark.sql("""
        WITH dated AS (SELECT f.*, d.year, d.quarter FROM fact_sales f JOIN dim_date d ON d.date_id = f.date_id)
        SELECT g.category, s.year, s.quarter, count(*) AS lines, sum(s.quantity) AS units,
               CAST(sum(s.total_amount) AS DECIMAL(18,2)) AS revenue, count(DISTINCT s.customer_key) AS buyers
        FROM dated s JOIN dim_category g ON g.category_id = s.category_id
        GROUP BY g.category, s.year, s.quarter""")


INITIAL_CUTOFF = "1998-01-01"


@query("r01_incremental_load", O.wh_sql(f"""
SELECT * FROM ofs
UNION ALL
SELECT CAST((SELECT max(sales_id) FROM ofs) + row_number() OVER (ORDER BY n.transaction_id, n.date,
         n.customer_id, n.category, n.quantity, n.unit_price, n.total_amount) AS BIGINT),
       n.transaction_id, d.date_id, c.customer_key, g.category_id, CAST(n.quantity AS INT),
       CAST(n.unit_price AS DECIMAL(10,2)), CAST(n.total_amount AS DECIMAL(15,2))
FROM (SELECT * FROM s WHERE ({O.FACT_ORDER_SQL}) NOT IN (SELECT ({O.FACT_ORDER_SQL}) FROM o)) n
LEFT JOIN ncu c ON n.customer_id = c.customer_id LEFT JOIN ndc g ON n.category = g.category
LEFT JOIN ndd d ON n.date = d.date
""", extra={
    "o": f"SELECT * FROM s WHERE date < DATE '{INITIAL_CUTOFF}'",
    **O.warehouse_ctes("o", "o"),
    "ndd": """SELECT date_id, date FROM odd UNION ALL
              SELECT CAST((SELECT max(date_id) FROM odd) + row_number() OVER (ORDER BY date) AS INT), date
              FROM (SELECT DISTINCT date FROM s WHERE date NOT IN (SELECT date FROM odd)) x""",
    "ndc": """SELECT category_id, category FROM odc UNION ALL
              SELECT CAST((SELECT max(category_id) FROM odc) + row_number() OVER (ORDER BY category) AS INT), category
              FROM (SELECT DISTINCT category FROM s WHERE category NOT IN (SELECT category FROM odc)) x""",
    "ndl": """SELECT location_id, country FROM odl UNION ALL
              SELECT CAST((SELECT max(location_id) FROM odl) + row_number() OVER (ORDER BY country) AS INT), country
              FROM (SELECT DISTINCT country FROM s WHERE country NOT IN (SELECT country FROM odl)) x""",
    "ncf": f"""SELECT customer_id, arg_min(gender, {O.FIRST_ORDER_SQL}) AS gender,
              arg_min(age, {O.FIRST_ORDER_SQL}) AS age, arg_min(country, {O.FIRST_ORDER_SQL}) AS country
              FROM s WHERE customer_id NOT IN (SELECT customer_id FROM ocu) GROUP BY customer_id""",
    "ncu": """SELECT customer_key, customer_id FROM ocu UNION ALL
              SELECT CAST((SELECT max(customer_key) FROM ocu) + row_number() OVER (ORDER BY customer_id) AS INT), customer_id
              FROM ncf""",
}))
def r01(spark, sf_dir):
    lines = materialize(X.sales(spark, sf_dir), "sales-lines")  # both loads read it
    old = WH.build_warehouse(lines.where(F.col("date") < F.lit(INITIAL_CUTOFF).cast("date")), staged=True)
    return INC.incremental_load(old, lines, staged=True).fact_sales


# --- RFM features: A02, A03, W05-W07, P38, P39, M01-M05, S14 ---------------------
from ..operators import features as FE  # noqa: E402

RFM_SQL = ctes("""
SELECT customer_id,
       CAST((SELECT max(date) FROM p) + 1 - max(date) AS BIGINT) AS Recency,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS Frequency,
       CAST(sum(total_amount) AS DOUBLE) AS Monetary
FROM p GROUP BY customer_id
""", p=SHIFTED_SALES)

GUEST_SQL = """
SELECT user_id,
       CAST(floor((epoch_us((SELECT max(ts) FROM pu)) - epoch_us(max(ts))) / 86400000000.0) AS BIGINT) AS Recency,
       CAST(count(*) AS BIGINT) AS Frequency, sum(value) AS Monetary
FROM pu GROUP BY user_id
"""


def rfm_customers(spark, sf_dir):
    """Registered-customer RFM with Monetary as double (feature input); the
    per-customer aggregate is a stage table, so the reports and features
    built on it make their passes over that, not over the lines."""
    return flagship(spark, sf_dir).withColumn("Monetary", F.col("Monetary").cast("double"))


def guest_base(spark, sf_dir):
    return R.rfm_by_rows(X.purchases(spark, sf_dir), customer="user_id", date="ts", amount="value")


def _round(df, cols, nd=6):
    return df.select(*[F.round(c, nd).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("a02_guest_rfm", ctes("SELECT user_id, Recency, Frequency, round(Monetary, 6) AS Monetary FROM g",
                             pu=X.PURCHASES_SQL, g=GUEST_SQL))
def a02(spark, sf_dir):
    """A02 + S14: upload flow with caller-named id / date / amount columns."""
    return _round(guest_base(spark, sf_dir), ["Monetary"])


def _edge_sql(col: str, arr: str, q: int, reverse: bool) -> str:
    terms = " + ".join(f"CAST({arr}[{i}] < {col} AS INT)" for i in range(1, q))
    return f"({q + 1} - (1 + {terms}))" if reverse else f"(1 + {terms})"


def _segment_sql() -> str:
    from ..functions.exprs import SEGMENT_FALLBACK, SEGMENT_RULES
    whens = " ".join(f"WHEN R_Score >= {r} AND F_Score >= {f} AND M_Score >= {m} THEN '{n}'"
                     for n, r, f, m in SEGMENT_RULES)
    return f"CASE {whens} ELSE '{SEGMENT_FALLBACK}' END"


def scores_sql(q: int) -> str:
    probs = "[" + ", ".join(str(i / q) for i in range(1, q)) + "]"
    return ctes(f"""
SELECT user_id, Recency, Frequency, round(Monetary, 6) AS Monetary, R_Score, F_Score, M_Score,
       CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score,
       {_segment_sql()} AS Segment
FROM (SELECT g.*, CAST({_edge_sql('Recency', 'qr', q, True)} AS INT) AS R_Score,
             CAST({_edge_sql('Frequency', 'qf', q, False)} AS INT) AS F_Score,
             CAST({_edge_sql('Monetary', 'qm', q, False)} AS INT) AS M_Score
      FROM g, (SELECT quantile_cont(CAST(Recency AS DOUBLE), {probs}) AS qr,
                      quantile_cont(CAST(Frequency AS DOUBLE), {probs}) AS qf,
                      quantile_cont(Monetary, {probs}) AS qm FROM g) qq) s
""", pu=X.PURCHASES_SQL, g=GUEST_SQL)


@query("w05_quintile_scores", scores_sql(5))
def w05(spark, sf_dir):
    """W05 + P38 + P39: quintile scores (R reversed), code and segment."""
    return _round(R.segment_scores(R.score_columns(guest_base(spark, sf_dir), q=5)), ["Monetary"])


@query("w07_quartile_scores", scores_sql(4))
def w07(spark, sf_dir):
    return _round(R.segment_scores(R.score_columns(guest_base(spark, sf_dir), q=4)), ["Monetary"])


def _rank_sql(col: str, q: int, reverse: bool) -> str:
    rn = f"row_number() OVER (ORDER BY {col}, user_id)"
    s = f"CASE WHEN n <= 1 THEN 1 ELSE greatest(1, CAST(ceil(({rn} - 1) * {q} / (n - 1)) AS INT)) END"
    return f"CAST({q + 1} - ({s}) AS INT)" if reverse else f"CAST({s} AS INT)"


@query("w06_rank_ntiles", ctes(f"""
SELECT user_id, Recency, Frequency, round(Monetary, 6) AS Monetary,
       {_rank_sql('Recency', 5, True)} AS R_Score, {_rank_sql('Frequency', 5, False)} AS F_Score,
       {_rank_sql('Monetary', 5, False)} AS M_Score
FROM g, (SELECT count(*) AS n FROM g) c
""", pu=X.PURCHASES_SQL, g=GUEST_SQL))
def w06(spark, sf_dir):
    """Rank-first n-tiles (ties by arrival = user id), all labels used."""
    out = R.score_columns(guest_base(spark, sf_dir), q=5, method="rank", order=("user_id",))
    return _round(out, ["Monetary"])


@query("a03_category_share", ctes("""
SELECT customer_id, category, round(CAST(s AS DOUBLE) / CAST(t AS DOUBLE), 6) AS share
FROM (SELECT customer_id, category, sum(total_amount) AS s FROM p GROUP BY customer_id, category) a
JOIN (SELECT customer_id, sum(total_amount) AS t FROM p GROUP BY customer_id) b USING (customer_id)
""", p=SHIFTED_SALES))
def a03(spark, sf_dir):
    s = R.realign_years(R.positive_sales(X.sales(spark, sf_dir)))
    return R.category_shares_long(s)


def _outlier_sql(src: str, c: str, lo: float, hi: float, k: float) -> str:
    return (f"SELECT * FROM {src} WHERE {c} >= (SELECT quantile_cont({c}, {lo}) - {k} * "
            f"(quantile_cont({c}, {hi}) - quantile_cont({c}, {lo})) FROM {src}) AND {c} <= "
            f"(SELECT quantile_cont({c}, {hi}) + {k} * (quantile_cont({c}, {hi}) - quantile_cont({c}, {lo})) FROM {src})")


@query("m01_outlier_removal", ctes("SELECT customer_id, Recency, Frequency, round(Monetary, 6) AS Monetary FROM o3",
                                   rf=f"({RFM_SQL})",
                                   o1=_outlier_sql("rf", "Recency", 0.05, 0.95, 1.5),
                                   o2=_outlier_sql("o1", "Frequency", 0.05, 0.95, 1.5),
                                   o3=_outlier_sql("o2", "Monetary", 0.05, 0.95, 1.5)))
def m01(spark, sf_dir):
    return _round(FE.remove_outliers(rfm_customers(spark, sf_dir)), ["Monetary"])


def _flag_sql(c: str) -> str:
    return (f"({c} < (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM rf) "
            f"OR {c} > (SELECT quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM rf))"
            f" AS {c}_outlier")


@query("m02_outlier_flags", ctes(f"""
SELECT customer_id, Recency, Frequency, round(Monetary, 6) AS Monetary,
       {_flag_sql('Recency')}, {_flag_sql('Frequency')}, {_flag_sql('Monetary')} FROM rf
""", rf=f"({RFM_SQL})"))
def m02(spark, sf_dir):
    return _round(FE.outlier_flags(rfm_customers(spark, sf_dir)), ["Monetary"])


def _scaled_sql(expr: str, name: str, src: str) -> str:
    return (f"round(CASE WHEN (SELECT stddev_pop({expr}) FROM {src}) > 0 THEN ({expr} - (SELECT avg({expr}) FROM {src})) "
            f"/ (SELECT stddev_pop({expr}) FROM {src}) ELSE 0 END, 6) AS {name}")


@query("m05_standard_scale", ctes(f"""
SELECT customer_id, {_scaled_sql('Recency', 'R_scaled', 'rf')}, {_scaled_sql('Frequency', 'F_scaled', 'rf')},
       {_scaled_sql('Monetary', 'M_scaled', 'rf')} FROM rf
""", rf=f"({RFM_SQL})"))
def m05(spark, sf_dir):
    out = FE.standard_scale(rfm_customers(spark, sf_dir), names=["R_scaled", "F_scaled", "M_scaled"])
    return _round(out.select("customer_id", "R_scaled", "F_scaled", "M_scaled"), ["R_scaled", "F_scaled", "M_scaled"])


YJ_LAMBDAS = (0.7, -0.6, 0.1)
BC_LAMBDAS = (0.3, -0.8, 0.05)


def _yj_sql(c: str, lam: float) -> str:
    pos = f"ln(1 + {c})" if abs(lam) < 1e-12 else f"(power({c} + 1, {lam}) - 1) / {lam}"
    neg = f"-ln(1 - {c})" if abs(lam - 2) < 1e-12 else f"-(power(1 - {c}, {2 - lam}) - 1) / {2 - lam}"
    return f"CASE WHEN {c} >= 0 THEN {pos} ELSE {neg} END"


def _bc_sql(c: str, lam: float) -> str:
    return f"ln({c} + 1)" if abs(lam) < 1e-12 else f"(power({c} + 1, {lam}) - 1) / {lam}"


def _power_query_sql(fn, lams) -> str:
    cols = ("Recency", "Frequency", "Monetary")
    t = ", ".join(f"{fn(f'CAST({c} AS DOUBLE)', lam)} AS {c}_t" for c, lam in zip(cols, lams))
    sc = ", ".join(_scaled_sql(f"{c}_t", f"{c}_t", "tt") for c in cols)
    return ctes(f"SELECT customer_id, {sc} FROM tt", rf=f"({RFM_SQL})",
                tt=f"SELECT customer_id, {t} FROM rf")


@query("m03_yeo_johnson_fixed", _power_query_sql(_yj_sql, YJ_LAMBDAS))
def m03(spark, sf_dir):
    out = FE.power_transform_fixed(rfm_customers(spark, sf_dir), FE.RFM_COLUMNS, YJ_LAMBDAS)
    cols = [f"{c}_t" for c in FE.RFM_COLUMNS]
    return _round(out.select("customer_id", *cols), cols)


@query("m04_box_cox_fixed", _power_query_sql(_bc_sql, BC_LAMBDAS))
def m04(spark, sf_dir):
    out = FE.power_transform_fixed(rfm_customers(spark, sf_dir), FE.RFM_COLUMNS, BC_LAMBDAS, method="box-cox")
    cols = [f"{c}_t" for c in FE.RFM_COLUMNS]
    return _round(out.select("customer_id", *cols), cols)


@query("m03_power_transform_fit")
def m03_fit(spark, sf_dir):
    """M03 fit (rows-only): lambdas by maximum likelihood, then transformed
    features of the outlier-free customers."""
    base = FE.remove_outliers(rfm_customers(spark, sf_dir))
    model = FE.PowerTransformer(inputCols=list(FE.RFM_COLUMNS),
                                outputCols=["R_scaled", "F_scaled", "M_scaled"]).fit(base)
    return model.transform(base).select("customer_id", "R_scaled", "F_scaled", "M_scaled")


# --- Reports: A05-A35, J10-J16, T01-T05, W01, W09, M09, M29, S06, S12, S15, S16,
#     P30-P37, U04 -------------------------------------------------------------
from ..functions.exprs import SEGMENT_FALLBACK, SEGMENT_RULES  # noqa: E402
from ..operators import reports as RP  # noqa: E402

SEGMENTS = tuple(r[0] for r in SEGMENT_RULES) + (SEGMENT_FALLBACK,)
TIER_RULE = (10, 700_000.0)  # Frequency >= 10 and Monetary >= 700,000 -> 'Diamond'
KNOWN_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def tier_of(freq="Frequency", money="Monetary"):
    return F.when((F.col(freq) >= TIER_RULE[0]) & (F.col(money) >= TIER_RULE[1]), F.lit("Diamond")) \
            .otherwise(F.lit("Standard"))


def labeled(spark, sf_dir):
    """Registered customers with quintile scores, code, Segment and rule Tier."""
    out = R.segment_scores(R.score_columns(rfm_customers(spark, sf_dir), q=5))
    return out.withColumn("Tier", tier_of())


def transactions(spark, sf_dir):
    return R.realign_years(R.positive_sales(X.sales(spark, sf_dir)))


def labeled_transactions(spark, sf_dir):
    """Transactions with their customer's labels (left join)."""
    lab = labeled(spark, sf_dir).select("customer_id", "Segment", "Tier")
    return transactions(spark, sf_dir).join(lab, "customer_id", "left")


def _q(probs):
    return "[" + ", ".join(str(p) for p in probs) + "]"


LAB_PARTS = {
    "p": SHIFTED_SALES,
    "rf": """SELECT customer_id, CAST((SELECT max(date) FROM p) + 1 - max(date) AS BIGINT) AS Recency,
             CAST(count(DISTINCT transaction_id) AS BIGINT) AS Frequency,
             CAST(sum(total_amount) AS DOUBLE) AS Monetary FROM p GROUP BY customer_id""",
    "qq": f"""SELECT quantile_cont(CAST(Recency AS DOUBLE), {_q([.2, .4, .6, .8])}) AS qr,
              quantile_cont(CAST(Frequency AS DOUBLE), {_q([.2, .4, .6, .8])}) AS qf,
              quantile_cont(Monetary, {_q([.2, .4, .6, .8])}) AS qm FROM rf""",
    "sc": f"""SELECT rf.*, CAST({_edge_sql('Recency', 'qr', 5, True)} AS INT) AS R_Score,
              CAST({_edge_sql('Frequency', 'qf', 5, False)} AS INT) AS F_Score,
              CAST({_edge_sql('Monetary', 'qm', 5, False)} AS INT) AS M_Score FROM rf, qq""",
    "lab": f"""SELECT customer_id, Recency, Frequency, Monetary, R_Score, F_Score, M_Score,
               CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score,
               {_segment_sql()} AS Segment,
               CASE WHEN Frequency >= {TIER_RULE[0]} AND Monetary >= {TIER_RULE[1]} THEN 'Diamond'
                    ELSE 'Standard' END AS Tier FROM sc""",
    "tr": "SELECT p.*, lab.Segment, lab.Tier FROM p LEFT JOIN lab USING (customer_id)",
}


def lab_sql(body: str, **extra: str) -> str:
    return ctes(body, **LAB_PARTS, **extra)


def _fixed_pivot_sql(col: str, values, agg="count") -> str:
    if agg == "count":
        return ", ".join(f'CAST(count(*) FILTER (WHERE {col} = \'{v}\') AS BIGINT) AS "{v}"' for v in values)
    return ", ".join(f'round(count(*) FILTER (WHERE {col} = \'{v}\') * 100.0 / count(*), 4) AS "{v}"'
                     for v in values)


@query("a05_distinct_customers", ctes("""
SELECT CAST(count(DISTINCT customer_id) AS BIGINT) AS customers, CAST(count(*) AS BIGINT) AS lines FROM s
""", s=SALES))
def a05(spark, sf_dir):
    return X.sales(spark, sf_dir).agg(F.countDistinct("customer_id").cast("bigint").alias("customers"),
                                      F.count(F.lit(1)).cast("bigint").alias("lines"))


@query("a06_segment_means", lab_sql("""
SELECT Segment, round(avg(Recency), 2) AS Recency, round(avg(Frequency), 2) AS Frequency,
       round(avg(Monetary), 2) AS Monetary FROM lab GROUP BY Segment"""))
def a06(spark, sf_dir):
    return RP.group_means(labeled(spark, sf_dir), "Segment", ["Recency", "Frequency", "Monetary"])


@query("a07_month_segment_counts", lab_sql(f"""
SELECT strftime(date, '%Y-%m') AS month, {_fixed_pivot_sql('Segment', SEGMENTS)} FROM tr GROUP BY 1"""))
def a07(spark, sf_dir):
    t = labeled_transactions(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))  # P40
    return RP.pivot_counts(t, "month", "Segment", SEGMENTS)


@query("a08_category_segment_pct", lab_sql(f"""
SELECT category, {_fixed_pivot_sql('Segment', SEGMENTS, 'pct')} FROM tr GROUP BY category"""))
def a08(spark, sf_dir):
    return RP.row_normalised(labeled_transactions(spark, sf_dir), "category", "Segment", SEGMENTS)


@query("a09_segment_counts", lab_sql("SELECT Segment, CAST(count(*) AS BIGINT) AS count FROM lab GROUP BY Segment"))
def a09(spark, sf_dir):
    return RP.value_counts(labeled(spark, sf_dir), "Segment")


@query("t05_sorted_transaction_counts", lab_sql("""
SELECT Segment, CAST(count(*) AS BIGINT) AS count FROM tr GROUP BY Segment ORDER BY Segment"""))
def t05(spark, sf_dir):
    return RP.value_counts(labeled_transactions(spark, sf_dir), "Segment").orderBy("Segment")


@query("a10_segment_share", lab_sql("""
SELECT Segment, count, round(count * 100.0 / (SELECT count(*) FROM lab), 4) AS percent,
       Segment = (SELECT arg_min(Segment, (-count, Segment)) FROM c) AS is_top FROM c
""", c="SELECT Segment, CAST(count(*) AS BIGINT) AS count FROM lab GROUP BY Segment"))
def a10(spark, sf_dir):
    return RP.shares(labeled(spark, sf_dir), "Segment")


@query("a11_modal_segment_per_tier", lab_sql("""
SELECT Tier, arg_min(Segment, (-n, Segment)) AS modal_Segment
FROM (SELECT Tier, Segment, count(*) AS n FROM lab GROUP BY Tier, Segment) x GROUP BY Tier"""))
def a11(spark, sf_dir):
    return RP.mode_per_group(labeled(spark, sf_dir), "Tier", "Segment")


TOP3_SQL = "SELECT category, CAST(count(*) AS BIGINT) AS count FROM tr GROUP BY category ORDER BY count DESC, category LIMIT 3"


@query("t02_top3_categories", lab_sql("SELECT * FROM top3", top3=TOP3_SQL))
def t02(spark, sf_dir):
    return RP.top_k(labeled_transactions(spark, sf_dir), "category", 3)


@query("a12_top3_category_segment", lab_sql("""
SELECT category, Segment, CAST(count(*) AS BIGINT) AS count FROM tr
WHERE category IN (SELECT category FROM top3) GROUP BY category, Segment""", top3=TOP3_SQL))
def a12(spark, sf_dir):
    t = RP.in_top_k(labeled_transactions(spark, sf_dir), "category", 3)  # J16
    return t.groupBy("category", "Segment").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


@query("a13_category_segment_matrix", lab_sql(f"""
SELECT category, {_fixed_pivot_sql('Segment', SEGMENTS)} FROM tr GROUP BY category"""))
def a13(spark, sf_dir):
    return RP.pivot_counts(labeled_transactions(spark, sf_dir), "category", "Segment", SEGMENTS)


LIFESPAN_SQL = "SELECT customer_id, CAST(max(date) - min(date) AS BIGINT) AS lifespan_days FROM p GROUP BY customer_id"


@query("a14_customer_lifespan", lab_sql("SELECT * FROM ls", ls=LIFESPAN_SQL))
def a14(spark, sf_dir):
    return RP.lifespan(transactions(spark, sf_dir))


@query("a15_boxplot_lifespan", lab_sql("""
SELECT Segment, q1, median, q3,
       min(lifespan_days) FILTER (WHERE lifespan_days >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(lifespan_days) FILTER (WHERE lifespan_days <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
       CAST(count(*) FILTER (WHERE lifespan_days < q1 - 1.5 * (q3 - q1) OR lifespan_days > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
FROM lsl JOIN (SELECT Segment, quantile_cont(CAST(lifespan_days AS DOUBLE), 0.25) AS q1,
                      quantile_cont(CAST(lifespan_days AS DOUBLE), 0.5) AS median,
                      quantile_cont(CAST(lifespan_days AS DOUBLE), 0.75) AS q3 FROM lsl GROUP BY Segment) q USING (Segment)
GROUP BY Segment, q1, median, q3""", ls=LIFESPAN_SQL,
    lsl="SELECT ls.customer_id, CAST(ls.lifespan_days AS DOUBLE) AS lifespan_days, lab.Segment FROM ls JOIN lab USING (customer_id)"))
def a15(spark, sf_dir):
    ls = RP.lifespan(transactions(spark, sf_dir)).join(labeled(spark, sf_dir).select("customer_id", "Segment"),
                                                      "customer_id")
    return RP.box_stats(ls.withColumn("lifespan_days", F.col("lifespan_days").cast("double")), "Segment",
                        "lifespan_days")


def _qt_sql(cols, probs):
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS {n}"
                                                for p, n in zip(probs, names)) + " FROM rf" for c in cols)


RFM3 = ("Recency", "Frequency", "Monetary")


@query("a16_quantiles_5_95", lab_sql(_qt_sql(RFM3, (0.05, 0.95))))
def a16(spark, sf_dir):
    return RP.quantiles_table(rfm_customers(spark, sf_dir), RFM3, (0.05, 0.95))


@query("a17_medians", lab_sql(_qt_sql(RFM3, (0.5,))))
def a17(spark, sf_dir):
    return RP.quantiles_table(rfm_customers(spark, sf_dir), RFM3, (0.5,))


@query("a18_describe", lab_sql(" UNION ALL ".join(f"""
SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
       quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM rf""" for c in RFM3)))
def a18(spark, sf_dir):
    return _round(RP.describe(rfm_customers(spark, sf_dir), RFM3), ["mean", "std"])


@query("a19_rfm_mean_std", lab_sql("SELECT " + ", ".join(
    f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in RFM3) + " FROM rf"))
def a19(spark, sf_dir):
    rf = rfm_customers(spark, sf_dir)
    return rf.agg(*[x for c in RFM3 for x in (F.round(F.avg(c), 6).alias(f"{c}_mean"),
                                              F.round(F.stddev_samp(c), 6).alias(f"{c}_std"))])


ONLINE_NORM_SQL = f"""
SELECT {O.nul('InvoiceNo')} AS transaction_id, {O.nul('StockCode')} AS sku_code,
       {O.nul('Description')} AS product_name, {O.nul('Quantity')} AS quantity,
       {O.nul('InvoiceDate')} AS date, {O.nul('UnitPrice')} AS unit_price,
       {O.nul('CustomerID')} AS customer_id, {O.nul('Country')} AS country
FROM ({X.ALL_ONLINE_SQL}) r
"""
ONLINE_COLS = ("transaction_id", "sku_code", "product_name", "quantity", "date", "unit_price", "customer_id", "country")


@query("a20_missing_values", ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing FROM o "
    f"HAVING count(*) FILTER (WHERE {c} IS NULL) > 0" for c in ONLINE_COLS)
    + " UNION ALL SELECT 'TOTAL', CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ONLINE_COLS)
    + " AS BIGINT) FROM o", o=ONLINE_NORM_SQL))
def a20(spark, sf_dir):
    return RP.missing_values(p02(spark, sf_dir))


@query("a21_completeness", ctes(
    f"SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(ONLINE_COLS)} AS BIGINT) AS columns, round(("
    f"count(*) * {len(ONLINE_COLS)} - (" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ONLINE_COLS)
    + f")) * 100.0 / (count(*) * {len(ONLINE_COLS)}), 4) AS completeness_pct FROM o", o=ONLINE_NORM_SQL))
def a21(spark, sf_dir):
    return RP.completeness(p02(spark, sf_dir))


@query("a22_duplicate_rows", ctes("""
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r) d) AS BIGINT) AS duplicates FROM r
""", r=X.ALL_RETAIL_SQL))
def a22(spark, sf_dir):
    return RP.duplicate_rows(C.standardize_columns(X.raw_retail(spark, sf_dir, every_line=True)))


@query("a23_column_types", ctes(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS non_null,
       CASE lower(typeof(any_value({c}))) WHEN 'varchar' THEN 'string' WHEN 'integer' THEN 'int'
            ELSE lower(typeof(any_value({c}))) END AS type FROM m""" for c in MG.MERGED_COLUMNS),
    m=O.merged_sql(MG.DEFAULT_COUNTRIES)))
def a23(spark, sf_dir):
    return RP.column_types(merged_sales(spark, sf_dir))


@query("a24_histogram_monetary", lab_sql("""
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 6) AS lower, round(lo + (b.bin + 1) * w, 6) AS upper,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT unnest(range(0, 20)) AS bin) b
LEFT JOIN (SELECT CAST(least(greatest(ceil((Monetary - lo) / w) - 1, 0), 19) AS INT) AS bin, count(*) AS n
           FROM rf, mm GROUP BY 1) c ON b.bin = c.bin, mm
""", mm="SELECT min(Monetary) AS lo, (max(Monetary) - min(Monetary)) / 20 AS w FROM rf"))
def a24(spark, sf_dir):
    return RP.histogram(rfm_customers(spark, sf_dir), "Monetary", 20)


@query("a25_skewness", lab_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column, round(skewness(CAST({c} AS DOUBLE)), 6) AS skewness FROM rf" for c in RFM3)))
def a25(spark, sf_dir):
    return RP.skewness_table(rfm_customers(spark, sf_dir), RFM3)


@query("a26_correlation", lab_sql(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM rf"
    for i, a in enumerate(RFM3) for b in RFM3[i:])))
def a26(spark, sf_dir):
    return RP.correlations(rfm_customers(spark, sf_dir), RFM3)


@query("a27_date_range", ctes("SELECT max(date) AS max_date, min(date) AS min_date FROM s", s=SALES))
def a27(spark, sf_dir):
    return X.sales(spark, sf_dir).agg(F.max("date").alias("max_date"), F.min("date").alias("min_date"))


@query("a28_high_value_share", lab_sql("""
SELECT round(avg(CAST(regexp_matches(Tier, '(?i)diamond|vip') AS DOUBLE)) * 100.0, 4) AS high_value_pct FROM lab"""))
def a28(spark, sf_dir):
    return RP.high_value_share(labeled(spark, sf_dir), "Tier")


@query("a29_rows_removed", ctes("""
SELECT CAST((SELECT count(*) FROM rf) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after,
       CAST((SELECT count(*) FROM rf) - count(*) AS BIGINT) AS rows_removed FROM o3""",
    rf=f"({RFM_SQL})", o1=_outlier_sql("rf", "Recency", 0.05, 0.95, 1.5),
    o2=_outlier_sql("o1", "Frequency", 0.05, 0.95, 1.5), o3=_outlier_sql("o2", "Monetary", 0.05, 0.95, 1.5)))
def a29(spark, sf_dir):
    rf = rfm_customers(spark, sf_dir)
    before = rf.select(F.count(F.lit(1))).scalar()
    kept = FE.remove_outliers(rf)
    return kept.agg(F.count(F.lit(1)).alias("_after")).select(
        before.cast("bigint").alias("rows_before"), F.col("_after").cast("bigint").alias("rows_after"),
        (before - F.col("_after")).cast("bigint").alias("rows_removed"))


@query("a30_revenue_concentration", lab_sql(" UNION ALL ".join(f"""
SELECT CAST({p} AS DOUBLE) AS top_pct, CAST(ceil(n * {p} / 100.0) AS BIGINT) AS customers,
       round(coalesce(sum(Monetary) FILTER (WHERE rk <= ceil(n * {p} / 100.0)), 0) / sum(Monetary), 6) AS revenue_share
FROM rk, (SELECT count(*) AS n FROM rf) c GROUP BY n""" for p in (1.0, 5.0, 10.0, 20.0)),
    rk="SELECT Monetary, row_number() OVER (ORDER BY Monetary DESC, customer_id) AS rk FROM rf"))
def a30(spark, sf_dir):
    return RP.revenue_concentration(rfm_customers(spark, sf_dir))


@query("a31_monthly_kpis", lab_sql("""
SELECT month, transactions, customers,
       CAST(transactions - lag(transactions) OVER (ORDER BY month) AS BIGINT) AS transactions_change,
       CAST(customers - lag(customers) OVER (ORDER BY month) AS BIGINT) AS customers_change
FROM (SELECT strftime(date, '%Y-%m') AS month, CAST(count(DISTINCT transaction_id) AS BIGINT) AS transactions,
             CAST(count(DISTINCT customer_id) AS BIGINT) AS customers FROM p GROUP BY 1) m"""))
def a31(spark, sf_dir):
    return RP.monthly_kpis(transactions(spark, sf_dir))


@query("a32_source_comparison", ctes("""
SELECT source, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS amount FROM m GROUP BY source""",
    m=O.merged_sql(MG.DEFAULT_COUNTRIES, keep_source=True)))
def a32(spark, sf_dir):
    return RP.source_comparison(MG.merge_sources(transformed_frames(spark, sf_dir), keep_source=True))


PROFILE_SQL = """SELECT Segment, CAST(count(*) AS BIGINT) AS customers, round(avg(Recency), 2) AS Recency,
       round(avg(Frequency), 2) AS Frequency, round(avg(Monetary), 2) AS Monetary,
       round(sum(Monetary) / (SELECT sum(Monetary) FROM lab), 6) AS revenue_share FROM lab GROUP BY Segment"""


@query("a33_segment_profile", lab_sql(PROFILE_SQL))
def a33(spark, sf_dir):
    return RP.segment_profile(labeled(spark, sf_dir))


@query("a34_rfm_code_distribution", lab_sql(
    "SELECT RFM_Score, CAST(count(*) AS BIGINT) AS count FROM lab GROUP BY RFM_Score ORDER BY RFM_Score"))
def a34(spark, sf_dir):
    return RP.value_counts(labeled(spark, sf_dir), "RFM_Score").orderBy("RFM_Score")


@query("a35_segment_profile_long", lab_sql("""
UNPIVOT (SELECT Segment, CAST(customers AS DOUBLE) AS customers, Recency, Frequency, Monetary, revenue_share FROM prof)
ON customers, Recency, Frequency, Monetary, revenue_share INTO NAME metric VALUE value""", prof=PROFILE_SQL))
def a35(spark, sf_dir):
    prof = RP.segment_profile(labeled(spark, sf_dir))
    prof = prof.select("Segment", *[F.col(c).cast("double").alias(c) for c in prof.columns if c != "Segment"])
    return RP.to_long(prof, ["Segment"])


@query("j10_transactions_labels", lab_sql("""
SELECT customer_id, transaction_id, category, date AS transaction_date, Segment, Tier FROM tr"""))
def j10(spark, sf_dir):
    return labeled_transactions(spark, sf_dir).select("customer_id", "transaction_id", "category",
                                                      F.col("date").alias("transaction_date"), "Segment", "Tier")


@query("j11_id_enrichment", lab_sql("""
SELECT s.* FROM ({sales}) s JOIN (SELECT customer_id AS customerid FROM lab WHERE Segment = 'Champions') ids
ON s.customer_id = ids.customerid""".replace("{sales}", SALES)))
def j11(spark, sf_dir):
    ids = labeled(spark, sf_dir).where(F.col("Segment") == "Champions").select(F.col("customer_id").alias("customerid"))
    return RP.enrich_ids(ids, X.sales(spark, sf_dir))


@query("m09_tier_naming", lab_sql("""
SELECT Segment AS Cluster, Recency, Frequency, Monetary, Score,
       CASE WHEN pos <= 3 THEN ['Diamond', 'Platinum', 'Gold'][pos] ELSE 'Tier ' || CAST(pos AS VARCHAR) END AS Segment
FROM (SELECT *, row_number() OVER (ORDER BY Score DESC, Segment) AS pos
      FROM (SELECT *, (rank() OVER (ORDER BY Recency DESC) + (count(*) OVER (PARTITION BY Recency) - 1) / 2.0)
                    + (rank() OVER (ORDER BY Frequency) + (count(*) OVER (PARTITION BY Frequency) - 1) / 2.0)
                    + (rank() OVER (ORDER BY Monetary) + (count(*) OVER (PARTITION BY Monetary) - 1) / 2.0) AS Score
            FROM (SELECT Segment, avg(Recency) AS Recency, avg(Frequency) AS Frequency, avg(Monetary) AS Monetary
                  FROM lab GROUP BY Segment) m) s) t"""))
def m09(spark, sf_dir):
    """M09 + W01 + T04 on rule-based clusters (the segments)."""
    means = labeled(spark, sf_dir).groupBy(F.col("Segment").alias("Cluster")).agg(
        F.avg("Recency").alias("Recency"), F.avg("Frequency").alias("Frequency"), F.avg("Monetary").alias("Monetary"))
    out = RP.tier_names(means, "Cluster", ("Diamond", "Platinum", "Gold"))
    return _round(out, ["Recency", "Frequency", "Monetary"])


@query("w09_top_segment", lab_sql("""
SELECT arg_min(Segment, (-customers, Segment)) AS Segment, max(customers) AS customers FROM prof""",
    prof=PROFILE_SQL))
def w09(spark, sf_dir):
    return RP.argmax_row(RP.segment_profile(labeled(spark, sf_dir)), "Segment", "customers")


@query("m29_segment_scatter", lab_sql("""
SELECT customer_id, Recency, Frequency, round(Monetary, 6) AS Monetary, Segment FROM lab"""))
def m29(spark, sf_dir):
    return _round(labeled(spark, sf_dir).select("customer_id", "Recency", "Frequency", "Monetary", "Segment"),
                  ["Monetary"])


@query("s06_guest_lines", ctes("SELECT * FROM s WHERE customer_id = '0'", s=SALES))
def s06(spark, sf_dir):
    """Filtered scan of the master table for guest (id 0) lines."""
    return RP.filter_ids(X.sales(spark, sf_dir), ["0"])


@query("s12_segment_id_export", lab_sql("""
SELECT customer_id, CASE WHEN customer_id = '0' THEN 'Guest' ELSE Tier END AS segment_group FROM lab"""))
def s12(spark, sf_dir):
    return RP.segment_groups(labeled(spark, sf_dir), "Tier")


@query("s15_preview", ctes(f"SELECT * FROM s ORDER BY {O.FACT_ORDER_SQL}, age, gender, country LIMIT 10",
                           s=SALES))
def s15(spark, sf_dir):
    order = ["transaction_id", "date", "customer_id", "category", "quantity", "unit_price", "total_amount",
             "age", "gender", "country"]
    return RP.preview(X.sales(spark, sf_dir), 10, order)


@query("s16_source_profile", ctes("""
SELECT 'Kaggle' AS source, CAST(count(*) AS BIGINT) AS rows, CAST(9 AS BIGINT) AS columns FROM r
UNION ALL SELECT 'UCI', CAST(count(*) AS BIGINT), CAST(8 AS BIGINT) FROM o
UNION ALL SELECT 'ORD', CAST(count(*) AS BIGINT), CAST(8 AS BIGINT) FROM d""",
    r=X.RAW_RETAIL_SQL, o=X.RAW_ONLINE_SQL, d=X.RAW_ORDERS_SQL))
def s16(spark, sf_dir):
    src = SRC.fixture_sources(spark, sf_dir)
    return RP.source_profile({k: df for k, (_spec, df) in src.items()})


@query("p30_guest_split", lab_sql("""
SELECT customer_id = '0' AS is_guest, CAST(count(*) AS BIGINT) AS customers FROM lab GROUP BY 1"""))
def p30(spark, sf_dir):
    return RP.value_counts(labeled(spark, sf_dir).withColumn("is_guest", F.col("customer_id") == "0"),
                           "is_guest", name="customers")


@query("p32_value_filters", ctes("""
SELECT * FROM s WHERE category IN ('SMALL', 'PROMO') AND gender IN ('Female')""", s=SALES))
def p32(spark, sf_dir):
    return RP.filter_values(X.sales(spark, sf_dir), {"category": ["SMALL", "PROMO"], "gender": ["Female"]})


@query("p34_coerce_reject", ctes("""
SELECT CAST(count(*) FILTER (WHERE d IS NOT NULL AND q IS NOT NULL AND u IS NOT NULL) AS BIGINT) AS valid_rows,
       CAST(count(*) FILTER (WHERE d IS NULL) AS BIGINT) AS bad_dates,
       CAST(count(*) FILTER (WHERE q IS NULL OR u IS NULL) AS BIGINT) AS bad_amounts,
       CAST(count(*) FILTER (WHERE d IS NULL OR q IS NULL OR u IS NULL) AS BIGINT) AS rejected_rows
FROM (SELECT try_strptime(date, '%Y-%m-%d') AS d, TRY_CAST(quantity AS DOUBLE) AS q,
             TRY_CAST(unit_price AS DOUBLE) AS u FROM r) x""", r=X.ALL_RETAIL_SQL))
def p34(spark, sf_dir):
    raw = C.standardize_columns(X.raw_retail(spark, sf_dir, every_line=True))
    return RP.coerce_report(raw, "date", "yyyy-MM-dd", ["quantity", "unit_price"])


@query("p37_validation_rules", ctes("""
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE date < DATE '1990-01-01' OR date > DATE '2030-12-31') AS BIGINT) AS date_out_of_range,
       CAST(count(*) FILTER (WHERE total_amount < 0) AS BIGINT) AS negative_amount,
       CAST(count(*) FILTER (WHERE transaction_id IS NULL OR customer_id IS NULL OR date IS NULL) AS BIGINT) AS missing_required,
       CAST(count(*) FILTER (WHERE quantity < 0) AS BIGINT) AS returns
FROM s""", s=SALES))
def p37(spark, sf_dir):
    return RP.validation_rules(X.sales(spark, sf_dir), "1990-01-01", "2030-12-31")


@query("u04_cross_source_dedup", ctes("""
SELECT customer_id, date, category, quantity, unit_price,
       arg_min(transaction_id, (timestamp, r, transaction_id)) AS transaction_id,
       arg_min(source, (timestamp, r, transaction_id)) AS source, min(timestamp) AS timestamp
FROM (SELECT *, CASE source WHEN 'Kaggle' THEN 0 WHEN 'UCI' THEN 1 WHEN 'ORD' THEN 2 ELSE 3 END AS r FROM m) x
GROUP BY customer_id, date, category, quantity, unit_price""", m=O.merged_sql(MG.DEFAULT_COUNTRIES, keep_source=True)))
def u04(spark, sf_dir):
    m = MG.merge_sources(transformed_frames(spark, sf_dir), keep_source=True)
    return RP.dedup_across_sources(m, ["customer_id", "date", "category", "quantity", "unit_price"],
                                   ["transaction_id", "source", "timestamp"], MG.SOURCE_RANK)


@query("a03_rfm_full_wide", ctes(f"""
SELECT customer_id, CAST((SELECT max(date) FROM p) + 1 - max(date) AS BIGINT) AS Recency,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS Frequency,
       round(CAST(sum(total_amount) AS DOUBLE), 6) AS Monetary,
       {", ".join(f"round(coalesce(sum(total_amount) FILTER (WHERE category = '{c}') / sum(total_amount), 0), 6) AS Pct_{c}" for c in KNOWN_CATEGORIES)},
       CAST(arg_min(age, (transaction_id, date)) AS DOUBLE) AS age,
       CAST(CASE arg_min(gender, (transaction_id, date)) WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 ELSE -1 END AS INT) AS gender
FROM p GROUP BY customer_id""", p=SHIFTED_SALES))
def a03_full(spark, sf_dir):
    """A03 + A04 + J12 + P31: RFM, category shares and demographics in one groupBy."""
    out = R.rfm_full(transactions(spark, sf_dir), KNOWN_CATEGORIES)
    return _round(out, ["Monetary"] + [f"Pct_{c}" for c in KNOWN_CATEGORIES])


# --- Machine learning: M06-M28, T03 ----------------------------------------------
from ..operators import classify as CL  # noqa: E402
from ..operators import cluster as CU  # noqa: E402
from ..session import materialize, spread, stage_root  # noqa: E402

CLASSES = ("Diamond", "Standard")
GOOD_SEGMENTS = ("Champions", "Loyal Customers")


def rule_prediction():
    """A fixed rule standing in for a model where predictions must be exact."""
    return F.when(F.col("Segment").isin(list(GOOD_SEGMENTS)), F.lit("Diamond")).otherwise(F.lit("Standard"))


RULE_SQL = ("CASE WHEN Segment IN (" + ", ".join(f"'{s}'" for s in GOOD_SEGMENTS)
            + ") THEN 'Diamond' ELSE 'Standard' END")

SPLIT_SQL = """SELECT customer_id, Tier,
       CASE WHEN row_number() OVER (PARTITION BY Tier ORDER BY md5(customer_id))
                 <= round(count(*) OVER (PARTITION BY Tier) * 0.8) THEN 'train' ELSE 'test' END AS split FROM lab"""


@query("m10_label_encoding", lab_sql("""
SELECT customer_id, Segment, CAST(dense_rank() OVER (ORDER BY Segment) - 1 AS DOUBLE) AS label FROM lab"""))
def m10(spark, sf_dir):
    return CL.encode_labels(labeled(spark, sf_dir).select("customer_id", "Segment"))


@query("m12_stratified_split", lab_sql(SPLIT_SQL))
def m12(spark, sf_dir):
    return CL.stratified_split(labeled(spark, sf_dir).select("customer_id", "Tier"), "Tier")


def rule_predictions(spark, sf_dir):
    lab = labeled(spark, sf_dir)
    split = CL.stratified_split(lab.select("customer_id", "Tier"), "Tier").select("customer_id", "split")
    return lab.join(split, "customer_id").withColumn("prediction", rule_prediction())


@query("m15_holdout_accuracy", lab_sql(f"""
SELECT round(avg(CAST(lab.Tier = {RULE_SQL} AS DOUBLE)), 6) AS accuracy
FROM lab JOIN sp USING (customer_id) WHERE sp.split = 'test'""", sp=SPLIT_SQL))
def m15(spark, sf_dir):
    pred = rule_predictions(spark, sf_dir).where(F.col("split") == "test")
    return _round(CL.accuracy(pred, "Tier", "prediction"), ["accuracy"])


def _report_sql(pr: str) -> str:
    per = f"""SELECT c.cls, CASE WHEN coalesce(pn, 0) > 0 THEN coalesce(tp, 0) * 1.0 / pn ELSE 0 END AS precision,
               CASE WHEN coalesce(sn, 0) > 0 THEN coalesce(tp, 0) * 1.0 / sn ELSE 0 END AS recall,
               CAST(coalesce(sn, 0) AS BIGINT) AS support
        FROM (SELECT y AS cls FROM pr UNION SELECT p FROM pr) c
        LEFT JOIN (SELECT y AS cls, count(*) AS sn FROM pr GROUP BY y) s USING (cls)
        LEFT JOIN (SELECT p AS cls, count(*) AS pn FROM pr GROUP BY p) q USING (cls)
        LEFT JOIN (SELECT y AS cls, count(*) AS tp FROM pr WHERE y = p GROUP BY y) t USING (cls)"""
    f1 = "CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END"
    return lab_sql(f"""
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT cls, precision, recall, {f1} AS f1, support FROM per
  UNION ALL SELECT 'accuracy', (SELECT avg(CAST(y = p AS DOUBLE)) FROM pr), (SELECT avg(CAST(y = p AS DOUBLE)) FROM pr),
                   (SELECT avg(CAST(y = p AS DOUBLE)) FROM pr), CAST(sum(support) AS BIGINT) FROM per WHERE support > 0
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg({f1}), CAST(sum(support) AS BIGINT) FROM per WHERE support > 0
  UNION ALL SELECT 'weighted avg', sum(precision * support) / (SELECT count(*) FROM pr),
                   sum(recall * support) / (SELECT count(*) FROM pr), sum({f1} * support) / (SELECT count(*) FROM pr),
                   CAST(sum(support) AS BIGINT) FROM per WHERE support > 0) r""",
                   sp=SPLIT_SQL, pr=pr, per=per)


@query("m16_classification_report", _report_sql(
    f"SELECT lab.Tier AS y, {RULE_SQL} AS p FROM lab JOIN sp USING (customer_id) WHERE sp.split = 'test'"))
def m16(spark, sf_dir):
    pred = rule_predictions(spark, sf_dir).where(F.col("split") == "test")
    return CL.classification_report(pred, "Tier", "prediction")


@query("m18_confusion_matrix", lab_sql(
    "SELECT lab.Tier AS actual, " + ", ".join(f"CAST(count(*) FILTER (WHERE {RULE_SQL} = '{c}') AS BIGINT) AS pred_{c}"
                                        for c in CLASSES) + " FROM lab JOIN sp USING (customer_id) WHERE sp.split = 'test' GROUP BY lab.Tier",
    sp=SPLIT_SQL))
def m18(spark, sf_dir):
    held_out = rule_predictions(spark, sf_dir).where(F.col("split") == "test")
    return CL.confusion_matrix(held_out, CLASSES, "Tier", "prediction")


@query("m25_auc_exact", lab_sql("""
SELECT round((sum(r) FILTER (WHERE pos) - np * (np + 1) / 2.0) / (np * nn), 6) AS auc
FROM (SELECT Tier = 'Diamond' AS pos,
             rank() OVER (ORDER BY Monetary) + (count(*) OVER (PARTITION BY Monetary) - 1) / 2.0 AS r,
             count(*) FILTER (WHERE Tier = 'Diamond') OVER () AS np,
             count(*) FILTER (WHERE Tier <> 'Diamond') OVER () AS nn FROM lab) x GROUP BY np, nn"""))
def m25(spark, sf_dir):
    lab = labeled(spark, sf_dir).withColumn("_pos", F.col("Tier") == "Diamond")
    return CL.exact_auc(lab, "Monetary", "_pos")


@query("m28_metrics_by_period", lab_sql(f"""
SELECT month, rows, round(accuracy, 6) AS accuracy, round(accuracy - lag(accuracy) OVER (ORDER BY month), 6) AS change,
       accuracy < 0.85 OR coalesce(accuracy - lag(accuracy) OVER (ORDER BY month) < -0.02, false) AS retrain
FROM (SELECT strftime(date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS rows,
             avg(CAST(Tier = {RULE_SQL} AS DOUBLE)) AS accuracy FROM tr GROUP BY 1) m"""))
def m28(spark, sf_dir):
    t = labeled_transactions(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    return CL.metrics_by_period(t.withColumn("prediction", rule_prediction()), "month", "Tier", "prediction")


# rows-only model fits ---------------------------------------------------------
def customer_features(spark, sf_dir):
    """Outlier-free registered customers, staged once for the model fits."""
    return spread(materialize(FE.remove_outliers(rfm_customers(spark, sf_dir)), "rfm-clean"), "rfm-spread")


def training_table(spark, sf_dir):
    """Labeled customers + encoded label + assembled numeric features."""
    lab = materialize(labeled(spark, sf_dir), "labeled")
    feats = CL.numeric_features(lab, exclude=("customer_id", "Cluster", "Segment", "Tier"))
    enc = CL.encode_labels(lab, "Tier", "label")
    return CL.assemble_features(enc, feats), feats


@query("m06_kmeans_segments")
def m06(spark, sf_dir):
    rfm = customer_features(spark, sf_dir)
    model = CU.fit_segmentation(rfm, k=2)
    return CU.label_customers(model, rfm).select("customer_id", "Recency", "Frequency", "Monetary", "Cluster",
                                                 "Segment")


@query("m07_k_selection")
def m07(spark, sf_dir):
    rfm = customer_features(spark, sf_dir)
    prep = CU.Pipeline(stages=[FE.PowerTransformer(inputCols=list(FE.RFM_COLUMNS), outputCols=list(CU.SCALED)),
                               CU.VectorAssembler(inputCols=list(CU.SCALED), outputCol="features")]).fit(rfm)
    return CU.k_selection(spread(materialize(prep.transform(rfm).select("features"), "scaled"), "scaled-spread"))


@query("m08_elbow")
def m08(spark, sf_dir):
    rfm = customer_features(spark, sf_dir)
    scaled = FE.PowerTransformer(inputCols=list(FE.RFM_COLUMNS), outputCols=list(CU.SCALED)).fit(rfm).transform(rfm)
    data = spread(materialize(CU.assemble(scaled, CU.SCALED).select(*CU.SCALED, "features"), "scaled"), "scaled-spread")
    return CU.elbow(data, CU.SCALED)


@query("m11_feature_assembly")
def m11(spark, sf_dir):
    table, feats = training_table(spark, sf_dir)
    return table.select("customer_id", "label", "features")


def _split_train_test(spark, sf_dir):
    table, feats = training_table(spark, sf_dir)
    split = CL.stratified_split(table, "label")
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test"), feats, split


@query("m13_decision_tree")
def m13(spark, sf_dir):
    train, test, feats, _ = _split_train_test(spark, sf_dir)
    return CL.decision_tree().fit(train).transform(test).select("customer_id", "label", "prediction")


@query("m14_random_forest")
def m14(spark, sf_dir):
    train, test, feats, _ = _split_train_test(spark, sf_dir)
    return CL.random_forest().fit(train).transform(test).select("customer_id", "label", "prediction")


@query("m17_cross_validation")
def m17(spark, sf_dir):
    table, feats = training_table(spark, sf_dir)
    return CL.cross_validate(CL.decision_tree(), table)


@query("m19_feature_importances")
def m19(spark, sf_dir):
    train, test, feats, _ = _split_train_test(spark, sf_dir)
    return CL.feature_importances(spark, CL.random_forest().fit(train), feats)


@query("t03_top_importances")
def t03(spark, sf_dir):
    return m19(spark, sf_dir).limit(3)


@query("m20_pca_projection")
def m20(spark, sf_dir):
    table, feats = training_table(spark, sf_dir)
    return CL.pca_projection(table.select("customer_id", "label", "features")).drop("features")


@query("m21_silhouette")
def m21(spark, sf_dir):
    rfm = customer_features(spark, sf_dir)
    model = CU.fit_segmentation(rfm, k=2)
    sil = CU.silhouette(model.transform(rfm))
    return rfm.agg(F.count(F.lit(1)).cast("bigint").alias("customers")).select(
        "customers", F.lit(sil).alias("silhouette_squared_euclidean"))


@query("m22_model_comparison")
def m22(spark, sf_dir):
    """Depth-5 tree vs forest on one split (both fitted on train)."""
    train, test, feats, _ = _split_train_test(spark, sf_dir)
    parts = []
    for name, est in (("decision_tree", CL.decision_tree(max_depth=5)), ("random_forest", CL.random_forest())):
        pred = est.fit(train).transform(test)
        parts.append(CL.classification_report(pred).select(F.lit(name).alias("model"), "*"))
    return parts[0].unionByName(parts[1])


@query("m23_score_new_customers")
def m23(spark, sf_dir):
    """M23 + S13: fit, save, load, then score guest customers; clusters without
    a name fall back to 'Cluster n'."""
    import uuid
    rfm = customer_features(spark, sf_dir)
    model = CU.fit_segmentation(rfm, k=2)
    mapping = CU.tier_mapping(CU.label_customers(model, rfm).select("Cluster", *FE.RFM_COLUMNS))
    path = f"{stage_root(spark)}/model-{uuid.uuid4().hex}"
    CU.save_model(model, path)
    loaded = CU.load_model(path)
    guests = guest_base(spark, sf_dir).withColumnRenamed("user_id", "customer_id")
    return CU.label_customers(loaded, guests, mapping).select("customer_id", "Cluster", "Segment")


@query("m26_tree_grid_search")
def m26(spark, sf_dir):
    """M26 over single trees."""
    table, feats = training_table(spark, sf_dir)
    return CL.grid_search(CL.decision_tree(), table)


@query("m26_grid_search")
def m26_forest(spark, sf_dir):
    """The source's search; Spark has no minimum split size."""
    table, feats = training_table(spark, sf_dir)
    return CL.grid_search(CL.random_forest(), table, depths=(10, 20, 30), min_instances=(1, 2, 4))


@query("m27_batch_prediction_confidence")
def m27(spark, sf_dir):
    train, test, feats, _ = _split_train_test(spark, sf_dir)
    pred = CL.random_forest().fit(train).transform(test)
    return CL.with_confidence(pred).select("customer_id", "prediction", "confidence")


# --- Streaming: R02-R05 ---------------------------------------------------------
from ..streaming import streams as ST  # noqa: E402

PURCHASES = "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase'"


def _landing(spark, sf_dir):
    """(rows, folder, schema): purchases and an empty landing folder for them."""
    from pyspark.sql import types as T
    src = X._sql(spark, sf_dir, PURCHASES)
    schema = T.StructType(src.schema.fields + [T.StructField("day", T.DateType())])
    return src, ST.new_location(spark, "landed-purchases"), schema


def _in_two_runs(spark, sf_dir, name, build, mode="append", copies=1, late=None, conf=None):
    """Land the first half of the days, run the query and stop it; land the rest
    (every file ``copies`` times, and the rows that ``late`` picks once more)
    and start the query again at the same place.  Returns its output folder."""
    src, path, schema = _landing(spark, sf_dir)
    days = src.select(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle, where = days["a"] + (days["b"] - days["a"]) / 2, ST.new_location(spark, name)
    for part in (F.col("ts") < F.lit(middle), F.col("ts") >= F.lit(middle)):
        for _ in range(copies):
            ST.land_by_day(src.where(part), "ts", path)
        out = ST.run_available(build(ST.file_stream(spark, path, schema)), where, mode=mode, conf=conf)
    if late is not None:
        ST.land_by_day(src.where(late(F.lit(days["b"]))), "ts", path)
        out = ST.run_available(build(ST.file_stream(spark, path, schema)), where, mode=mode, conf=conf)
    return out


STREAM_RFM_SQL = """
SELECT user_id, CAST(floor((epoch_us((SELECT max(ts) FROM pu)) - epoch_us(max(ts))) / 86400000000.0) AS BIGINT) AS Recency,
       CAST(count(DISTINCT event_id) AS BIGINT) AS Frequency, round(sum(value), 6) AS Monetary
FROM pu GROUP BY user_id"""


@query("r02_stream_running_rfm", ctes(STREAM_RFM_SQL, pu=PURCHASES))
def r02(spark, sf_dir):
    def build(stream):
        return ST.running_rfm_stream(stream, "user_id", "ts", "event_id", "value")
    # every file comes twice, and days more than a month back come once more after the end
    out = _in_two_runs(spark, sf_dir, "rfm", build, mode="update", copies=2, conf=ST.ROCKSDB,
                       late=lambda last: F.col("ts") < F.date_sub(last.cast("date"), 30))
    return _round(ST.read_running_rfm(spark, out, "user_id"), ["Monetary"])


@query("r04_stream_dedup", PURCHASES)
def r04(spark, sf_dir):
    def build(stream):
        return ST.dedup_stream(stream, ["event_id"], "ts", "40 days").drop("day")
    out = _in_two_runs(spark, sf_dir, "dedup", build, copies=2)
    return spark.read.parquet(out).drop("batch_id").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("r03_stream_segment_windows", ctes("""
SELECT time_bucket(INTERVAL 1 DAY, pu.ts) AS window_start, time_bucket(INTERVAL 1 DAY, pu.ts) + INTERVAL 1 DAY AS window_end,
       sc.Segment, CAST(count(*) AS BIGINT) AS count
FROM pu LEFT JOIN sc USING (user_id) GROUP BY 1, 2, 3""",
    pu=PURCHASES,
    sc=scores_sql(5)))
def r03(spark, sf_dir):
    """Rows of days that closed before the watermark (2 days behind the latest
    event) arrive once more after both runs; as late rows they count nothing."""
    labels = R.segment_scores(R.score_columns(guest_base(spark, sf_dir), q=5)).select("user_id", "Segment")
    labels = materialize(labels, "guest-labels")

    def build(stream):
        return ST.windowed_segment_counts(stream, labels, "user_id", "ts", delay="2 days")
    out = _in_two_runs(spark, sf_dir, "windows", build, mode="update",
                       late=lambda last: F.col("ts") < F.date_sub(last.cast("date"), 3))
    final = ST.latest_per_key(spark.read.parquet(out), ["window_start", "window_end", "Segment"])
    return final.withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))


@query("r05_stream_scoring")
def r05(spark, sf_dir):
    import uuid
    rfm = customer_features(spark, sf_dir)
    model = CU.fit_segmentation(rfm, k=2)
    mapping = materialize(CU.tier_mapping(CU.label_customers(model, rfm).select("Cluster", *FE.RFM_COLUMNS)), "tiers")
    arriving = guest_base(spark, sf_dir).withColumnRenamed("user_id", "customer_id")
    path = f"{stage_root(spark)}/arriving-{uuid.uuid4().hex}"
    arriving.write.parquet(path)
    stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = ST.run_available(stream, ST.new_location(spark, "scoring"), batch_fn=ST.score_batches(model, mapping))
    return spark.read.parquet(out)


# --- W08 Q-Q points, P14 cleaning audit ---------------------------------------------
@query("w08_qq_points", lab_sql("""
SELECT i, round(theoretical, 6) AS theoretical, ordered,
       round((SELECT regr_slope(ordered, theoretical) FROM pts), 6) AS fit_slope,
       round((SELECT regr_intercept(ordered, theoretical) FROM pts), 6) AS fit_intercept,
       round((SELECT corr(ordered, theoretical) FROM pts), 6) AS fit_r
FROM pts""", pos="""SELECT CAST(row_number() OVER (ORDER BY Monetary) AS BIGINT) AS i, Monetary AS ordered,
       count(*) OVER () AS n FROM rf""",
    pp="""SELECT i, ordered, CASE WHEN i = n THEN power(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - power(0.5, 1.0 / n)
          ELSE (i - 0.3175) / (n + 0.365) END AS pp FROM pos""",
    pts=f"SELECT i, ordered, {O.norm_ppf_sql('pp')} AS theoretical FROM pp"))
def w08(spark, sf_dir):
    return RP.qq_points(rfm_customers(spark, sf_dir), "Monetary")


def _audit_sql(name: str, raw_sql: str, cols: dict, date_fmt: str, has_age: bool, has_gender: bool) -> str:
    """Oracle of the cleaning audit for one source (cols: canonical -> raw name)."""
    sel = ", ".join(f"{O.nul(raw)} AS {c}" for c, raw in cols.items())
    crit_null = "quantity IS NULL OR unit_price IS NULL OR date IS NULL"
    typed = (f"SELECT *, TRY_CAST(quantity AS DOUBLE) AS q, TRY_CAST(unit_price AS DOUBLE) AS u, "
             f"try_strptime(date, '{date_fmt}') AS d" + (", TRY_CAST(age AS DOUBLE) AS a" if has_age else "")
             + " FROM m")
    kept = "SELECT * FROM t WHERE q IS NOT NULL AND u IS NOT NULL AND d IS NOT NULL"
    text_fill = [c for c in ("description", "product_name", "category", "country") if c in cols]
    med_fill = ["a"] if has_age else []
    if "total_amount" in cols:
        med_fill.append("TRY_CAST(total_amount AS DOUBLE)")
    imputed = " + ".join([f"CAST({c} IS NULL AS INT)" for c in ["customer_id", *text_fill]]
                         + [f"CAST({c} IS NULL AS INT)" for c in med_fill])
    age_fix = ("CAST(coalesce(a, (SELECT median(a) FROM k)) < 10 OR coalesce(a, (SELECT median(a) FROM k)) > 100 AS INT)"
               if has_age else "0")
    canon = ", ".join(["q", "u", "d", "coalesce(customer_id, '0')"]
                      + [f"coalesce({c}, 'Unknown')" for c in text_fill]
                      + [c for c in cols if c not in ("quantity", "unit_price", "date", "customer_id", *text_fill,
                                                      "age", "total_amount", "gender")]
                      + (["coalesce(a, (SELECT median(a) FROM k))"] if has_age else [])
                      + ([O.gender_rule("gender")] if has_gender else []))
    return ctes(f"""
SELECT '{name}' AS source, CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count(*) FILTER (WHERE {crit_null}) AS BIGINT) AS rows_removed_missing,
       CAST(count(*) FILTER (WHERE NOT ({crit_null}) AND (q IS NULL OR u IS NULL OR d IS NULL)) AS BIGINT) AS rows_dropped_invalid,
       CAST((SELECT sum({imputed}) FROM k) AS BIGINT) AS values_imputed,
       CAST((SELECT sum(CAST(u < 0 AS INT) + {age_fix}) FROM k) AS BIGINT) AS values_corrected,
       CAST((SELECT count(*) FILTER (WHERE q < 0) FROM k) AS BIGINT) AS returns_kept,
       CAST((SELECT count(*) FROM k) - (SELECT count(*) FROM (SELECT DISTINCT {canon} FROM k) x) AS BIGINT) AS duplicates_removed,
       CAST((SELECT count(*) FROM (SELECT DISTINCT {canon} FROM k) x) AS BIGINT) AS rows_out
FROM t""", r=raw_sql, m=f"SELECT {sel} FROM r", t=typed, k=kept)


ONLINE_RAW_COLS = {"transaction_id": "InvoiceNo", "sku_code": "StockCode", "product_name": "Description",
                   "quantity": "Quantity", "date": "InvoiceDate", "unit_price": "UnitPrice",
                   "customer_id": "CustomerID", "country": "Country"}


@query("p14_cleaning_audit", _audit_sql("UCI", X.ALL_ONLINE_SQL, ONLINE_RAW_COLS, "%m/%d/%Y %H:%M", False, False))
def p14(spark, sf_dir):
    return C.cleaning_audit(X.raw_online(spark, sf_dir, every_line=True), SRC.ONLINE)


@query("p14_cleaning_audit_retail", _audit_sql(
    "Kaggle", X.ALL_RETAIL_SQL, {c: c for c in ("transaction_id", "date", "customer_id", "gender", "age", "category",
                                               "quantity", "unit_price", "total_amount")},
    "%Y-%m-%d", True, True))
def p14_retail(spark, sf_dir):
    return C.cleaning_audit(X.raw_retail(spark, sf_dir, every_line=True), SRC.RETAIL)


@query("s17_enriched_export", lab_sql("""
SELECT s.*, g.segment_group FROM ({sales}) s
JOIN (SELECT DISTINCT customer_id, CASE WHEN customer_id = '0' THEN 'Guest' ELSE Tier END AS segment_group FROM lab) g
ON s.customer_id = g.customer_id""".replace("{sales}", SALES)))
def s17(spark, sf_dir):
    """Sales lines of every exported id list, tagged with its list."""
    ids = RP.segment_groups(labeled(spark, sf_dir), "Tier")
    return RP.enrich_by_file(ids, X.sales(spark, sf_dir), file_col="segment_group")


@query("m04_box_cox_fit")
def m04_fit(spark, sf_dir):
    """M04 fit (rows-only): Box-Cox on x + 1, lambdas by maximum likelihood."""
    base = FE.remove_outliers(rfm_customers(spark, sf_dir))
    model = FE.PowerTransformer(inputCols=list(FE.RFM_COLUMNS), outputCols=["R_bc", "F_bc", "M_bc"],
                                method="box-cox").fit(base)
    return model.transform(base).select("customer_id", "R_bc", "F_bc", "M_bc")
