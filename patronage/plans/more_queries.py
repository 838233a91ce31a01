"""Checked queries on uploads, padding, generated ids, imputation, declared
schemas and saved classifiers.  Importing this module fills the registry."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import classify as CL
from ..operators import cleaning as C
from ..operators import features as FE
from ..operators import reports as RP
from ..operators import rfm as R
from ..operators import sketches as SK
from ..operators import transform as TR
from ..operators import warehouse as WH
from ..session import materialize, stage_root
from ..sources import files as FS
from ..sources import fixtures as X
from ..sources.tables import read_table
from . import oracle_parts as O
from . import queries as Q
from .registry import ctes, query

SALES = X.SALES_SQL


# --- J10 inner, J14 + S18 ---------------------------------------------------------
@query("j10_transactions_labels_inner", Q.lab_sql("""
SELECT tr.customer_id, transaction_id, category, date AS transaction_date, tr.Segment
FROM tr JOIN lab ON tr.customer_id = lab.customer_id WHERE lab.Segment = 'Champions'"""))
def j10_inner(spark, sf_dir):
    lab = Q.labeled(spark, sf_dir).where(F.col("Segment") == "Champions").select("customer_id", "Segment")
    return Q.transactions(spark, sf_dir).join(lab, "customer_id").select(
        "customer_id", "transaction_id", "category", F.col("date").alias("transaction_date"), "Segment")


@query("j14_scaled_labels", Q.lab_sql("""
SELECT customer_id, Segment, Tier,
       round((Recency - (SELECT avg(Recency) FROM lab)) / (SELECT stddev_pop(Recency) FROM lab), 6) AS R_scaled,
       round((Frequency - (SELECT avg(Frequency) FROM lab)) / (SELECT stddev_pop(Frequency) FROM lab), 6) AS F_scaled,
       round((Monetary - (SELECT avg(Monetary) FROM lab)) / (SELECT stddev_pop(Monetary) FROM lab), 6) AS M_scaled
FROM lab"""))
def j14(spark, sf_dir):
    """S18 + J14: the scaled table keeps its customer id; labels join it by id."""
    names = ["R_scaled", "F_scaled", "M_scaled"]
    lab = materialize(Q.labeled(spark, sf_dir), "labeled")
    path = f"{stage_root(spark)}/scaled-{uuid.uuid4().hex}"
    FS.write_stage(FE.standard_scale(lab, names=names).select("customer_id", *names), path)
    return Q._round(lab.select("customer_id", "Segment", "Tier").join(spark.read.parquet(path), "customer_id"), names)


# --- S14 + P34 uploads of computed RFM ---------------------------------------------
UPLOAD_SQL = """
SELECT CAST(c_custkey AS STRING) AS customer_id,
       CASE WHEN c_custkey % 17 = 0 THEN 'unknown' ELSE CAST(c_custkey % 365 AS STRING) END AS Recency,
       CASE WHEN c_custkey % 23 = 0 THEN '' ELSE CAST(c_custkey % 40 + 1 AS STRING) END AS Frequency,
       CASE WHEN c_custkey % 29 = 0 THEN CAST(NULL AS STRING) ELSE CAST(c_acctbal AS STRING) END AS Monetary
FROM customer
"""
_NUMBERS = "TRY_CAST(Recency AS DOUBLE) AS r, TRY_CAST(Frequency AS DOUBLE) AS f, TRY_CAST(Monetary AS DOUBLE) AS m"


@query("s14_upload_rfm", ctes("""
SELECT customer_id, r AS Recency, f AS Frequency, m AS Monetary FROM n
WHERE r IS NOT NULL AND f IS NOT NULL AND m IS NOT NULL""", u=UPLOAD_SQL, n=f"SELECT customer_id, {_NUMBERS} FROM u"))
def s14(spark, sf_dir):
    upload = X._sql(spark, sf_dir, UPLOAD_SQL)
    R.require_columns(upload, ["customer_id", *FE.RFM_COLUMNS], "upload")
    return RP.split_valid(upload, FE.RFM_COLUMNS)[0]


@query("p34_rejected_upload", ctes("""
SELECT u.* FROM u JOIN n USING (customer_id) WHERE r IS NULL OR f IS NULL OR m IS NULL""",
    u=UPLOAD_SQL, n=f"SELECT customer_id, {_NUMBERS} FROM u"))
def p34_rejected(spark, sf_dir):
    return RP.split_valid(X._sql(spark, sf_dir, UPLOAD_SQL), FE.RFM_COLUMNS)[1]


# --- S09 padding, S10 declared schema, P19 generated ids, P10 imputation -------------
PADDED = T.StructType([T.StructField(n, t) for n, t in (
    ("customer_id", T.StringType()), ("quantity", T.LongType()), ("discount", T.DoubleType()),
    ("country", T.StringType()), ("note", T.StringType()))])


@query("s09_padded_columns", ctes("""
SELECT customer_id, CAST(quantity AS BIGINT) AS quantity, CAST(NULL AS DOUBLE) AS discount, country,
       CAST(NULL AS VARCHAR) AS note FROM s""", s=SALES))
def s09(spark, sf_dir):
    return FS.pad_columns(X.sales(spark, sf_dir), PADDED)


@query("s10_declared_schema", O.wh_sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count({k}) AS BIGINT) AS null_keys, "
    f"CAST(count({k}) - count(DISTINCT {k}) AS BIGINT) AS repeated_keys, true AS as_declared FROM {a}"
    for t, k, a in (("dim_date", "date_id", "dd"), ("dim_category", "category_id", "dc"),
                    ("dim_location", "location_id", "dl"), ("dim_customer", "customer_key", "cu"),
                    ("fact_sales", "sales_id", "fs")))))
def s10(spark, sf_dir):
    return WH.schema_checks(Q.warehouse(spark, sf_dir))


@query("p19_generated_ids", """
SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) + 500 AS VARCHAR) AS transaction_id,
       l_orderkey, l_linenumber, l_partkey FROM lineitem""")
def p19(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return TR.ensure_ids(lines, offset=500, order=["l_orderkey", "l_linenumber", "l_partkey"])


GAPS_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) END AS price,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE o_custkey END AS last_customer FROM orders
"""


@query("p10_imputation", ctes("""
SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM g)), 4) AS price,
       coalesce(status, (SELECT status FROM g WHERE status IS NOT NULL GROUP BY status
                         ORDER BY count(*) DESC, status LIMIT 1)) AS status,
       last_value(last_customer IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS last_customer
FROM g""", g=GAPS_SQL))
def p10(spark, sf_dir):
    rows = X._sql(spark, sf_dir, GAPS_SQL)
    rows = C.impute(C.impute(rows, "price", "mean"), "status", "mode")
    return C.impute(rows, "last_customer", "ffill", ["o_orderkey"]).withColumn("price", F.round("price", 4))


# --- M24 with a caller's classifier ---------------------------------------------------
def _by_first_letter(names: pd.Series) -> pd.Series:
    if names.str.startswith("Q").any() or names.str.contains("puff").any():
        raise ValueError("no label")
    return names.str[0].str.upper().map(lambda c: "Books" if c < "M" else "Toys")


@query("m24_user_classifier", """
SELECT p_partkey, CASE WHEN p_name LIKE 'Q%' OR p_name LIKE '%puff%' THEN 'Other'
                       WHEN upper(p_name[1]) < 'M' THEN 'Books' ELSE 'Toys' END AS category,
       p_name LIKE 'Q%' OR p_name LIKE '%puff%' AS failed FROM part""")
def m24_user(spark, sf_dir):
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return TR.categorize(parts, name="p_name", classifier=_by_first_letter, failed="failed").select(
        "p_partkey", "category", "failed")


# --- classifiers: M17, M19, M20, S13 ----------------------------------------------------
@query("m17_forest_cross_validation")
def m17_forest(spark, sf_dir):
    table, _ = Q.training_table(spark, sf_dir)
    return CL.cross_validate(CL.random_forest(), table)


@query("m19_tree_importances")
def m19_tree(spark, sf_dir):
    train, _, feats, _ = Q._split_train_test(spark, sf_dir)
    return CL.feature_importances(spark, CL.decision_tree().fit(train), feats)


@query("m20_pca_with_labels")
def m20_labels(spark, sf_dir):
    """The projected customers with the labels of the tree and the forest."""
    train, _, _, split = Q._split_train_test(spark, sf_dir)
    out = split.select("customer_id", "label", "features")
    for name, est in (("tree_label", CL.decision_tree()), ("forest_label", CL.random_forest())):
        out = est.fit(train).transform(out).withColumnRenamed("prediction", name).drop("rawPrediction", "probability")
    return CL.pca_projection(out).drop("features")


@query("s13_saved_classifiers")
def s13(spark, sf_dir):
    """The fitted tree and forest saved, loaded and applied to the hold-out rows."""
    train, test, _, _ = Q._split_train_test(spark, sf_dir)
    test, out = materialize(test.select("customer_id", "label", "features"), "hold-out"), None
    for name, est in (("tree", CL.decision_tree()), ("forest", CL.random_forest())):
        path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
        fitted = est.fit(train)
        fitted.write().overwrite().save(path)
        part = type(fitted).load(path).transform(test).select(
            F.lit(name).alias("model"), "customer_id", "label", "prediction")
        out = part if out is None else out.unionByName(part)
    return out


# --- A31 by sketches, A26 on many columns -------------------------------------------
@query("a31_yearly_sketches", Q.lab_sql("""
SELECT CAST(year(date) AS INT) AS year, CAST(count(*) AS BIGINT) AS lines,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS transactions, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers,
       TRUE AS transactions_close, TRUE AS customers_close
FROM p GROUP BY 1"""))
def a31_sketches(spark, sf_dir):
    """Months' sketches are stored and merged into years; each estimate lies within
    four standard errors of the exact count beside it."""
    lines, counted = Q.transactions(spark, sf_dir), ["transaction_id", "customer_id"]
    months = SK.distinct_sketches(lines, {"year": F.year("date"), "month": F.month("date")}, counted)
    years = SK.rolled_up(materialize(months, "month-sketches"), {"year": F.col("year")}, counted)
    near = SK.estimates(years, counted).select("year", "lines", *[F.col(c).alias(f"_{c}") for c in counted])
    exact = lines.groupBy(F.year("date").alias("year")).agg(
        *[F.countDistinct(c).cast("bigint").alias(f"{c.removesuffix('_id')}s") for c in counted])

    def close(name: str):
        apart = F.abs(F.col(f"_{name}_id") - F.col(f"{name}s"))
        return (apart <= 4 * SK.error() * F.col(f"{name}s") + 1).alias(f"{name}s_close")
    return near.join(exact, "year").select("year", "lines", "transactions", "customers", close("transaction"),
                                           close("customer"))


MONTHS = [f"m{k}" for k in range(1, 13)]
WIDE = ["Recency", "Frequency", "Monetary", *MONTHS]


@query("a26_correlation_wide", Q.lab_sql(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM wide"
    for i, a in enumerate(WIDE) for b in WIDE[i:]), wide="SELECT * FROM lab JOIN (SELECT customer_id, " + ", ".join(
        f"sum(total_amount) FILTER (WHERE month(date) = {k}) AS m{k}" for k in range(1, 13)) + """
    FROM p GROUP BY customer_id) USING (customer_id)"""))
def a26_wide(spark, sf_dir):
    """RFM and a customer's spend in each calendar month (null without any): 120 pairs."""
    month = F.month("date")
    spend = Q.transactions(spark, sf_dir).groupBy("customer_id").agg(
        *[F.sum(F.when(month == k, F.col("total_amount"))).alias(f"m{k}") for k in range(1, 13)])
    wide = Q.labeled(spark, sf_dir).select("customer_id", *WIDE[:3]).join(spend, "customer_id")
    return RP.correlations(wide, WIDE)
