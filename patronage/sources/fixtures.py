"""Canonical input frames derived from the driver tables.

Each fixture is one SQL text that runs unchanged on Spark and on DuckDB, so
the oracle and the Spark job start from identical rows.  The three raw
sources that are merged split ``lineitem`` by order key into three disjoint
parts that together cover every line; the ALL_ frames hold every line in the
form of one source, for the queries about a single source.  All raw columns are strings, as landed files are.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import TABLES, register_tables

# Merged-shape sales lines (one row per line item).
SALES_SQL = """
SELECT CAST(l.l_orderkey AS STRING) AS transaction_id,
       CAST(o.o_orderdate AS DATE) AS date,
       CAST(o.o_custkey AS STRING) AS customer_id,
       CAST(18 + (o.o_custkey * 7) % 58 AS INT) AS age,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       n.n_name AS country, p.p_type AS category,
       CAST(CASE WHEN l.l_returnflag='R' THEN -l.l_quantity ELSE l.l_quantity END AS INT) AS quantity,
       CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(CASE WHEN l.l_returnflag='R' THEN -l.l_quantity ELSE l.l_quantity END AS INT)
            * CAST(p.p_retailprice AS DECIMAL(10,2)) AS DECIMAL(15,2)) AS total_amount
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
JOIN part p ON l.l_partkey=p.p_partkey
"""

# Raw retail-sales source: bad dates, '-9' and 150 ages, mixed-case genders,
# '?' categories, empty quantities, negative prices.  Canonical names here;
# ``RETAIL_SOURCE_NAMES`` gives the landed header names.
_RETAIL_TEMPLATE = """
SELECT CAST(l.l_orderkey AS STRING) AS transaction_id,
 CASE WHEN l.l_orderkey % 101 = 0 THEN 'not a date' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS date,
 concat('CUST', CAST(o.o_custkey AS STRING)) AS customer_id,
 CASE o.o_custkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'Male' WHEN 3 THEN 'NULL' ELSE 'x' END AS gender,
 CASE WHEN o.o_custkey % 11 = 0 THEN '-9' WHEN o.o_custkey % 13 = 0 THEN '150'
      ELSE CAST(18 + (o.o_custkey * 7) % 58 AS STRING) END AS age,
 CASE WHEN l.l_partkey % 17 = 0 THEN '?' ELSE p.p_type END AS category,
 CASE WHEN l.l_orderkey % 37 = 0 THEN '' ELSE CAST(CAST(l.l_quantity AS INT) AS STRING) END AS quantity,
 CASE WHEN l.l_linenumber = 7 THEN concat('-', CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS STRING))
      ELSE CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS STRING) END AS unit_price,
 CAST(NULL AS STRING) AS total_amount
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
JOIN part p ON l.l_partkey=p.p_partkey {where}
"""

_ONLINE_TEMPLATE = """
SELECT CASE WHEN l.l_returnflag='R' THEN concat('C', CAST(l.l_orderkey AS STRING)) ELSE CAST(l.l_orderkey AS STRING) END AS InvoiceNo,
 CAST(l.l_partkey AS STRING) AS StockCode,
 CASE WHEN l.l_partkey % 19 = 0 THEN 'nan' ELSE p.p_name END AS Description,
 CAST(CAST(CASE WHEN l.l_returnflag='R' THEN -l.l_quantity ELSE l.l_quantity END AS INT) AS STRING) AS Quantity,
 {date_expr} AS InvoiceDate,
 CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS STRING) AS UnitPrice,
 CASE WHEN o.o_custkey % 10 = 0 THEN CAST(NULL AS STRING) ELSE concat(CAST(o.o_custkey AS STRING), '.0') END AS CustomerID,
 CASE WHEN c.c_nationkey = 0 THEN 'missing' ELSE n.n_name END AS Country
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN part p ON l.l_partkey=p.p_partkey
{where}
"""

# Raw online-retail source: cancelled 'C…' invoices, returns, 'nan' and
# 'missing' markers, m/d/yyyy h:mm dates, null and '451.0'-style ids.
_ONLINE_DATE = ("concat(CAST(month(o.o_orderdate) AS STRING), '/', CAST(day(o.o_orderdate) AS STRING), '/', "
               "CAST(year(o.o_orderdate) AS STRING), ' 8:26')")

# Raw order-API source: same shape, dates written MM-dd-yyyy HH:mm.
_ORDERS_DATE = ("concat(lpad(CAST(month(o.o_orderdate) AS STRING), 2, '0'), '-', "
               "lpad(CAST(day(o.o_orderdate) AS STRING), 2, '0'), '-', "
               "CAST(year(o.o_orderdate) AS STRING), ' 08:26')")


# The joins of the texts above, and for Spark the same with orders and their customers joined
# first: the lines are then shuffled by part and by order, and never by customer.
_ORDERS_OF = ("(orders o JOIN customer c ON o.o_custkey=c.c_custkey "
              "JOIN nation n ON c.c_nationkey=n.n_nationkey)")
_SMALL_FIRST = {
    """FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
JOIN part p ON l.l_partkey=p.p_partkey""":
        f"FROM lineitem l JOIN part p ON l.l_partkey=p.p_partkey JOIN {_ORDERS_OF} ON l.l_orderkey=o.o_orderkey",
    """FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN part p ON l.l_partkey=p.p_partkey""":
        f"FROM lineitem l JOIN part p ON l.l_partkey=p.p_partkey JOIN {_ORDERS_OF} ON l.l_orderkey=o.o_orderkey",
}


def _third(part: int | None) -> str:
    """The lines of one of the three sources that are merged; None: all lines."""
    return "" if part is None else f"WHERE l.l_orderkey % 3 = {part}"


RAW_RETAIL_SQL, ALL_RETAIL_SQL = (_RETAIL_TEMPLATE.format(where=_third(p)) for p in (0, None))
RAW_ONLINE_SQL, ALL_ONLINE_SQL = (_ONLINE_TEMPLATE.format(where=_third(p), date_expr=_ONLINE_DATE) for p in (1, None))
RAW_ORDERS_SQL, ALL_ORDERS_SQL = (_ONLINE_TEMPLATE.format(where=_third(p), date_expr=_ORDERS_DATE) for p in (2, None))

# Purchases of anonymous / uploaded customers (guest RFM input).
PURCHASES_SQL = """
SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'
"""

# Landed header names of the retail-sales source (fixed values of that file format).
RETAIL_SOURCE_NAMES = {
    "transaction_id": "Transaction ID",
    "date": "Date",
    "customer_id": "Customer ID",
    "gender": "Gender",
    "age": "Age",
    "category": "Product Category",
    "quantity": "Quantity",
    "unit_price": "Price per Unit",
    "total_amount": "Total Amount",
}


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    register_tables(spark, sf_dir, [t for t in TABLES if re.search(rf"\b{t}\b", text)])
    for written, small_first in _SMALL_FIRST.items():
        text = text.replace(written, small_first)
    return spark.sql(text)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, SALES_SQL)


def raw_retail(spark: SparkSession, sf_dir: str, every_line: bool = False) -> DataFrame:
    """Retail-sales source with its landed (space-separated) header names."""
    df = _sql(spark, sf_dir, ALL_RETAIL_SQL if every_line else RAW_RETAIL_SQL)
    return df.select([df[c].alias(RETAIL_SOURCE_NAMES[c]) for c in df.columns])


def raw_online(spark: SparkSession, sf_dir: str, every_line: bool = False) -> DataFrame:
    return _sql(spark, sf_dir, ALL_ONLINE_SQL if every_line else RAW_ONLINE_SQL)


def raw_orders(spark: SparkSession, sf_dir: str, every_line: bool = False) -> DataFrame:
    return _sql(spark, sf_dir, ALL_ORDERS_SQL if every_line else RAW_ORDERS_SQL)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PURCHASES_SQL)
