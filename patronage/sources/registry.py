"""Source registry: the three landed sources and how each is read.

A spec with a ``path`` is read from files (CSV with header, JSON with shape
dispatch, or parquet); a missing path is skipped, as an absent landed file
is.  ``fixture_sources`` binds the same specs to the derived test frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import SourceSpec
from . import fixtures as X

RETAIL = SourceSpec(name="Kaggle", date_formats=("yyyy-MM-dd",), rank=0, kind="retail")
ONLINE = SourceSpec(name="UCI", date_formats=("M/d/yyyy H:mm",), rank=1, kind="online")
ORDERS = SourceSpec(name="ORD", date_formats=("MM-dd-yyyy HH:mm",), rank=2, kind="orders")
SOURCES = (RETAIL, ONLINE, ORDERS)


def fixture_sources(spark: SparkSession, sf_dir: str) -> dict[str, tuple[SourceSpec, DataFrame]]:
    return {
        RETAIL.name: (RETAIL, X.raw_retail(spark, sf_dir)),
        ONLINE.name: (ONLINE, X.raw_online(spark, sf_dir)),
        ORDERS.name: (ORDERS, X.raw_orders(spark, sf_dir)),
    }
