"""Registered queries against their DuckDB oracles on the smallest tables."""
import os

import duckdb
import pytest

from paths import SF_SMALL

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of

# a cross-section of every layer (the full set runs in scripts/check_oracle.py)
SELECTED = [
    "a01_rfm", "p15_clean_retail", "p15_clean_online", "u01_merge_sources", "w03_fact_sales",
    "w04_dim_customer", "j07_star_join_rfm", "r01_incremental_load", "w05_quintile_scores", "w06_rank_ntiles",
    "m01_outlier_removal", "m03_yeo_johnson_fixed", "a03_rfm_full_wide", "a24_histogram_monetary",
    "a30_revenue_concentration", "a33_segment_profile", "m12_stratified_split", "m16_classification_report",
    "m25_auc_exact", "r02_stream_running_rfm", "r03_stream_segment_windows", "u04_cross_source_dedup",
    "p14_cleaning_audit_retail", "w08_qq_points", "a15_boxplot_lifespan", "a07_month_segment_counts",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SELECTED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "Recency", "Frequency", "Monetary"]
    assert df.count() > 0
