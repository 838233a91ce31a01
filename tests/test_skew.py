"""Heavy keys in stored star joins."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronage.operators import skew as SK
from patronage.operators import warehouse as WH

LINES = ("transaction_id string, date date, customer_id string, gender string, age int, country string, "
         "category string, quantity int, unit_price double, total_amount double")
BUCKETS = 8


@pytest.fixture(scope="module")
def stored(spark):
    day = dt.date(2024, 1, 1)
    rows = [(str(k), day + dt.timedelta(k % 50), "0" if k % 2 else f"c{k % 400}", "Male", 30, "X", f"g{k % 3}", 1, 2.0,
             2.0 if k % 10 else -2.0) for k in range(8000)]  # half of all lines are the guest's
    wh = WH.build_warehouse(spark.createDataFrame(rows, LINES))
    yield wh, WH.persist_warehouse(wh, "skew_wh", buckets=BUCKETS)
    spark.sql("DROP DATABASE skew_wh CASCADE")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("join", [WH.star_join_rfm, WH.star_join_dates, WH.star_join_categories])
def test_stored_star_joins_equal_the_plain_ones(stored, join):
    plain, kept = stored
    assert _rows(join(kept)) == _rows(join(plain))


def test_no_bucket_holds_all_lines_of_the_guest(spark, stored):
    _, kept = stored
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = kept.fact_with_customers()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # joined bucket by bucket: neither side is shuffled
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == 8000 and len(tasks) == BUCKETS
    assert max(tasks) < 2.5 * 8000 / BUCKETS  # 4,000 or more with the guest in one bucket


def test_heavy_keys_are_few_and_measured(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(1,)] * 30 + [(k,) for k in range(2, 22)] + [(None,)] * 20, "k int")
    got = {r.k: r.salts for r in SK.heavy_keys(df, "k", 10).collect()}
    assert got == {0: 5, 1: 3}  # of 120 rows in 10 shares of 12
    assert SK.heavy_keys(df.limit(0), "k", 10).count() == 0
    rows, dim = SK.cut_by_salt(df.withColumn("id", F.monotonically_increasing_id()),
                               spark.range(22).select(F.col("id").cast("int").alias("k")), "k", "id", 10)
    assert dim.where("k = 0").count() == 5 and dim.where("k = 7").count() == 1
    assert rows.count() == 120 and rows.join(dim, ["k", SK.SALT]).count() == 100
