"""R01 on a stored warehouse, and group writes of bounded size."""
import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from patronage.operators import increment as INC
from patronage.operators import warehouse as WH
from patronage.sources import files as FS

LINES = ("transaction_id string, date date, customer_id string, gender string, age int, country string, "
         "category string, quantity int, unit_price double, total_amount double")


def lines(spark, months, per_month=20, first=0):
    rows = [(str(first + m * per_month + k), dt.date(2024, m, 1 + k % 28), "0" if k % 2 else f"c{k}", "Male", 30, "X",
             f"g{k % 3}", 1, 2.0, 2.0) for m in months for k in range(per_month)]
    return spark.createDataFrame(rows, LINES)


def store(spark, tmp_path, df):
    return INC.create_store(WH.build_warehouse(df), f"{tmp_path}/store")


def keyed(wh, df):
    customers = wh.dim_customer.select("customer_id", "customer_key")
    return (df.join(customers, "customer_id", "left").join(wh.dim_category, "category", "left")
            .join(wh.dim_date.select("date", "date_id"), "date", "left")
            .withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)"))
            .withColumn("total_amount", F.col("total_amount").cast("decimal(15,2)"))
            .withColumn("month", INC.month_of("date")).withColumn("key_hash", INC.key_hash()))


def test_a_load_reads_only_the_months_of_its_batch(spark, tmp_path):
    wh = store(spark, tmp_path, lines(spark, range(1, 13)))
    old = wh.loaded_like(keyed(wh, lines(spark, [3, 5])))
    assert old.count() == 40
    plan = old._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "PartitionFilters: [month" in x]
    assert len(scans) == 1 and "sales_id" not in scans[0]
    # other months aren't opened: their files may hold anything
    for f in glob.glob(f"{tmp_path}/store/fact_sales/month=*/*.parquet"):
        if "month=2024-03" not in f and "month=2024-05" not in f:
            with open(f, "wb") as broken:
                broken.write(b"no parquet")
            os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    assert old.count() == 40
    with pytest.raises(Exception, match="parquet"):
        wh.fact_sales.count()


def test_reload_adds_nothing_and_new_lines_go_on(spark, tmp_path):
    first = lines(spark, [1, 2, 3])
    wh = store(spark, tmp_path, first)
    assert wh.fact_sales.count() == 60
    again = wh.load(first)
    assert again.fact_sales.count() == 60 and again.dim_customer.count() == wh.dim_customer.count()
    new = spark.createDataFrame([("900", dt.date(2025, 7, 1), "new", "Female", 20, "Y", "g9", 1, 1.0, 1.0),
                                 ("900", dt.date(2025, 7, 1), "new", "Female", 20, "Y", "g9", 1, 1.0, 1.0),
                                 ("901", None, None, None, None, None, None, None, None, None)], LINES)
    more = again.load(first.unionByName(new))
    rows = more.fact_sales.where("transaction_id >= '900'").collect()
    assert more.fact_sales.count() == 63 and sorted(r.sales_id for r in rows) == [61, 62, 63]
    assert {r.customer_key for r in rows} == {more.dim_customer.where("customer_id = 'new'").first().customer_key, None}
    assert more.load(first.unionByName(new)).fact_sales.count() == 63
    # as opened by another session
    assert INC.open_store(spark, f"{tmp_path}/store").fact_sales.count() == 63
    assert {r.table_name: (r.null_keys, r.repeated_keys, r.as_declared) for r in WH.schema_checks(more).collect()} == {
        t: (0, 0, True) for t in WH.PRIMARY_KEYS}
    assert all(r.orphans == 0 for r in WH.referential_checks(
        WH.Warehouse(more.dim_date, more.dim_category, more.dim_location, more.dim_customer,
                     more.fact_sales.where("transaction_id <> '901'"))).collect())


def test_a_load_that_failed_before_its_lines_may_run_again(spark, tmp_path, monkeypatch):
    wh = store(spark, tmp_path, lines(spark, [1]))
    more = lines(spark, [2], first=500)

    def fail(*args, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(INC, "write_groups", fail)
        with pytest.raises(RuntimeError):
            wh.load(more)
    again = INC.open_store(spark, f"{tmp_path}/store").load(more)
    ids = [r.sales_id for r in again.fact_sales.collect()]
    assert len(ids) == 40 and len(set(ids)) == 40  # reserved keys are skipped, none comes twice
    assert again.dim_date.groupBy("date").count().where("count > 1").count() == 0


def test_an_equal_hash_alone_is_not_a_loaded_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(INC, "key_hash", lambda cols=INC.LINE_KEY: F.lit(7).cast("long"))
    wh = store(spark, tmp_path, lines(spark, [1]))
    assert wh.load(lines(spark, [1], first=1000)).fact_sales.count() == 40


def test_a_store_may_begin_empty(spark, tmp_path):
    wh = store(spark, tmp_path, spark.createDataFrame([], LINES))
    loaded = wh.load(lines(spark, [4]))
    assert sorted(r.sales_id for r in loaded.fact_sales.collect()) == list(range(1, 21))


def _files(path):
    out = {}
    for f in glob.glob(f"{path}/*/*.parquet"):
        out.setdefault(os.path.basename(os.path.dirname(f)), []).append(pq.ParquetFile(f).metadata.num_rows)
    return out


def test_groups_are_written_in_files_of_bounded_size(spark, tmp_path):
    # one group with most rows, many small ones, a null one; rows come from many tasks
    df = spark.range(30_000).repartition(16).select(
        "id", F.when(F.col("id") < 20_000, "hot").when(F.col("id") < 29_000, F.concat(F.lit("g"), (F.col("id") % 9)
                                                                                     .cast("string"))).alias("grp"))
    FS.write_groups(df, f"{tmp_path}/out", ["grp"], rows_per_file=2_000)
    files = _files(f"{tmp_path}/out")
    assert max(max(n) for n in files.values()) <= 2_000
    assert 10 <= len(files["grp=hot"]) <= 20 and all(len(n) == 1 for g, n in files.items() if g != "grp=hot")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 30_000 and back.where("grp is null").count() == 1_000
    FS.write_groups(df.limit(0), f"{tmp_path}/none", ["grp"])
    assert _files(f"{tmp_path}/none") == {}


def test_group_files_as_csv(spark, tmp_path):
    FS.write_groups(spark.createDataFrame([(1, "a"), (2, "b")], "id int, grp string"), f"{tmp_path}/csv", ["grp"], fmt="csv")
    assert sorted(os.listdir(f"{tmp_path}/csv"))[-2:] == ["grp=a", "grp=b"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
