"""End-to-end run from landed files (CSV + JSON) written from the fixtures."""
import dataclasses
import json

from pyspark.sql import functions as F

from paths import SF_SMALL
from patronage.plans.pipeline import run_pipeline
from patronage.sources import files as FS
from patronage.sources import fixtures as X
from patronage.sources.registry import ONLINE, ORDERS, RETAIL


def test_pipeline_from_landed_files(spark, tmp_path):
    FS.write_stage(X.raw_retail(spark, SF_SMALL), str(tmp_path / "retail"), fmt="csv")
    FS.write_stage(X.raw_online(spark, SF_SMALL), str(tmp_path / "online"), fmt="csv")
    orders = [r.asDict() for r in X.raw_orders(spark, SF_SMALL).collect()]  # small fixture file
    (tmp_path / "orders.json").write_text(json.dumps({"orders": orders}))
    specs = (dataclasses.replace(RETAIL, path=str(tmp_path / "retail")),
             dataclasses.replace(ONLINE, path=str(tmp_path / "online")),
             dataclasses.replace(ORDERS, path=str(tmp_path / "orders.json"), fmt="json"),
             dataclasses.replace(ORDERS, name="missing", path=str(tmp_path / "nope.csv")))
    res = run_pipeline(spark, specs, out_dir=str(tmp_path / "out"), k=2, n_init=2)
    audit = {r.source: r for r in res.audit.collect()}
    assert set(audit) == {"Kaggle", "UCI", "ORD"}
    assert sum(r.rows_out for r in audit.values()) == res.merged.count()
    assert res.warehouse.fact_sales.count() == res.merged.count()
    assert set(r.Segment for r in res.labeled.select("Segment").distinct().collect()) <= {"Diamond", "Standard"}
    assert res.rfm.where(F.col("Recency") < 1).count() == 0
    ids = spark.read.parquet(res.outputs["segment_ids"])
    assert ids.count() == res.labeled.count()
