"""S02 on files that many tasks read, S11 path lists, S07 dry run."""
import json
import random

import pytest
from pyspark.sql import functions as F

from patronage.sources import files as FS
from patronage.sources import json_records as JR

HARD = ['a "quoted" {brace}', "close } ] , open { [", "back\\slash \\", 'end \\"}', "\n\t}]", "é漢}{", "", "]"]


def hard_records(n, seed=1):
    rng = random.Random(seed)
    return [{"id": str(k), "note": rng.choice(HARD), "lines": [{"sku": rng.choice(HARD), "tags": [["x}"], []]}
                                                              for _ in range(rng.randint(0, 3))],
             "nested": {"deep": {"deeper": rng.choice(HARD)}}} for k in range(n)]


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def as_dicts(df):
    return sorted((json.loads(v) for v in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toPandas()
                   .iloc[:, 0]), key=lambda r: int(r["id"]))


SCHEMA = ("id string, note string, lines array<struct<sku: string, tags: array<array<string>>>>, "
          "nested struct<deep: struct<deeper: string>>")


@pytest.mark.parametrize("shape", ["list", "carts", "orders", "behind scalars", "before arrays"])
@pytest.mark.parametrize("indent", [None, 2])
def test_a_large_array_is_read_by_many_tasks(spark, tmp_path, small_splits, shape, indent):
    recs = hard_records(700)
    payload = {"list": recs, "carts": {"carts": recs}, "orders": {"orders": recs},
               "behind scalars": {"total": 700, "name": "x", "orders": recs},
               "before arrays": {"orders": recs, "other": [{"id": "-1"}, {"id": "-2"}], "meta": {"a": [1]}}}[shape]
    path = tmp_path / "in.json"
    path.write_text(json.dumps(payload, indent=indent, ensure_ascii=bool(indent)), encoding="utf-8")
    chunks = JR._chunks(spark, [str(path)])
    assert chunks.rdd.getNumPartitions() >= 10
    got = FS.read_json_records(spark, str(path), schema=SCHEMA)
    assert as_dicts(got) == recs


def test_inferred_records_equal_the_whole_file_reader(spark, tmp_path, small_splits):
    recs = hard_records(200, 5)
    path = tmp_path / "in.json"
    path.write_text(json.dumps(recs, indent=1))
    whole = spark.read.option("multiLine", True).option("primitivesAsString", True).json(str(path))
    got = FS.read_json_records(spark, str(path))
    assert sorted(got.columns) == sorted(whole.columns)
    assert as_dicts(got.select(*whole.columns)) == as_dicts(whole)


def test_empty_arrays_and_mixed_shapes(spark, tmp_path):
    for name, payload in (("a", []), ("b", {"carts": []}), ("c", [{"id": "1"}]), ("d", {"orders": [{"id": "2"}]}),
                          ("e", {"id": "3"}), ("f", {"meta": {"x": {}}, "k": "v", "id": "4"})):
        (tmp_path / f"{name}.json").write_text(json.dumps(payload) + "\n")
    got = FS.read_json_records(spark, [f"{tmp_path}/*.json", f"{tmp_path}/c.json", f"{tmp_path}/none.json"], schema="id string")
    assert sorted(r.id for r in got.collect()) == ["1", "2", "3", "4"]
    assert FS.read_json_records(spark, f"{tmp_path}/none*.json") is None
    assert FS.read_json_records(spark, f"{tmp_path}/b.json", schema="id string").count() == 0


def test_json_to_table_once(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps({"orders": [{"id": "1"}, {"id": "2"}]}))
    src, dst = f"{tmp_path}/in.json", f"{tmp_path}/out"
    assert FS.convert_json_to_table(spark, src, dst) and spark.read.parquet(dst).count() == 2
    assert not FS.convert_json_to_table(spark, src, dst)
    assert not FS.convert_json_to_table(spark, f"{tmp_path}/none.json", f"{tmp_path}/none")


def test_overlapping_globs_read_each_file_once(spark, tmp_path):
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        for k in range(2):
            (tmp_path / folder / f"customers_{k}.csv").write_text(f"id,name\n{folder}{k},x\n")
        (tmp_path / folder / "other.csv").write_text("id,name\nno,x\n")
    globs = [f"{tmp_path}/*/customers_*.csv", f"{tmp_path}/one/customers_0.csv", f"file://{tmp_path}/two/customers_*.csv",
             f"{tmp_path}/three/customers_*.csv"]
    df = FS.read_csv(spark, globs, with_file=True)
    assert sorted((r.id, r.source_file) for r in df.collect()) == sorted(
        (f"{folder}{k}", f"customers_{k}.csv") for folder in ("one", "two") for k in range(2))
    # a folder and files in it
    assert FS.read_csv(spark, [f"{tmp_path}/one", f"{tmp_path}/one/customers_*.csv"]).count() == 3
    assert FS.expand_paths(spark, f"{tmp_path}/three/*") == []


def test_dry_run_writes_nothing(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert FS.save_table(df, "dry_run_table", dry_run=True) == "dry run: dry_run_table prepared"
    assert not spark.catalog.tableExists("dry_run_table")
    assert FS.save_table(df, "dry_run_table") == "dry_run_table" and spark.table("dry_run_table").count() == 1
    spark.sql("DROP TABLE dry_run_table")
