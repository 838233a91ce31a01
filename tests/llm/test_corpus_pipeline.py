import re

import __spark_entry__ as entry
import corpus_pipeline
import data
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm import bpe, mixing, secrets, simhash
from patronage.session import materialize

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mix", "encode"]


def test_each_stage_decides(spark):
    docs = corpus_pipeline.documents(spark, SF)
    columns, seen = docs.schema.names, {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), f"test-{name}")
        seen[name] = (docs, out)
        if name != "encode":
            assert out.schema.names == columns
        docs = out
    before, after = seen["quality"]
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    kept = {r.doc_id for r in after.collect()}
    assert len(kept & bad) <= 0.05 * len(bad) and len(kept - bad) >= 0.97 * (before.count() - len(bad)) - len(bad)
    before, after = seen["near_dedup"]
    classes = simhash.near_duplicates(before)
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in classes.collect()}
    before, after = seen["secrets"]
    assert before.count() == after.count()
    assert all(not secrets.base_spans(r.text) for r in after.collect())
    before, after = seen["mix"]
    want = {r.doc_id: len(r.copies) for r in mixing.mix(before, whole=True).collect() if r.copies}
    got = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    # the order of equal-hash rows may differ by row number only
    assert got == want
    before, after = seen["encode"]
    t = Tokenizer.from_file(bpe.WordBPE(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).path)
    texts = {r.doc_id: r.text for r in before.collect()}
    # sorted by position the rows are in training order again
    written = [r.doc_id for r in mixing.training_order(seen["mix"][0]).collect()]
    assert [r.doc_id for r in after.orderBy("position").collect()] == written
    assert after.select("position").distinct().count() == len(written)
    assert all(r.ids == t.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
               for r in after.collect())


def test_positions_of_rows_from_files_and_from_none(spark, tmp_path):
    rows = spark.range(1000).repartitionByRange(8, F.desc("id")).sortWithinPartitions(F.desc("id"))
    rows.write.parquet(str(tmp_path / "rows"))
    for df in (spark.read.parquet(str(tmp_path / "rows")), rows):
        got = [r.id for r in corpus_pipeline.with_position(df).orderBy("position").collect()]
        assert got == list(range(999, -1, -1))


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (data.clashing(data.documents(spark)), data.empty(spark)):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, rows, SF), f"test-odd-{name}")
            if name != "encode":
                assert out.schema.names == docs.schema.names
            rows = out
        assert set(rows.schema.names) >= {"doc_id", "ids", "n_tokens"}
