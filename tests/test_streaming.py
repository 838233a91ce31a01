import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.streaming import streams as ST

SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
D = dt.datetime


def _land(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _counts(spark, path, where, delay):
    labels = spark.createDataFrame([(1, "A"), (2, "B")], "user_id long, Segment string")
    stream = ST.file_stream(spark, path, SCHEMA)
    out = ST.run_available(ST.windowed_segment_counts(stream, labels, "user_id", "ts", delay=delay), where,
                           mode="update")
    final = ST.latest_per_key(spark.read.parquet(out), ["window_start", "window_end", "Segment"])
    return {(r.window_start.day, r.Segment): r["count"] for r in final.collect()}


def test_late_rows_count_only_within_the_watermark(spark):
    first = [(1, D(2024, 1, 10, 10), 1, 1.0), (2, D(2024, 1, 10, 11), 2, 1.0), (3, D(2024, 1, 20, 10), 1, 1.0)]
    late = [(4, D(2024, 1, 10, 12), 1, 1.0), (5, D(2024, 1, 20, 8), 1, 1.0)]
    on_time = {(10, "A"): 1, (10, "B"): 1, (20, "A"): 2}
    for delay, want in (("1 day", on_time), ("30 days", on_time | {(10, "A"): 2})):
        path, where = ST.new_location(spark, "late-in"), ST.new_location(spark, "late")
        _land(spark, first, path)
        _counts(spark, path, where, delay)
        _land(spark, late, path)  # behind a watermark of one day, within one of thirty
        assert _counts(spark, path, where, delay) == want


def test_restart_goes_on_where_the_query_stopped(spark):
    path, where = ST.new_location(spark, "restart-in"), ST.new_location(spark, "restart")
    rows = [(i, D(2024, 1, 1 + i % 20, 8), i % 7, float(i)) for i in range(200)]

    def run():
        agg = ST.running_rfm_stream(ST.file_stream(spark, path, SCHEMA), "user_id", "ts", "event_id", "value")
        return ST.run_available(agg, where, mode="update", conf=ST.ROCKSDB)

    _land(spark, rows[:120], path)
    run()
    _land(spark, rows[100:], path)  # 20 rows come again
    out = run()
    assert run() == out  # nothing new: nothing changes
    batch = spark.createDataFrame(rows, SCHEMA).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("Frequency"), F.sum("value").alias("Monetary"))
    key = lambda df: {r.user_id: (r.Frequency, r.Monetary) for r in df.collect()}
    assert key(ST.read_running_rfm(spark, out, "user_id")) == key(batch)


def test_a_batch_that_runs_twice_is_written_once(spark):
    path, where = ST.new_location(spark, "twice-in"), ST.new_location(spark, "twice")
    _land(spark, [(1, D(2024, 1, 1), 1, 1.0)], path)
    stream = ST.file_stream(spark, path, SCHEMA)

    def again(batch, batch_id):  # the first attempt wrote before it failed
        batch.write.mode("overwrite").parquet(f"{where}/out/batch_id={batch_id}")
        return batch
    assert spark.read.parquet(ST.run_available(stream, where, batch_fn=again)).count() == 1


def test_stream_dedup_and_running_rfm_equal_batch(spark):
    path = ST.new_location(spark, "dup-in")
    rows = [(i, D(2024, 1, 1 + i % 20, 8), i % 7, float(i)) for i in range(200)]
    _land(spark, rows, path)
    _land(spark, rows[:50], path)  # re-delivered copies
    stream = ST.file_stream(spark, path, SCHEMA, max_files=1)
    agg = ST.running_rfm_stream(stream, "user_id", "ts", "event_id", "value")
    out = ST.run_available(agg, ST.new_location(spark, "dup"), mode="update", conf=ST.ROCKSDB)
    got = ST.read_running_rfm(spark, out, "user_id")
    batch = spark.createDataFrame(rows, SCHEMA).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("Frequency"), F.sum("value").alias("Monetary"))
    a = {r.user_id: (r.Frequency, r.Monetary) for r in got.collect()}
    b = {r.user_id: (r.Frequency, r.Monetary) for r in batch.collect()}
    assert a == b


def _rfm_in_turns(spark, turns, **kw):
    """Land and run turn after turn at one location; the totals at the end."""
    path, where = ST.new_location(spark, "turns-in"), ST.new_location(spark, "turns")
    for rows in turns:
        _land(spark, rows, path)
        agg = ST.running_rfm_stream(ST.file_stream(spark, path, SCHEMA), "user_id", "ts", "event_id", "value", **kw)
        out = ST.run_available(agg, where, mode="update", conf=ST.ROCKSDB)
    return {r.user_id: (r.Recency, r.Frequency, r.Monetary) for r in ST.read_running_rfm(spark, out, "user_id").collect()}


def test_a_transaction_that_returns_after_months_counts_once(spark):
    first = [(1, D(2024, 1, 1, 8), 1, 5.0), (2, D(2024, 1, 2, 8), 1, 7.0), (3, D(2024, 1, 2, 8), 2, 1.0)]
    other = [(4, D(2024, 4, 1, 8), 2, 2.0), (None, D(2024, 4, 1, 8), 2, 0.5), (5, D(2024, 4, 1, 8), None, 1.5)]
    again = [(1, D(2024, 1, 1, 8), 1, 5.0), (1, D(2024, 5, 1, 8), 1, 5.0), (6, D(2024, 1, 3, 8), 1, 1.0)]
    got = _rfm_in_turns(spark, [first, other, again], pieces=2)
    # 6 is new and far behind the latest event: it counts, since nothing is late without ``remember``
    assert got == {1: (89, 3, 13.0), 2: (0, 3, 3.5), None: (0, 1, 1.5)}


def test_a_remembered_transaction_expires_by_event_time(spark):
    turns = [[(1, D(2024, 1, 1), 1, 1.0), (2, D(2024, 1, 20), 1, 1.0)],
             [(1, D(2024, 1, 31), 1, 1.0)],               # 30 days on: remembered
             [(9, D(2024, 6, 1), 2, 1.0)], [(9, D(2024, 6, 2), 2, 1.0)],  # time goes on
             [(1, D(2024, 6, 3), 1, 1.0)]]                # months on: forgotten
    got = _rfm_in_turns(spark, turns, remember="60 days", pieces=1)
    assert got == {1: (0, 3, 3.0), 2: (2, 1, 1.0)}


def test_a_customer_with_most_rows_is_spread_over_pieces(spark):
    rows = [(i, D(2024, 1, 1 + i % 20, 8), 0 if i % 2 else i, 1.0) for i in range(2000)]
    path, where = ST.new_location(spark, "hot-in"), ST.new_location(spark, "hot")
    _land(spark, rows, path)
    agg = ST.running_rfm_stream(ST.file_stream(spark, path, SCHEMA), "user_id", "ts", "event_id", "value", pieces=8)
    out = ST.run_available(agg, where, mode="update", conf=ST.ROCKSDB)
    held = [r.Frequency for r in spark.read.parquet(out).where("user_id = 0").collect()]
    assert len(held) == 8 and sum(held) == 1001 and max(held) < 200


def test_totals_that_forget_nothing_are_added_up_without_python(spark, capsys):
    path = ST.new_location(spark, "plan-in")
    rows = [(1, D(2024, 1, 1, 8), 1, 5.0), (1, D(2024, 1, 2, 8), 1, 5.0), (None, D(2024, 1, 3, 8), 1, 1.0),
            (None, D(2024, 1, 3, 8), 1, float("nan"))]
    _land(spark, rows, path)
    agg = ST.running_rfm_stream(ST.file_stream(spark, path, SCHEMA), "user_id", "ts", "event_id", "value")
    agg.explain(True)
    plan = capsys.readouterr().out
    assert "Deduplicate" in plan and "Pandas" not in plan
    out = ST.run_available(agg, ST.new_location(spark, "plan"), mode="update", conf=ST.ROCKSDB)
    assert [(r.Frequency, r.Monetary) for r in ST.read_running_rfm(spark, out, "user_id").collect()] == [(3, 6.0)]
