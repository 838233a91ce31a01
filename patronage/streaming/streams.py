"""Streaming RFM, windowed segment counts, de-duplication and scoring.

* Sources are file streams over landed parquet (one folder per day).
* De-duplication is bounded by a watermark (``dropDuplicatesWithinWatermark``)
  so state does not grow forever.
* Running RFM keeps totals per customer and piece of a customer and the counted
  transactions (``dropDuplicates`` and an aggregate; where transactions are
  forgotten again, ``transformWithState``: map state in RocksDB, event-time
  timers) and emits only changed ones per micro-batch (update mode); each batch
  is appended with its batch id, and readers add up the latest rows — an
  aggregate, never a rewrite of all customers.
* The caller names a query's location; its checkpoint and output live there,
  so the query started again at the same place goes on where it stopped.  A
  micro-batch owns the folder of its id and overwrites it: one that runs twice
  is written once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.exprs import days_between
from ..session import stage_root


#: ``transformWithState`` keeps its maps in this store.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh place for a query under the shared checkpoint folder."""
    return f"{stage_root(spark)}/stream-{name}-{uuid.uuid4().hex}"


def land_by_day(df: DataFrame, ts: str, path: str, mode: str = "append") -> str:
    """Write rows as landed files, one folder per event day (the stream source)."""
    df.withColumn("day", F.to_date(F.col(ts))).write.mode(mode).partitionBy("day").parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (session time zone); landed NTZ values are cast."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def dedup_stream(stream: DataFrame, key: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Drop repeats of ``key`` arriving within the watermark delay."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


class _RunningTotals(StatefulProcessor):
    """Totals of one piece of a customer and the transactions it has counted.

    ``seen`` is a map of its own rows in the state store, so a customer with
    many transactions is never read whole.  A transaction is forgotten
    ``remember_ms`` after its time: an event-time timer, one at a time for
    each piece, removes what has expired."""

    def __init__(self, customer: str, ts: str, txn: str, amount: str, amount_type: str, remember_ms: int):
        self.customer, self.ts, self.txn, self.amount = customer, ts, txn, amount
        self.amount_type, self.remember_ms = amount_type, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "txn string", "at long")
        self.totals = handle.getValueState("totals", f"last_ts timestamp, n long, amount {self.amount_type}")

    def handleInputRows(self, key, rows, timerValues):  # noqa: ANN001, ANN201, N802, N803 - the interface's names
        last, n, amount = self.totals.get() if self.totals.exists() else (None, 0, None)
        newest, changed = None, False
        for batch in rows:
            for txn, ts, value in zip(batch[self.txn], batch[self.ts], batch[self.amount]):
                name = None if pd.isna(txn) else str(txn)
                if name is not None:
                    if self.seen.containsKey((name,)):
                        continue
                    at = 0 if pd.isna(ts) else int(pd.Timestamp(ts).timestamp() * 1000)
                    self.seen.updateValue((name,), (at,))
                    newest = at if newest is None else max(newest, at)
                changed = True
                n += 1
                if not pd.isna(ts) and (last is None or pd.Timestamp(ts) > pd.Timestamp(last)):
                    last = pd.Timestamp(ts).to_pydatetime()
                if not pd.isna(value):
                    amount = value if amount is None else amount + value
        if not changed:
            return
        self.totals.update((last, n, amount))
        if newest is not None and not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(newest + self.remember_ms)
        yield pd.DataFrame([(*key, last, n, amount)], columns=[self.customer, "piece", "last_ts", "Frequency", "Monetary"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: ANN001, ANN201, N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        left = None
        for (name,), (at,) in list(self.seen.iterator()):
            if at + self.remember_ms <= now:
                self.seen.removeKey((name,))
            else:
                left = at if left is None else max(left, at)
        if left is not None:
            self.handle.registerTimer(left + self.remember_ms)
        return iter(())

    def close(self) -> None:
        pass


def running_rfm_stream(stream: DataFrame, customer: str, ts: str, txn: str, amount: str, pieces: int = 16,
                       remember: str | None = None, delay: str = "1 day") -> DataFrame:
    """Per-customer last time, distinct transactions, spend (update mode).

    A transaction counts once however late it comes again: each customer keeps
    the transactions it has counted (rows without a transaction id count each).
    A customer's state lies in ``pieces``, dealt by transaction, so no task holds
    all of a customer with a third of the rows; ``read_running_rfm`` adds them up.
    Without ``remember`` nothing is dropped or forgotten: repeats are dropped by
    their ids and an aggregate adds up the rest.  With it (``"400 days"``)
    a transaction is forgotten that long after its time, and rows that are
    ``delay`` behind the latest event are late and dropped, so the state is bounded.
    The query needs ``ROCKSDB`` (``run_available(conf=ROCKSDB)``)."""
    rows = event_time(stream, ts)
    spark = stream.sparkSession
    if remember is not None:
        rows = rows.withWatermark(ts, delay)
    kind = rows.schema[amount].dataType
    kind = T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else (
        T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType())
    rows = rows.select(customer, ts, txn, F.col(amount).cast(kind).alias(amount),
                       F.pmod(F.xxhash64(F.col(txn)), F.lit(pieces)).cast("int").alias("piece"))
    if remember is None:
        value = F.when(~F.isnan(amount), F.col(amount)) if isinstance(kind, T.DoubleType) else F.col(amount)
        # rows without an id are no repeats of each other
        own = F.when(F.col(txn).isNull(), F.uuid())
        once = rows.withColumn("_own", own).dropDuplicates([customer, txn, "_own"])
        return once.groupBy(customer, "piece").agg(F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("Frequency"),
                                                   F.sum(value).cast(kind).alias("Monetary"))
    remember_ms = int(spark.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {remember})").first()[0])
    totals = _RunningTotals(customer, ts, txn, amount, kind.simpleString(), remember_ms)
    out = T.StructType([rows.schema[customer], T.StructField("piece", T.IntegerType()),
                        T.StructField("last_ts", T.TimestampType()), T.StructField("Frequency", T.LongType()),
                        T.StructField("Monetary", kind)])
    return rows.groupBy(customer, "piece").transformWithStateInPandas(
        totals, out, "Update", "EventTime")


def run_available(stream_df: DataFrame, location: str, mode: str = "append",
                  batch_fn: Callable[[DataFrame, int], DataFrame] | None = None,
                  conf: dict[str, str] | None = None) -> str:
    """Run a streaming query over everything available, then stop; returns the
    output folder.  Run again with the same location it takes what is new.
    ``conf`` holds while the query runs.

    Output goes through ``foreachBatch``: each micro-batch overwrites the
    folder of its id (``batch_fn`` may transform it first)."""
    location = location.rstrip("/")
    out = f"{location}/out"

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch_fn(batch, batch_id) if batch_fn else batch
        b.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    own = stream_df.sparkSession.conf
    before = {k: own.get(k, None) for k in conf or {}}
    try:
        for k, v in (conf or {}).items():
            own.set(k, v)
        q = (stream_df.writeStream.outputMode(mode).option("checkpointLocation", f"{location}/checkpoint")
             .foreachBatch(sink).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            own.unset(k) if v is None else own.set(k, v)
    return out


def latest_per_key(changes: DataFrame, key: str | list[str], order: str = "batch_id") -> DataFrame:
    """Current state from an append-only change table: last row per key."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in changes.columns if c not in (*keys, order)]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_s")).select(
        *keys, *[F.col(f"_s.{c}").alias(c) for c in cols])


def read_running_rfm(spark: SparkSession, out: str, customer: str) -> DataFrame:
    """The customers' totals over their pieces; recency is computed at read time
    against the latest event seen."""
    pieces = latest_per_key(spark.read.parquet(out), [customer, "piece"])
    state = pieces.groupBy(customer).agg(F.max("last_ts").alias("last_ts"), F.sum("Frequency").alias("Frequency"),
                                         F.sum("Monetary").alias("Monetary"))
    ref = state.select(F.max("last_ts")).scalar()
    return state.select(customer, days_between(ref, "last_ts").alias("Recency"),
                        F.col("Frequency").cast("bigint"), "Monetary")


def windowed_segment_counts(stream: DataFrame, labels: DataFrame, key: str, ts: str, segment: str = "Segment",
                            window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Event-time tumbling windows x segment; the watermark drops late
    rows and bounds the state.  Append mode emits a window once it closes;
    update mode (with ``latest_per_key`` on the output) also reports windows
    still open at the end of a bounded input.  ``labels`` is a static
    frame joined to the stream (stream-static join)."""
    joined = event_time(stream, ts).withWatermark(ts, delay).join(labels.select(key, segment), key, "left")
    return (joined.groupBy(F.window(ts, window).alias("w"), segment).agg(F.count(F.lit(1)).alias("count"))
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), segment,
                          F.col("count").cast("bigint")))


def score_batches(model, mapping: DataFrame | None = None) -> Callable[[DataFrame, int], DataFrame]:
    """Micro-batch scoring with a fitted ``PipelineModel`` (+ tier names)."""
    from ..operators.cluster import label_customers

    def fn(batch: DataFrame, _batch_id: int) -> DataFrame:
        return label_customers(model, batch, mapping).select("customer_id", "Cluster", "Segment")
    return fn
