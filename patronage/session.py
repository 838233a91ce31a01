"""Spark session defaults and lineage cuts.

The session is configured for AQE (runtime coalescing, skew-join splitting
and broadcast conversion by measured size), UTC time and ANSI SQL.  Lineage is
cut only with reliable checkpoints under ``spark.checkpoint.dir``; a local
folder is chosen only when that setting is absent *and* the master is local
(tests, laptops).  On a cluster an unset checkpoint folder is an error.
"""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Size-checked broadcast: Spark broadcasts a join side only when its
    # measured (AQE) or estimated size is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(
    master: str | None = None,
    app_name: str = "patronage",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        settings.setdefault("spark.ui.enabled", "false")
        settings.setdefault("spark.ui.showConsoleProgress", "false")
        settings.setdefault("spark.driver.memory", "6g")
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    atexit.register(_drop_at_exit, spark)
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           cores: int | None = None, minimum: int = 8) -> int:
    """Initial ``spark.sql.shuffle.partitions`` for an input size: enough
    partitions that each shuffle block stays near ``target_bytes`` (fits in
    executor memory without spilling hard), rounded up to a multiple of the
    core count so waves are full.  AQE then coalesces small partitions and
    splits skewed ones at run time (e.g. 100 TB -> ~400k before coalescing)."""
    n = max(minimum, -(-int(input_bytes) // int(target_bytes)))
    if cores:
        n = -(-n // cores) * cores
    return n


def scale_conf(input_bytes: int, cores: int, target_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster run, to pass as ``get_session(conf=...)``."""
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(input_bytes, target_bytes, cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_bytes),
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at ``spark.checkpoint.dir`` (shared storage).

    Only when the setting is missing and the master is local do we pick a
    fresh temporary folder, as tests do.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset runtime conf raises
            path = None
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running jobs that cut lineage"
            )
        path = tempfile.mkdtemp(prefix="patronage-ckpt-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():  # type: ignore[union-attr]
        if _is_local(spark):
            os.makedirs(path, exist_ok=True)
        sc.setCheckpointDir(path)
    return path


def stage_root(spark: SparkSession) -> str:
    """The application's own folder for stage tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/patronage-stages/{spark.sparkContext.applicationId}"


def drop_stages(spark: SparkSession) -> None:
    """Delete the application's stage tables, when no result that reads them is
    needed any more; ``get_session`` does so when the process ends."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()  # type: ignore[union-attr]
    path = jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    path.getFileSystem(conf).delete(path, True)


def _drop_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:  # the session may be stopped already
        drop_stages(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet stage table in the shared checkpoint folder
    and read it back: cuts lineage (survives executor loss), and later passes
    get column pruning and filter pushdown, which an RDD checkpoint lacks."""
    import uuid

    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame, name: str, rows_per_task: int = 20_000) -> DataFrame:
    """A stage table dealt evenly over files for passes made many times (model fits).

    A staged aggregate lies in a few files of one row group each, however many
    cores there are, and every pass would run as that many tasks.  Tables of up
    to ``rows_per_task`` rows stay as they are."""
    rows = df.count()  # from the files' footers
    if rows <= rows_per_task:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-rows // rows_per_task), max(2 * cores, -(-rows // 500_000)))
    return materialize(df.repartition(tasks), name)
