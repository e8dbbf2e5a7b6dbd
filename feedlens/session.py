"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "feedlens", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Tables stored by a column of few values: keep one open file per value, so that
        # the rows need no sort before the write.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        # A long-running dedup keeps one state row per key: keep it off the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; a cluster session
    without it is refused, because a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_dirs:
        _local_dirs[app_id] = tempfile.mkdtemp(prefix="feedlens-")
    return _local_dirs[app_id]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/feedlens/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage so that a lost executor does not recompute the input, keeps column
    pruning, and gives Catalyst a true size for its join choice.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
