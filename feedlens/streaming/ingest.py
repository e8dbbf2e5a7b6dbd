"""Messages that keep arriving in a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedlens.operators.cleaning import channel_filter, message_record, same_channel_name
from feedlens.streaming.seen import BUCKET_IDS, FirstRows


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of an append-only folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def ingest(
    landing: DataFrame, media_folder: str, channels: list[str] | DataFrame | None = None
) -> DataFrame:
    """Each new message of the listed channels -> one normalised row. Stateless.

    Live messages carry names without ``@``, so names are compared in one spelling.
    """
    rows = landing if channels is None else channel_filter(landing, channels, literal=False)
    return message_record(rows, media_folder)


def first_of_each(messages: DataFrame) -> DataFrame:
    """The first row that arrives of every (channel, id), with bounded state and no watermark.

    The state is a set of id intervals per channel and bucket of ids: ids without gaps take one
    small row per ``BUCKET_IDS`` of them, and a channel with a third of all messages is spread
    over its buckets. Rows without an id are one message per channel. Stateful operators of
    this kind need the RocksDB state store, so the session's is set to it.
    """
    messages.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    bucket = F.floor(F.col("id") / BUCKET_IDS).cast("bigint")
    return (
        messages.withColumn("_bucket", bucket)
        .groupBy("channel_username", "_bucket")
        .transformWithState(FirstRows(), messages.schema, "Append", "None")
    )


def backfill_then_follow(
    backfill: DataFrame, live: DataFrame, delay: str | None = None, time_column: str = "timestamp"
) -> DataFrame:
    """Both feeds as one stream in which every (channel, id) appears once.

    Without ``delay`` nothing is ever lost or repeated, however late it comes (see
    ``first_of_each``). With ``delay`` the state forgets keys older than that, which is only
    right when messages are never later than ``delay``.
    """
    both = same_channel_name(backfill).unionByName(same_channel_name(live))
    if delay is None:
        return first_of_each(both)
    return both.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["channel_username", "id"])


def append_to(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Append the stream to a table; ``once`` takes what has landed and stops."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
