"""Landed messages -> clean and preprocessed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedlens.operators.cleaning import clean_messages, message_record, preprocess_messages
from feedlens.operators.topn import latest_n_per_channel
from feedlens.sources.tables import write_messages, write_table


def backfill(landed: DataFrame, media_folder: str, n: int | None = None) -> DataFrame:
    """All messages as message records; with ``n`` only the newest ``n`` of each channel."""
    return message_record(landed if n is None else latest_n_per_channel(landed, n), media_folder)


def clean_and_preprocess(raw: DataFrame, script: str = "ethiopic") -> DataFrame:
    return preprocess_messages(clean_messages(raw), script)


def run_feed(
    landed: DataFrame, media_folder: str, out: str, fmt: str = "parquet", n: int | None = None
) -> None:
    """Write the ``raw``, ``clean`` and ``preprocessed`` message tables below ``out``; the
    last two under the message file's own column names. All landed messages are taken,
    unless ``n`` asks for the newest of each channel."""
    spark = landed.sparkSession
    write_table(backfill(landed, media_folder, n), f"{out}/raw")
    raw = spark.read.parquet(f"{out}/raw")
    write_messages(clean_messages(raw), f"{out}/clean", fmt)
    write_messages(clean_and_preprocess(raw), f"{out}/preprocessed", fmt)
