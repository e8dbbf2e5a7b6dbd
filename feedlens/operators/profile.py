"""Feed profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.media import image_channel


def channel_counts(df: DataFrame, channel: str = "channel_username") -> DataFrame:
    """Messages per channel in channel order; rows without a channel are not counted."""
    return (
        df.where(F.col(channel).isNotNull())
        .groupBy(channel).agg(F.count(F.lit(1)).alias("messages"))
        .orderBy(channel)
    )


def raw_vs_clean(raw: DataFrame, clean: DataFrame, channel: str = "channel_username") -> DataFrame:
    """Counts of two message tables side by side, 0 where a channel is missing.

    One grouping over the union aligns the two sides like a full outer join of their
    counts would, with one shuffle of pre-counted rows.
    """
    both = raw.select(channel, F.lit(1).alias("r"), F.lit(0).alias("c")).unionAll(
        clean.select(channel, F.lit(0).alias("r"), F.lit(1).alias("c"))
    )
    return (
        both.where(F.col(channel).isNotNull())
        .groupBy(channel)
        .agg(F.sum("r").alias("raw_count"), F.sum("c").alias("cleaned_count"))
        .orderBy(channel)
    )


def image_counts(images: DataFrame, compat: bool = False) -> DataFrame:
    """Photos (``.jpg``) per channel, from the photo names; ``compat`` takes the text
    before the first underscore as the channel."""
    return (
        images.where(F.col("image").endswith(".jpg"))
        .groupBy(image_channel("image", compat).alias("channel"))
        .agg(F.count(F.lit(1)).alias("images"))
        .orderBy("channel")
    )
