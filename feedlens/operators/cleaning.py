"""Filters, projections and defaults on message tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.labels import label_message
from feedlens.functions.media import media_path
from feedlens.functions.numbers import NUMBER
from feedlens.functions.spans import tag_spans
from feedlens.functions.text import (
    NOT_WS, canonical_username, normalize_ws, preprocess_message, text_or_empty,
)
from feedlens.schemas import ENTITY


def message_record(df: DataFrame, media_folder: str) -> DataFrame:
    """Raw message -> the six-column record with normalised text (never NULL)."""
    return df.select(
        "channel_title",
        "channel_username",
        "id",
        normalize_ws(text_or_empty("message")).alias("message"),
        "date",
        media_path(F.col("has_photo"), "channel_username", "id", media_folder).alias("media_path"),
    )


def clean_messages(df: DataFrame) -> DataFrame:
    """Drop messages without text and normalise the whitespace of the others. Narrow;
    works on a stream.

    The filter looks for one visible character; a filter on the normalised text would
    normalise every message twice.
    """
    return df.where(F.col("message").rlike(NOT_WS)).withColumn("message", normalize_ws("message"))


def drop_null_text(df: DataFrame, column: str = "message") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def preprocess_messages(df: DataFrame, script: str = "ethiopic") -> DataFrame:
    return df.withColumn("message", preprocess_message("message", script))


def parse_timestamp(df: DataFrame, column: str = "date", out: str = "timestamp") -> DataFrame:
    """Parse dates and drop rows whose date cannot be read."""
    return df.withColumn(out, F.try_to_timestamp(F.col(column))).where(F.col(out).isNotNull())


def vendor_column(df: DataFrame) -> DataFrame:
    return df.withColumn("vendor", F.col("channel_title"))


def hashed_views(id_: Column) -> Column:
    """A stable stand-in for missing view counts: 50 to 5000, from the md5 of the id."""
    digits = F.substring(F.md5(id_.cast("string")), 1, 6)
    return F.conv(digits, 16, 10).cast("bigint") % 4951 + 50


def default_views(df: DataFrame) -> DataFrame:
    return df if "views" in df.columns else df.withColumn("views", hashed_views(F.col("id")))


def default_entities(
    df: DataFrame,
    column: str = "message",
    marks: list[str] | None = None,
    places: list[str] | None = None,
) -> DataFrame:
    """Fill a missing ``entities`` column from the rule labeller: one record per span.

    A product's price is the first plain number the message is tagged with as a price.
    """
    if "entities" in df.columns:
        return df
    labeled = F.transform(
        F.array(label_message(column, marks, places)),
        lambda lt: entities_of(lt),
    )
    return df.withColumn("entities", F.get(labeled, F.lit(0)))


def entities_of(tokens: Column) -> Column:
    """Labelled tokens -> ``array<struct<label,word,price>>``."""
    amounts = F.filter(
        tokens, lambda t: (t["label"] == "I-PRICE") & t["token"].rlike(NUMBER)
    )
    price = F.get(amounts, F.lit(0))["token"]

    def record(span: Column) -> Column:
        # Positions instead of a slice: a slice copies the whole sentence for every span.
        words = F.transform(
            F.sequence(span["start"], span["end"]), lambda i: F.get(tokens, i)["token"]
        )
        return F.struct(
            F.get(tokens, span["start"])["label"].alias("label"),
            F.array_join(words, " ").alias("word"),
            F.when(span["type"] == "PRODUCT", price).alias("price"),
        )

    spans = tag_spans(F.transform(tokens, lambda t: t["label"]))
    return F.transform(spans, record).cast(f"array<{ENTITY.simpleString()}>")


def channel_filter(
    df: DataFrame, channels: list[str] | DataFrame, literal: bool = True
) -> DataFrame:
    """Keep the listed channels; a long list comes as a DataFrame with ``channel_username``
    and is joined (Catalyst broadcasts it if it is small enough).

    ``literal`` compares names as they are written; otherwise ``@name`` and ``name`` are
    one channel, on both sides.
    """
    name = F.col("channel_username") if literal else canonical_username("channel_username")
    if isinstance(channels, DataFrame):
        own = channels.select("channel_username") if literal else same_channel_name(channels)
        listed = own.select(F.col("channel_username").alias("_listed"))
        return df.join(listed, name == F.col("_listed"), "left_semi")
    listed = [F.lit(c) if literal else canonical_username(F.lit(c)) for c in channels]
    return df.where(name.isin(listed))


def same_channel_name(df: DataFrame) -> DataFrame:
    """Write every user name without ``@``, so that both spellings are one channel."""
    return df.withColumn("channel_username", canonical_username("channel_username"))


def preview(
    df: DataFrame, columns: list[str], order_by: list[str | Column], n: int
) -> DataFrame:
    """First ``n`` rows of some columns in an explicit order."""
    return df.orderBy(*order_by).limit(n).select(columns)


def first_n(df: DataFrame, order_by: list[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)
