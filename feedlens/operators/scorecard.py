"""Vendor scorecard."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import entities as E
from feedlens.functions.numbers import round_to
from feedlens.functions.text import _col
from feedlens.operators.cleaning import default_entities, default_views, parse_timestamp, vendor_column
from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored

DAY_US = 24 * 3600 * 1_000_000
#: Stands below all views.
NO_VIEWS = -(5 * 10 ** 18) - 1


def scorecard_input(df: DataFrame) -> DataFrame:
    """Parsed dates (bad ones dropped), vendor, views and entities, whatever of these
    the message table lacks."""
    return vendor_column(parse_timestamp(default_entities(default_views(df))))


def with_vendor(df: DataFrame) -> DataFrame:
    return df.where(F.col("vendor").isNotNull())


def vendor_groups(df: DataFrame) -> DataFrame:
    """Posts per vendor, in vendor order."""
    return with_vendor(df).groupBy("vendor").agg(F.count(F.lit(1)).alias("posts")).orderBy("vendor")


def posts_per_week_of(timestamp: Column | str = "timestamp") -> Column:
    """Aggregate: posts / max(whole days between first and last / 7, 1)."""
    span = F.unix_micros(F.max(_col(timestamp))) - F.unix_micros(F.min(_col(timestamp)))
    weeks = F.greatest(F.floor(span / DAY_US) / F.lit(7.0), F.lit(1.0))
    return round_to(F.count(F.lit(1)) / weeks)


def avg_views_of(views: Column | str = "views") -> Column:
    return round_to(F.avg(views))


def posts_per_week(df: DataFrame) -> DataFrame:
    return with_vendor(df).groupBy("vendor").agg(posts_per_week_of().alias("posts_per_week"))


def avg_views(df: DataFrame) -> DataFrame:
    return with_vendor(df).groupBy("vendor").agg(avg_views_of().alias("avg_views"))


def _entity_list(df: DataFrame) -> DataFrame:
    """Entities as an array; text is parsed first."""
    if isinstance(df.schema["entities"].dataType, T.StringType):
        return df.withColumn("entities", E.parse_entities("entities"))
    return df


def with_price_sums(df: DataFrame) -> DataFrame:
    """Adds ``price_sum`` and ``price_count`` of each post, so that prices need no explode
    and no second grouping."""
    prices = _entity_list(df).withColumn("_prices", E.product_prices("entities"))
    return (
        prices.withColumn("price_sum", F.aggregate("_prices", F.lit(0.0), lambda a, p: a + p))
        .withColumn("price_count", F.size("_prices").cast("bigint"))
        .drop("_prices")
    )


def avg_price_of() -> Column:
    count = F.sum("price_count")
    return F.when(count > 0, round_to(F.sum("price_sum") / count)).otherwise(F.lit(0.0))


def avg_price(df: DataFrame) -> DataFrame:
    """Mean product price per vendor, 0 without any."""
    return with_price_sums(with_vendor(df)).groupBy("vendor").agg(avg_price_of().alias("avg_price"))


def top_key(order: str = "id") -> Column:
    """Views and order of a post as one number of fixed width: the larger, the nearer the top.
    A post without views never beats one with views, one without an order is the last of its
    equals. Views from -5 x 10^18 to 5 x 10^18 fit; others are an error."""
    views = F.coalesce(F.col("views").cast("decimal(19,0)"), F.lit(Decimal(NO_VIEWS)))
    place = F.coalesce(F.col(order).cast("bigint"), F.lit(2 ** 63 - 1)).cast("decimal(19,0)")
    return (views * F.lit(Decimal(2 ** 64)) - place).cast("decimal(38,0)")


def _top_values(posts: DataFrame, value: Column, order: str, aggregates: list[tuple[str, Column]]) -> DataFrame:
    """``vendor``, the aggregates, and ``top``: ``value`` of the vendor's most viewed post, the
    first by ``order`` of equal ones.

    The first pass keeps numbers of fixed width per vendor, so it is a hash aggregate with a map
    side and sorts nothing. Its rows, one a vendor, are stored and meet the posts again
    (broadcast if they are few), and ``value`` is computed of the winners alone. Views or an
    order that are no integers take one more pass: the most views, then the first of the ties.
    """
    names = [name for name, _ in aggregates]
    given = [c.alias(name) for name, c in aggregates]
    integral = all(isinstance(posts.schema[c].dataType, T.IntegralType) for c in ("views", order))
    if integral:
        rows = posts.withColumn("_key", top_key(order))
        tops = stored(rows.groupBy("vendor").agg(F.max("_key").alias("_top"), *given), "vendor-tops")
        won = F.col("_key") == F.col("_top")
    else:
        rows = posts.withColumn("_order", F.col(order))
        best = stored(rows.groupBy("vendor").agg(F.max("views").alias("_top"), *given), "vendor-views")
        tied = F.col("views").eqNullSafe(F.col("_top"))
        few, _ = broadcast_if_small(best.select("vendor", "_top"))
        first = rows.join(few, "vendor").where(tied).groupBy("vendor").agg(F.min("_order").alias("_first"))
        tops = stored(best.join(first, "vendor"), "vendor-tops")
        won = tied & F.col("_order").eqNullSafe(F.col("_first"))
    tops, _ = broadcast_if_small(tops)
    found = rows.join(tops, "vendor").where(won).select("vendor", *names, value.alias("_value"))
    # A message that landed twice, or the same id in two channels of one title: one of them.
    # The set holds different values only, and no value is an empty set.
    return found.groupBy("vendor", *names).agg(F.array_min(F.collect_set("_value")).alias("top"))


def top_post(df: DataFrame, text: str = "message", order: str = "id") -> DataFrame:
    """``vendor, message, views`` of the most viewed post. Long messages are neither sorted
    nor shuffled, but for the winners."""
    value = F.struct(F.col(text).alias("message"), F.col("views").alias("views"))
    posts = with_vendor(df).select("vendor", "views", *dict.fromkeys([order, text]))
    return _top_values(posts, value, order, []).select("vendor", "top.message", "top.views")


_TOP_PRODUCT = ["top_product", "top_price"]


def _top_product() -> Column:
    return F.struct(E.top_product("entities").alias("top_product"), E.top_price("entities").alias("top_price"))


def top_products(df: DataFrame, order: str = "id") -> DataFrame:
    """``vendor, top_product, top_price`` of the most viewed post."""
    posts = _entity_list(with_vendor(df)).select("vendor", "views", order, "entities")
    return _top_values(posts, _top_product(), order, []).select("vendor", *[f"top.{c}" for c in _TOP_PRODUCT])


def lending_score_of(views: Column | str, posts: Column | str) -> Column:
    """Half the average views plus half the posts per week."""
    return round_to(_col(views) * 0.5 + _col(posts) * 0.5)


def vendor_scorecard(df: DataFrame, order: str = "id") -> DataFrame:
    """Seven columns per vendor, best lending score first.

    Everything a post contributes is computed in its own row first, so one grouping with
    a map-side combine is enough: a vendor with a third of all posts sends one row per
    task, like any other. The most viewed posts are looked up by its result.
    """
    posts = with_price_sums(with_vendor(df)).select(
        "vendor", "timestamp", "views", order, "price_sum", "price_count", "entities")
    card = _top_values(posts, _top_product(), order, [
        ("avg_views", avg_views_of()), ("posts_per_week", posts_per_week_of()), ("avg_price", avg_price_of())])
    return card.select(
        "vendor", "avg_views", "posts_per_week", "avg_price", *[f"top.{c}" for c in _TOP_PRODUCT],
        lending_score_of("avg_views", "posts_per_week").alias("lending_score"),
    ).orderBy(F.desc("lending_score"), "vendor")
