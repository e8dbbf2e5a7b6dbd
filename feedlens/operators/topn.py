"""First rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored


def top_n_per_group(
    df: DataFrame, keys: list[str], order_by: list[Column], spread_by: list[str], n: int, salts: int | None = None
) -> DataFrame:
    """The first ``n`` rows of every group, exactly, in two rounds.

    Every map task keeps at most ``n`` rows per group, but a group present in all tasks
    would still send (tasks x n) rows to one reducer. So the first round ranks inside
    (group, salt), and the second ranks the at most (salts x n) rows left per group.
    ``salts`` grows with the cluster: it defaults to the shuffle partition count.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    part = Window.partitionBy(*keys, "_salt").orderBy(*order_by)
    whole = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        salted.withColumn("_rank", F.row_number().over(part))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def late_top_n(df: DataFrame, key: str, order: str, n: int, ascending: bool = True) -> DataFrame:
    """The first ``n`` rows of every ``key`` by ``order``, found by these two columns alone.

    The winners' keys are stored, and whole rows are fetched by one more scan, so that nothing
    else is ever sorted or shuffled. Runs while it is called.
    """
    narrow = df.select(F.col(key).alias("_key"), F.col(order).alias("_order"))
    direction = F.asc("_order") if ascending else F.desc("_order")
    first = top_n_per_group(narrow, ["_key"], [direction], ["_order"], n)
    taken, _ = broadcast_if_small(stored(first.groupBy("_key", "_order").agg(F.count(F.lit(1)).alias("_take")), "top-keys"))
    here = F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_order"))
    fetched = df.join(taken, here)
    # Rows that share the last place may be more than there is room for.
    held = narrow.withColumnsRenamed({"_key": "_k", "_order": "_o"}).join(
        taken, F.col("_k").eqNullSafe(F.col("_key")) & F.col("_o").eqNullSafe(F.col("_order")))
    crowded = held.groupBy("_key", "_order", "_take").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.col("_take"))
    if not crowded.isEmpty():
        equal = Window.partitionBy("_key", "_order").orderBy(F.lit(1))
        fetched = fetched.withColumn("_rank", F.row_number().over(equal)).where(F.col("_rank") <= F.col("_take"))
    return fetched.select(df.columns)


def latest_n_per_channel(df: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` messages of every channel."""
    return late_top_n(df, "channel_username", "id", n, ascending=False)


def head_per_channel(df: DataFrame, n: int, channels: list[str] | None = None) -> DataFrame:
    """The first ``n`` messages of every (listed) channel."""
    if channels is not None:
        df = df.where(F.col("channel_username").isin(channels))
    return late_top_n(df.where(F.col("channel_username").isNotNull()), "channel_username", "id", n)
