"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import stored


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour (or itself)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
            .where("a <> b").distinct())


def _small(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    down = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    return (down.join(least, "b").select(F.explode(F.array(F.struct("m", F.col("a").alias("x")),
                                                            F.struct("m", F.col("b").alias("x")))).alias("p"))
            .select(F.col("p.m").alias("a"), F.col("p.x").alias("b")).where("a <> b").distinct())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node of its component, for each node of a link.

    The links of each round are stored, so that no round is computed again; the rounds grow
    with the logarithm of the longest path. Links of a node to itself and repeated links are
    fine; nulls are ignored. Nodes are longs. Runs while it is called.
    """
    now = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    state = None
    while True:
        now = stored(_small(_large(now)), "components")
        new = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if new == state:
            break
        state = new
    # Every link now leads from a node to the smallest of its component.
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()
