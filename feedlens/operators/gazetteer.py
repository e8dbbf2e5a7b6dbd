"""Place words by the hundred thousand: tokens that contain an entry of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.skew import join_by_key_counts
from feedlens.session import stored

#: Signs of an entry by which it is looked up.
GRAM = 3


def mark_places(
    rows: DataFrame, places: DataFrame, token: str = "token", place: str = "place", out: str = "is_place"
) -> DataFrame:
    """``rows`` with ``out``: whether the token contains one of the places (case-sensitive).

    Each distinct token is looked up once. An entry is keyed by one of its runs of ``GRAM``
    signs, the one that fewest entries have (by all its signs, if they are fewer), a token by
    all its runs of such lengths, so the two tables meet by an equi-join, and only entries that
    share a rare run are compared. Null entries count for nothing, an empty one is contained in
    every token; a null token contains none. Runs while it is called: the distinct tokens and
    the keyed entries are stored.
    """
    def runs(text: Column, size: Column | int) -> Column:
        size = F.lit(size) if isinstance(size, int) else size
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substr(text, i, size))

    entries = places.select(F.col(place).alias("_place")).where(F.col("_place").isNotNull()).distinct()
    grams = stored(entries.select("_place", F.explode(F.array_distinct(
        runs(F.col("_place"), F.least(F.length("_place"), F.lit(GRAM))))).alias("_gram")), "place-grams")
    # At most GRAM + 1 lengths.
    lengths = sorted(r[0] for r in grams.select(F.length("_gram")).distinct().collect())
    if 0 in lengths:
        return rows.withColumn(out, F.col(token).isNotNull())
    if not lengths:
        return rows.withColumn(out, F.lit(False))
    shared = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    keyed = grams.join(shared, "_gram").groupBy("_place").agg(F.min(F.struct("_n", "_gram")).alias("_key"))
    entries = stored(keyed.select("_place", F.col("_key._gram").alias("_gram")), "places")
    tokens = stored(rows.groupBy(F.col(token).alias("_token")).agg(F.count(F.lit(1)).alias("n")), "tokens")
    every = F.array_distinct(F.flatten(F.array(*[runs(F.col("_token"), size) for size in lengths])))
    grams = tokens.select("_token", F.explode(every).alias("_gram"))
    found = (
        grams.join(entries, "_gram").where(F.contains("_token", F.col("_place")))
        .select("_token").distinct().withColumn(out, F.lit(True))
    )
    marked = tokens.join(found, "_token", "left").select(
        F.col("_token").alias(token), "n", F.coalesce(out, F.lit(False)).alias(out)
    )
    known = join_by_key_counts(rows.where(F.col(token).isNotNull()), stored(marked.where(F.col(token).isNotNull()), "places"), [token])
    return known.unionByName(rows.where(F.col(token).isNull()).withColumn(out, F.lit(False)))
