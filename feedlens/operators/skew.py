"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 10_000
BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64


def broadcast_if_small(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(table, True)`` marked for broadcast if its rows take at most ``max_bytes``, else
    the table as it is. Measures the rows, so pass a stored table."""
    row = F.octet_length(F.to_json(F.struct("*"))) + _ROW_OVERHEAD
    size = table.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0
    return (F.broadcast(table), True) if size <= max_bytes else (table, False)


def hot_rows(keyed_counts: DataFrame, count: str = "n", max_keys: int = HOT_KEYS) -> DataFrame:
    """Rows of a per-key count table whose key holds at least 1/``max_keys`` of the total.

    At most ``max_keys`` keys can reach that share, whatever the data, and their keys
    together are at most ``max_keys`` times the mean key length of the counted rows: safe
    to broadcast.
    """
    total = keyed_counts.agg(F.sum(count).alias("total")).select("total").scalar()
    return keyed_counts.where(F.col(count) * max_keys >= total)


def join_by_key_counts(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    count: str = "n",
    max_keys: int = HOT_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of ``rows`` with a stored lookup table that has one row for each of
    their keys and the number of rows per key in ``count``.

    A small lookup (measured first) is broadcast whole. In a larger one the hot keys (see
    ``hot_rows``) are joined by broadcast and never shuffled, and each other key holds
    less than 1/``max_keys`` of the rows, so their shuffle is even. Under a Zipf-like
    distribution most rows take the broadcast branch.
    """
    small, fits = broadcast_if_small(lookup.drop(count), broadcast_bytes)
    if fits:
        return rows.join(small, keys)
    hot = hot_rows(lookup, count, max_keys)
    hot_keys = F.broadcast(hot.select(*keys))
    by_broadcast = rows.join(F.broadcast(hot.drop(count)), keys)
    by_shuffle = rows.join(hot_keys, keys, "left_anti").join(
        lookup.join(hot_keys, keys, "left_anti").drop(count), keys
    )
    return by_broadcast.unionByName(by_shuffle)
