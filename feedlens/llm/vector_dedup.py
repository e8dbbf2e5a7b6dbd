"""Near-duplicate vectors by random-hyperplane signatures (operator 12).

Equal vectors are first made one. Each different vector gets a signature of hyperplane sides
in several tables; vectors of one bucket are compared by matrix products, exactly and in
double precision. A pair counts in the first table that brings it together, so links are
counted where they are found and never listed: a bucket hands on a number of links per vector
and a forest of edges that spans its groups. Connected components of the edges are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import arrow_map, bounded, longs
from feedlens.llm.components import components
from feedlens.operators.skew import broadcast_if_small, join_by_key_counts
from feedlens.session import stored

LINKED = 0.95
#: Chance that a pair at the threshold meets in no table.
MISSED = 1e-4
#: Vectors per bucket that the number of planes aims at, and bounds of that number.
BUCKET_ROWS, LEAST_PLANES, MOST_PLANES = 128, 8, 24
#: Rows of a bucket that are compared with as many others in one unit of work.
BLOCK_ROWS = 4096
#: Within this distance of the threshold a cosine is computed anew, pair by pair.
NEAR = 1e-9
SEED = 12

FORM = "id bigint, usable boolean, digest binary, dim int, vector binary"


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component and then by their length, so that neither huge
    nor tiny numbers leave the range of doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Vectors as bytes of doubles with a digest; ``usable`` is false for those that are null,
    empty, zero, or hold null or non-finite components, and for rows without an id."""
    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            ids = batch.column(0).cast(pa.int64())
            column = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            values = column.flatten().cast(pa.float64(), safe=False)
            lacking = values.is_null().to_numpy(zero_copy_only=False)
            numbers = pc.fill_null(values, 0).to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
            ends = np.cumsum(sizes)
            known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
            good, digests, rows = [], [], []
            for has_id, end, size in zip(known, ends, sizes):
                some = numbers[end - size:end]
                fine = bool(has_id and size and not lacking[end - size:end].any() and np.isfinite(some).all() and some.any())
                raw = some.tobytes() if fine else None
                good.append(fine)
                digests.append(hashlib.sha256(raw).digest() if fine else None)
                rows.append(raw)
            return [ids, pa.array(good, pa.bool_()), pa.array(digests, pa.binary()),
                    pa.array(sizes.astype(np.int32)), pa.array(rows, pa.binary())]
        return step

    return arrow_map(vectors.select(F.col(id_col).cast("bigint").alias("id"), vector_col), FORM, start)


def planes_for(vectors: int) -> tuple[int, int]:
    """(planes per table, tables): as many planes as buckets of ``BUCKET_ROWS`` need, and so
    many tables that a pair at the threshold is missed with a chance of ``MISSED``."""
    wanted = math.ceil(math.log2(max(1, vectors) / BUCKET_ROWS)) if vectors else 0
    planes = min(MOST_PLANES, max(LEAST_PLANES, wanted))
    meet = (1 - math.acos(LINKED) / math.pi) ** planes
    return planes, math.ceil(math.log(MISSED) / math.log(1 - meet))


def signed(distinct: DataFrame, planes: int, tables: int) -> DataFrame:
    """Adds ``sides``: for each table the bucket number, by the sides of random planes."""
    normals: dict[int, np.ndarray] = {}
    weights = (1 << np.arange(planes)).astype(np.int64)

    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            raw = batch.column(2).to_pylist()
            sides = np.zeros((len(raw), tables), np.int32)
            for dim in np.unique(dims):
                if dim not in normals:
                    normals[dim] = np.random.default_rng([SEED, dim]).normal(size=(dim, tables * planes))
                rows = np.flatnonzero(dims == dim)
                x = scaled(np.frombuffer(b"".join(raw[i] for i in rows)).reshape(len(rows), dim))
                above = (x @ normals[dim] > 0).reshape(len(rows), tables, planes)
                sides[rows] = (above * weights).sum(axis=2)
            flat = pa.array(sides.ravel())
            at = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * tables)
            return [*batch.columns, pa.ListArray.from_arrays(at, flat)]
        return step

    return arrow_map(distinct.select("node", "dim", "vector", "n"),
                     "node bigint, dim int, vector binary, n bigint, sides array<int>", start)


def _linked(x: np.ndarray, a: int, b: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a..b, one of ``columns``) of unit vectors that reach the threshold."""
    near = x[a:b] @ x[columns].T
    i, j = np.nonzero(near >= LINKED - NEAR)
    close = np.flatnonzero(near[i, j] < LINKED + NEAR)
    if len(close):
        exact = (x[a + i[close]] * x[columns[j[close]]]).sum(axis=1)
        keep = np.ones(len(i), bool)
        keep[close[exact < LINKED]] = False
        i, j = i[keep], j[keep]
    return a + i, columns[j]


def links_of(x: np.ndarray, copies: np.ndarray, sides: np.ndarray, table: int, block: np.ndarray,
             unit: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(links of each row with others, smallest row of each row's group) in one unit of a bucket.

    ``block`` is the block of each row; a unit (r, r) compares a block with itself, (r, q) two
    blocks with each other. Pairs that an earlier table brings together are left to it.
    """
    links, group = np.zeros(len(x), np.int64), np.arange(len(x))
    own = np.flatnonzero(block == unit[0])
    others = own if unit[0] == unit[1] else np.flatnonzero(block == unit[1])
    x, own_first = x[np.concatenate([own, others])], len(own)
    rows = np.concatenate([own, others])
    columns = np.arange(own_first, len(rows))
    for a in range(0, own_first, 256):
        i, j = _linked(x, a, min(own_first, a + 256), columns)
        i, j = rows[i], rows[j]
        if unit[0] == unit[1]:
            i, j = i[i < j], j[i < j]
        if table and len(i):
            first = ~(sides[i, :table] == sides[j, :table]).any(axis=1)
            i, j = i[first], j[first]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        # The pairs are in the order of i: one merge of groups per row.
        begin = np.flatnonzero(np.diff(i, prepend=-1))
        for s, e in zip(begin, [*begin[1:], len(i)]):
            found = np.unique(group[j[s:e]])
            if len(found) > 1 or found[0] != group[i[s]]:
                found = np.append(found, group[i[s]])
                group[np.isin(group, found)] = found.min()
    return links, group


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that come sorted by ``keys``, one table per key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and last != tuple(c[0] for c in columns)
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            if held and (k or new[0]):
                yield pa.Table.from_batches(held)
                held = []
            if e > s:
                held.append(batch.slice(s, e - s))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


UNIT = ["t", "dim", "bucket", "r", "q"]
COUNTED = "node bigint, links bigint, root bigint"


def compared(signatures: DataFrame) -> DataFrame:
    """(node, links, root) of the rows that have links in a unit of work: how many the unit
    adds, and the smallest node of the row's group there.

    A bucket of more than ``BLOCK_ROWS`` vectors is cut into even blocks by a hash of the node,
    and each pair of its blocks is one unit, so that no task holds a whole bucket.
    """
    tables = F.posexplode("sides").alias("t", "bucket")
    large = (signatures.select("dim", tables).groupBy("t", "dim", "bucket")
             .agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")).where("blocks > 1"))
    large, _ = broadcast_if_small(stored(large, "large-buckets"))
    rows = (signatures.select("*", tables).join(large, ["t", "dim", "bucket"], "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    units = rows.select("*", other).select(
        "t", "dim", "bucket", F.least("block", "o").alias("r"), F.greatest("block", "o").alias("q"),
        "node", "n", "block", "sides", "vector")

    def batch_of(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [longs(np.concatenate([np.zeros(0, np.int64), *c])) for c in columns], names=["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, counts, roots = [], [], []
        for some in _runs(batches, UNIT):
            if some.num_rows < 2:
                continue
            t, dim, _, r, q = (some.column(k)[0].as_py() for k in UNIT)
            x = scaled(np.frombuffer(b"".join(some.column("vector").to_pylist())).reshape(-1, dim))
            sides = some.column("sides").combine_chunks().flatten().to_numpy().reshape(len(x), -1)
            own = some.column("node").to_numpy()
            links, group = links_of(x, some.column("n").to_numpy(), sides, t, some.column("block").to_numpy(), (r, q))
            least = np.full(len(x), np.iinfo(np.int64).max)
            np.minimum.at(least, group, own)
            hit = np.flatnonzero(links)
            nodes.append(own[hit])
            counts.append(links[hit])
            roots.append(least[group[hit]])
            if sum(map(len, nodes)) > 100_000:
                yield batch_of(nodes, counts, roots)
                nodes, counts, roots = [], [], []
        yield batch_of(nodes, counts, roots)

    return bounded(units.repartition(*UNIT).sortWithinPartitions(*UNIT)).mapInArrow(run, COUNTED)


def classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``.

    Vectors that are null, empty or zero, or hold null or non-finite components, and rows
    without an id link with nothing; vectors of different lengths have no cosine and aren't
    linked. Rows with equal vectors are linked, also those of one id. ``kept``: the id is the
    smallest of its class (rows that share it are all kept; a row without an id is kept, its
    class is null). Other columns are ignored; an empty table gives no rows.
    Runs while it is called: vectors, signatures, counts and links are stored.
    """
    rows = stored(packed(vectors, id_col, vector_col), "vectors")
    usable = rows.where("usable")
    distinct = stored(
        usable.groupBy("digest")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"), F.max("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()),  # kept by the stored table
        "distinct-vectors")
    signatures = stored(signed(distinct, *planes_for(distinct.count())), "signatures")
    found = stored(compared(signatures), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = stored(components(found, "node", "root"), "vector-labels")
    least = (labels.join(distinct.select("node", "id"), "node").groupBy("label").agg(F.min("id").alias("component_id")))
    table = (distinct.select("digest", "node", "id", "n").join(links, "node", "left")
             .join(labels.join(least, "label").drop("label"), "node", "left")
             .select("digest", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component_id", "id").alias("component_id")))
    linked = join_by_key_counts(usable.select("id", "digest"), stored(table, "vector-classes"), ["digest"])
    alone = rows.where("not usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.select("id", "n_links", "component_id").unionByName(alone)
    return every.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


VECTOR_DEDUP_SQL = f"""
with recursive given as (select row_number() over () as r, vec_id, embedding::double[] as v from embeddings),
usable as (
  select * from given where vec_id is not null and v is not null
    and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(v, lambda x: x <> 0)) > 0),
scaled as (
  select r, vec_id, list_transform(v, lambda x: x / list_max(list_transform(v, lambda y: abs(y)))) as v from usable),
links as (
  select a.r as r, b.r as other, b.vec_id as other_id from scaled a join scaled b
    on a.r <> b.r and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= {LINKED}),
reach as (
  select r, r as other, vec_id as other_id from usable
  union select reach.r, links.other, links.other_id from reach join links on reach.other = links.r),
least as (select r, min(other_id) as component_id from reach group by r),
counts as (select r, count(*) as n from links group by r)
select vec_id, coalesce(n, 0) as n_links, coalesce(component_id, vec_id) as component_id,
       vec_id is not distinct from coalesce(component_id, vec_id) as kept
from given left join counts using (r) left join least using (r)"""
