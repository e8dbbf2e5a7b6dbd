"""Approximate nearest neighbours by learned partitions (operator 8).

The neighbour graph of a sample is cut into balanced parts with few edges between them, and
a small network learns the part of a vector. Every vector is indexed under its most probable
part; a query is sent to several most probable parts, whose vectors are ranked exactly. How
many parts a query probes is measured on the sample against brute force.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlens.llm.common import arrow_map, longs
from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored

NEAREST, QUERY_EVERY = 5, 50
#: The model is fitted on a bounded sample: this many vectors per part, within these bounds.
SAMPLE_PER_PART, LEAST_SAMPLE, MOST_SAMPLE = 64, 8_000, 32_000
#: Vectors per part, the fewest and the most parts, and the fewest sample vectors of a part.
PART_ROWS, LEAST_PARTS, MOST_PARTS, LEAST_PART_SAMPLE = 3_000, 16, 512, 16
GRAPH_NEIGHBOURS, HIDDEN, ROUNDS = 10, 64, 300
#: A part holds at most so many times its even share of the sample.
SLACK = 1.1
#: Share of the sample's true neighbours that the probed parts must hold.
TARGET = 0.97
#: Rows of a part, and queries to it, that one unit of work compares.
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 4_000


def _tame(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square leaves the range of doubles. Powers of
    two change no digit, so cosines stay what they are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _tame(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each row of unit vectors its ``k`` nearest others."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for at in range(0, len(x), 1024):
        near = x[at:at + 1024] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
        out[at:at + 1024] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """Part of each node: halves along main directions to begin with, then nodes move to the
    part of most of their neighbours, largest gain first, while it has room."""
    part = np.zeros(len(x), np.int64)
    n_parts = [(np.arange(len(x)), parts)]
    label = 0
    while n_parts:
        rows, n = n_parts.pop()
        if n == 1 or len(rows) < 2:
            part[rows] = label
            label += 1
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ direction, kind="stable")]
        cut = len(rows) * (n // 2) // n
        n_parts += [(order[cut:], n - n // 2), (order[:cut], n // 2)]
    room = int(np.ceil(len(x) / label * SLACK))
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    ends = np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source])
    for _ in range(rounds):
        votes = np.zeros((len(x), label))
        np.add.at(votes, (ends[0], part[ends[1]]), 1)
        best = votes.argmax(axis=1)
        gain = votes.max(axis=1) - votes[np.arange(len(x)), part]
        size, moved = np.bincount(part, minlength=label), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[best[i]] += 1
                size[part[i]] -= 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass(frozen=True)
class Router:
    """One hidden layer; ``probes`` parts per query."""

    weights: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(x @ a + b, 0) @ c + d

    @property
    def parts(self) -> int:
        return len(self.weights[3])


def train_router(x: np.ndarray, part: np.ndarray, parts: int) -> Router:
    """Cross-entropy by Adam over the whole sample."""
    rng = np.random.default_rng(11)
    dim = x.shape[1]
    weights = [rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    x = x * np.sqrt(dim)
    target = np.eye(parts)[part]
    for step in range(1, ROUNDS + 1):
        some = rng.integers(0, len(x), min(len(x), 2048))
        rows = x[some]
        hidden = np.maximum(rows @ weights[0] + weights[1], 0)
        out = hidden @ weights[2] + weights[3]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        error = (out / out.sum(axis=1, keepdims=True) - target[some]) / len(some)
        back = (error @ weights[2].T) * (hidden > 0)
        grads = [rows.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] -= 0.01 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    weights[0] = weights[0] * np.sqrt(dim)
    return Router(tuple(weights), parts)


def fit_router(vectors: np.ndarray, parts: int) -> Router:
    """Partition, classifier and number of probes from sample vectors."""
    x = _unit(vectors.astype(float))
    parts = min(parts, len(x) // LEAST_PART_SAMPLE)
    if parts < 2:  # a handful of vectors
        return Router((np.zeros((vectors.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1)
    part = balanced_parts(x, neighbour_graph(x, GRAPH_NEIGHBOURS), parts)
    router = train_router(x, part, int(part.max()) + 1)
    # Probes: parts of the true neighbours of some sample rows, by rank in the row's scores.
    some = x[:: max(1, len(x) // 1000)]
    at = np.arange(0, len(x), max(1, len(x) // 1000))
    near = some @ x.T
    near[np.arange(len(some)), at] = -np.inf
    true = np.argpartition(-near, NEAREST, axis=1)[:, :NEAREST]
    home = router.scores(x).argmax(axis=1)
    rank = np.argsort(np.argsort(-router.scores(some), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, home[true], axis=1).ravel())
    return Router(router.weights, int(needed[int(np.ceil(TARGET * len(needed))) - 1]) + 1)


def usable(vector: Column) -> Column:
    """Not null, with finite components that are not all zero."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(doubles, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(float).reshape(n, -1)


def routed(vectors: DataFrame, router: Router, probes: int) -> DataFrame:
    """(id, vector, part) for the ``probes`` most probable parts of each vector."""
    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            if not batch.num_rows:
                return [batch.column(0), batch.column(1), pa.array([], pa.int32())]
            scores = router.scores(_unit(_matrix(batch.column(1), batch.num_rows)))
            parts = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
            again = pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1]))
            return [batch.column(0).take(again), batch.column(1).take(again),
                    pa.array(parts.ravel().astype(np.int32))]
        return step

    return arrow_map(vectors, "id bigint, vector array<double>, part int", start)


def exact_nearest(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                  k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, cosine) of each query's ``k`` nearest other rows; ties to the smaller id.

    A matrix product finds what may be among them, up to its rounding; those are measured
    one by one, so equal vectors have equal cosines.
    """
    rows, queries = _tame(rows), _tame(queries)
    norms, query_norms = np.sqrt((rows * rows).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    found = []
    for at in range(0, len(queries), 256):
        near = (queries[at:at + 256] @ rows.T) / norms / query_norms[at:at + 256, None]
        near[query_ids[at:at + 256, None] == ids[None, :]] = -np.inf
        least = np.partition(near, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(near), -2.0)
        for i, (row, bound) in enumerate(zip(near, least), at):
            some = np.flatnonzero((row >= bound - 1e-9) & (row > -np.inf))
            exact = (rows[some] * queries[i]).sum(axis=1) / (norms[some] * query_norms[i])
            best = np.lexsort((ids[some], -exact))[:k]
            found.append((np.full(len(best), query_ids[i]), ids[some][best], exact[best]))
    return tuple(np.concatenate(c) for c in zip(*found))


FOUND = "query_id bigint, vec_id bigint, score double"


def ranked(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each query's nearest rows of its parts, from (id, vector, part) on both sides.

    Parts are cut into blocks on both sides and each pair of blocks of a part is one unit of
    work, so that no task holds a part, however many vectors are alike.
    """
    def blocks_of(side: DataFrame, size: int, name: str) -> DataFrame:
        return side.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    # One row for each part and each rarer length.
    blocks, _ = broadcast_if_small(stored(blocks_of(rows, BLOCK_ROWS, "rb").join(blocks_of(queries, BLOCK_QUERIES, "qb"), "part"), "neighbour-blocks"))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(blocks, "part").select("part", own("rb").alias("r"), each("qb").alias("q"), "id", "vector")
    right = queries.join(blocks, "part").select("part", each("rb").alias("r"), own("qb").alias("q"), "id", "vector")

    def compare(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return pa.table({"query_id": longs([]), "vec_id": longs([]), "score": pa.array([], pa.float64())})
        q, v, s = exact_nearest(
            some.column("id").to_numpy(), _matrix(some.column("vector"), some.num_rows),
            asked.column("id").to_numpy(), _matrix(asked.column("vector"), asked.num_rows), k)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    return (left.groupBy("part", "r", "q").cogroup(right.groupBy("part", "r", "q"))
            .applyInArrow(compare, FOUND))


def search(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST,
    query_every: int = QUERY_EVERY,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is
    divisible by ``query_every``, among all other rows, by cosine.

    Rows without an id and vectors that are null, zero, or hold null or non-finite numbers
    take no part. Vectors of different lengths have no cosine: the model is of the most
    frequent length, vectors of others are compared with all of their own. Of rows of one id
    only one counts, that of the smallest vector. A query for which the probed parts hold
    fewer than ``k`` is put to all parts. Fits its model while it is called; the sample on
    the driver has at most ``MOST_SAMPLE`` vectors.
    """
    rows = (vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    rows = stored(rows, "neighbour-rows")
    sizes = (rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "d").limit(1).collect())
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim, n = sizes[0]
    common, rare = rows.where(F.size("vector") == dim), rows.where(F.size("vector") != dim)
    rare = rare.withColumn("part", -F.size("vector"))
    parts = int(min(MOST_PARTS, max(LEAST_PARTS, n // PART_ROWS)))
    router = fit_router(_sampled(common, min(MOST_SAMPLE, max(LEAST_SAMPLE, SAMPLE_PER_PART * parts)), n, dim), parts)

    indexed = stored(routed(common, router, 1).unionByName(rare), "neighbour-index")
    asked = F.col("id") % query_every == 0
    queries = indexed.where(asked & (F.col("part") >= 0)).select("id", "vector")
    probed = routed(queries, router, router.probes).unionByName(rare.where(asked))
    found = stored(ranked(indexed, probed, k), "neighbour-found")
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = queries.join(enough, queries["id"] == enough["query_id"], "left_anti")
    if router.probes < router.parts and not short.isEmpty():
        more = ranked(indexed, routed(short, router, router.parts), k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(more)
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _sampled(rows: DataFrame, wanted: int, n: int, dim: int) -> np.ndarray:
    """About ``wanted`` of ``n`` vectors by a hash of the id, as bytes on their way to the driver."""
    mark = F.xxhash64("id", F.lit(23))
    share = F.pmod(mark, F.lit(1 << 30)) < F.lit(int(min(1.0, 2.0 * wanted / n) * (1 << 30)) + 1)

    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            # Half the bytes are enough to fit a model; tamed numbers fit in them.
            values = _tame(_matrix(batch.column(1), batch.num_rows)).astype(np.float32) if batch.num_rows else []
            return [batch.column(0), pa.array([v.tobytes() for v in values], pa.binary())]
        return step

    some = rows.where(share).orderBy(mark, "id").limit(wanted).select("id", "vector")
    packed = arrow_map(some, "id bigint, bytes binary", start).orderBy("id").collect()
    return np.frombuffer(b"".join(r["bytes"] for r in packed), np.float32).reshape(-1, dim)
