"""Approximate nearest neighbours by learned partitions.

On a bounded sample, a graph of nearest neighbours is cut into parts of equal
size, few neighbours apart, and a small classifier learns from a vector which
parts its neighbours are in.  The classifier puts every vector into its most
probable part, and sends a query to the several most probable ones, as many as
give the wanted recall on the sample.  Vectors met there are ranked by the
inner product, in double precision on the original values.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do those whose length is not the most frequent one, or rows without
a ``vec_id``.  A query never meets rows of its own ``vec_id``.  Ties go to the
smaller ``vec_id``.  With fewer candidates than asked for all are returned, and
an empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

NEAREST = 20
#: Vectors on which graph, parts and classifier are fitted: the first by a hash of the id.
SAMPLE = 4096
PARTS = 16
GRAPH_NEIGHBOURS = 10
HIDDEN = 128
EPOCHS = 40
#: One in so many vectors of the sample is kept from fitting and used to find the number of parts to search.
HELD_OUT = 4
#: Recall on the vectors kept from fitting from which on no more parts are searched.
RECALL = 0.95
SEED = 11
#: Vectors and queries that meet in one task.
VECTOR_BLOCK = 20_000
QUERY_BLOCK = 5_000


def neighbour_graph(vectors: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` nearest others of each vector, by inner product."""
    out = np.empty((len(vectors), count), dtype=np.int64)
    for begin in range(0, len(vectors), 512):
        scores = vectors[begin : begin + 512] @ vectors.T
        scores[np.arange(len(scores)), np.arange(begin, begin + len(scores))] = -np.inf
        out[begin : begin + 512] = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    return out


def bisect(links: np.ndarray, rng: np.random.Generator, rounds: int = 60, swaps: int = 20) -> np.ndarray:
    """Two halves of a graph (pairs of places): a spectral split at the median, then swaps that save links."""
    size = int(links.max()) + 1 if links.size else 0
    both = np.concatenate([links, links[:, ::-1]])
    degree = np.maximum(np.bincount(both[:, 0], minlength=size), 1)
    value = rng.normal(size=size)
    for _ in range(rounds):  # power iteration without the constant direction
        value -= (value * degree).sum() / degree.sum()
        value = value + np.bincount(both[:, 0], weights=value[both[:, 1]], minlength=size) / degree
        value /= max(np.abs(value).max(), 1e-30)
    side = np.zeros(size, dtype=np.int64)
    side[np.argsort(value, kind="stable")[size // 2 :]] = 1
    for _ in range(swaps):
        other = np.bincount(both[:, 0], weights=(side[both[:, 0]] != side[both[:, 1]]).astype(float), minlength=size)
        gain = 2 * other - np.bincount(both[:, 0], minlength=size)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        pairs = min(len(left), len(right))
        better = gain[left[:pairs]] + gain[right[:pairs]] > 0
        # Only some of them at once, for a swap changes the gain of its neighbours.
        take = int(better.sum()) // 4
        if not take:
            break
        side[left[:take]], side[right[:take]] = 1, 0
    return side


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Parts (a power of two of them) of as equal size as halving gives."""
    part = np.zeros(len(graph), dtype=np.int64)
    links = np.stack([np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()], axis=1)
    done = 1
    while done < parts:
        fresh = part * 2
        for number in range(done):
            members = np.flatnonzero(part == number)
            place = np.full(len(graph), -1)
            place[members] = np.arange(len(members))
            own = place[links]
            own = own[(own >= 0).all(axis=1)]
            own = np.concatenate([own, np.repeat(np.arange(len(members)), 2).reshape(-1, 2)])  # every place occurs
            fresh[members] += bisect(own, rng)
        part, done = fresh, done * 2
    return part


@dataclass
class Router:
    """A classifier with one hidden layer: vectors to log probabilities of parts."""

    weights: list[np.ndarray]
    probes: int = 1

    def log_probabilities(self, vectors: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros((len(vectors), 1))
        w1, b1, w2, b2 = self.weights
        logits = np.maximum(vectors @ w1 + b1, 0) @ w2 + b2
        return logits - np.logaddexp.reduce(logits, axis=1, keepdims=True)

    def best(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` most probable parts of each vector, the lower number first among equals."""
        return np.argsort(-self.log_probabilities(vectors), axis=1, kind="stable")[:, :count]


def train_router(vectors: np.ndarray, targets: np.ndarray, rng: np.random.Generator) -> Router:
    """Cross entropy with the share of neighbours in each part, by Adam on small batches."""
    size, parts = vectors.shape[1], targets.shape[1]
    scale = 1.0 / max(np.sqrt((vectors**2).sum(axis=1).mean()), 1e-12)
    weights = [
        rng.normal(size=(size, HIDDEN)) * scale * np.sqrt(2.0),
        np.zeros(HIDDEN),
        rng.normal(size=(HIDDEN, parts)) * np.sqrt(1.0 / HIDDEN),
        np.zeros(parts),
    ]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(vectors))
        for begin in range(0, len(order), 256):
            rows = order[begin : begin + 256]
            x = vectors[rows]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            share = np.exp(logits - np.logaddexp.reduce(logits, axis=1, keepdims=True))
            down = (share - targets[rows]) / len(rows)
            back = (down @ weights[2].T) * (hidden > 0)
            slopes = [x.T @ back, back.sum(axis=0), hidden.T @ down, down.sum(axis=0)]
            step += 1
            rate = 0.003 * (1 - epoch / EPOCHS) + 1e-4
            for k, slope in enumerate(slopes):
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope**2
                weights[k] = weights[k] - rate * (mean[k] / (1 - 0.9**step)) / (
                    np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                )
    return Router(weights)


def fit(sample: np.ndarray, parts: int = PARTS, nearest: int = NEAREST, recall: float = RECALL, seed: int = SEED) -> Router:
    """A router fitted on ``sample``; with too few vectors for parts of 64 there are fewer, or one."""
    rng = np.random.default_rng(seed)
    mixed = rng.permutation(len(sample))
    held, sample = sample[mixed[: len(sample) // HELD_OUT]], sample[mixed[len(sample) // HELD_OUT :]]
    while parts > 1 and len(sample) < 64 * parts:
        parts //= 2
    if parts == 1 or len(held) <= nearest + 1:
        return Router([])
    graph = neighbour_graph(sample, min(GRAPH_NEIGHBOURS, len(sample) - 1))
    part = balanced_parts(graph, parts, rng)
    around = np.concatenate([graph, np.arange(len(sample))[:, None]], axis=1)
    targets = np.zeros((len(sample), parts))
    np.add.at(targets, (np.repeat(np.arange(len(sample)), around.shape[1]), part[around].ravel()), 1.0)
    router = train_router(sample, targets / targets.sum(axis=1, keepdims=True), rng)
    order = router.best(held, parts)
    true = neighbour_graph(held, nearest)
    needed = np.take_along_axis(np.argsort(order, axis=1), order[:, 0][true], axis=1)
    shares = [(needed < probes).mean() for probes in range(1, parts + 1)]
    router.probes = next((k + 1 for k, share in enumerate(shares) if share >= recall), parts)
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = plain.filter(
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & F.coalesce(finite, F.lit(False))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = good.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    return good.filter(F.size("vector") == (usual["n"] if usual else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def routed(rows: DataFrame, router: Router, count: int) -> DataFrame:
    """``rows`` (vec_id, vector) once for each of their ``count`` most probable parts."""

    def sent(batches):
        for batch in batches:
            if batch.num_rows:
                best = router.best(_matrix(batch["vector"]), count)
                rows = np.repeat(np.arange(batch.num_rows), best.shape[1])
                out = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.ravel().astype(np.int32)), out["vec_id"], out["vector"]],
                    names=["part", "vec_id", "vector"],
                )

    return rows.mapInArrow(sent, "part int, vec_id bigint, vector array<double>")


def blocks_of(rows: DataFrame, block: int) -> dict[int, int]:
    """Blocks of about ``block`` rows that each part needs; there are as many entries as parts."""
    return {r["part"]: -(-r["n"] // block) for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}


def dealt(rows: DataFrame, own: dict[int, int], other: dict[int, int], mine: str, theirs: str) -> DataFrame:
    """Rows with a block of their own, once for each block of the other side."""
    count = lambda known: F.coalesce(
        F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[F.col("part")] if known else F.lit(None),
        F.lit(1),
    )
    return rows.withColumn(mine, F.pmod(F.xxhash64("vec_id"), count(own)).cast("int")).withColumn(
        theirs, F.explode(F.sequence(F.lit(0), count(other) - 1))
    )


def ranked(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, nearest: int):
    """Query id, vector id and score of the nearest vectors of each query."""
    found = []
    for begin in range(0, len(queries), 256):
        scores = queries[begin : begin + 256] @ vectors.T
        scores[query_ids[begin : begin + 256, None] == ids[None, :]] = -np.inf
        keep = min(nearest, len(ids))
        least = np.partition(scores, len(ids) - keep, axis=1)[:, len(ids) - keep]
        for row, query in enumerate(queries[begin : begin + 256]):
            # The product of matrices rounds in its own order; what is near the limit is summed again.
            low = least[row] - 1e-9 * (1 + abs(least[row])) if np.isfinite(least[row]) else -np.inf
            near = np.flatnonzero((scores[row] >= low) & np.isfinite(scores[row]))
            exact = (vectors[near] * query).sum(axis=1)
            order = np.lexsort([ids[near], -exact])[:nearest]
            found.append((np.full(len(order), query_ids[begin + row]), ids[near][order], exact[order]))
    columns = zip(*found) if found else [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    return [np.concatenate(column) for column in columns]


def search(
    vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, sample: int = SAMPLE, parts: int = PARTS, **options
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``nearest`` rows of ``vectors`` found for each row of ``queries``."""
    index = common.stored(usable(vectors), "ann-vectors")
    some = common.sample_of(index, ["vec_id"], sample).orderBy(F.xxhash64("vec_id")).select("vector").collect()
    router = fit(np.array([row["vector"] for row in some]), parts, nearest, **options)
    asked = usable(queries) if queries is not vectors else index
    members = common.stored(routed(index, router, 1), "ann-index")
    sent = common.stored(routed(asked, router, router.probes), "ann-queries")
    vector_blocks, query_blocks = blocks_of(members, VECTOR_BLOCK), blocks_of(sent, QUERY_BLOCK)

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if left.num_rows and right.num_rows:
            columns = ranked(
                _matrix(left["vector"]),
                left["vec_id"].to_numpy(),
                _matrix(right["vector"]),
                right["vec_id"].to_numpy(),
                nearest,
            )
        return pa.table(dict(zip(["query_id", "vec_id", "score"], columns)))

    keys = ["part", "query_block", "vector_block"]
    pairs = (
        dealt(sent, query_blocks, vector_blocks, "query_block", "vector_block")
        .groupBy(*keys)
        .cogroup(dealt(members, vector_blocks, query_blocks, "vector_block", "query_block").groupBy(*keys))
        .applyInArrow(compared, "query_id bigint, vec_id bigint, score double")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = pairs.withColumn("rank", place).filter(F.col("rank") <= nearest)
    return best.select("query_id", "rank", "vec_id", "score")


def search_every(vectors: DataFrame, step: int, **options) -> DataFrame:
    """Queries are the rows whose ``vec_id`` is divisible by ``step``."""
    return search(vectors, vectors.filter(F.col("vec_id") % step == 0), **options)
