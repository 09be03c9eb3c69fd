"""Approximate nearest neighbours by low-dimensional stable projections.

Nearness is the largest inner product.  With one more coordinate that lifts
every vector to the greatest norm, it becomes the least distance.  Gaussian
projections to a few dimensions keep distances up to a chi-square factor: if
two points are d apart, their squared projected distance is d^2 times a
chi-square variable.  Each block of vectors is indexed by a kd-tree over its
projections.  A query takes the tree's leaves by projected distance, verifies
their vectors, and stops once a vector nearer than its k-th best would lie in
what is left with small probability only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 12
CONFIDENCE = 0.9            # chi-square probability at which a query stops
LEAF = 128
BLOCK_VALUES = 1 << 20      # components in one block of vectors, on average
QUERY_BATCH = 512


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function for PROJECTIONS (an even number) degrees."""
    half = np.minimum(np.maximum(x, 0) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, PROJECTIONS // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


class Tree:
    """A block's vectors, ordered by the leaves of a kd-tree over their
    projections."""

    def __init__(self, vectors: np.ndarray, norm: float):
        self.norm, dim = norm, vectors.shape[1]
        self.axes = np.random.default_rng(dim).standard_normal((dim + 1, PROJECTIONS))
        lift = np.sqrt(np.maximum(norm * norm - (vectors ** 2).sum(1), 0))
        points = vectors @ self.axes[:-1] + lift[:, None] * self.axes[-1]
        leaves, parts = [], [np.arange(len(vectors))]
        while parts:
            part = parts.pop()
            if len(part) <= LEAF:
                leaves.append(part)
                continue
            axis = int(np.ptp(points[part], axis=0).argmax())
            order = np.argpartition(points[part, axis], len(part) // 2)
            parts += [part[order[:len(part) // 2]], part[order[len(part) // 2:]]]
        self.order = np.concatenate(leaves)
        self.ends = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        self.vectors = vectors[self.order]
        self.low = np.stack([points[x].min(0) for x in leaves])
        self.high = np.stack([points[x].max(0) for x in leaves])

    def nearest(self, queries: np.ndarray, k: int, confidence: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores (-inf: none) of the k best found per query."""
        n, at = len(queries), queries @ self.axes[:-1]
        away = np.zeros((n, len(self.low)))
        for axis in range(PROJECTIONS):
            x = at[:, axis, None]
            away += np.maximum(np.maximum(self.low[:, axis] - x, x - self.high[:, axis]), 0) ** 2
        turn = np.argsort(away, 1, kind="stable")
        away = np.take_along_axis(away, turn, 1)
        best, where = np.full((n, k), -np.inf), np.full((n, k), -1)
        length = (queries ** 2).sum(1) + self.norm ** 2
        live = np.arange(n)
        for step in range(turn.shape[1]):
            worst = best[live].min(1)
            apart = np.maximum(length[live] - 2 * worst, 1e-300)         # squared distance of the k-th best
            live = live[~((worst > -np.inf) & (chi_square(away[live, step] / apart) >= confidence))]
            if not len(live):
                break
            leaf = turn[live, step]
            by = np.argsort(leaf, kind="stable")
            for group in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                rows, (a, b) = live[group], self.ends[leaf[group[0]]:leaf[group[0]] + 2]
                scores = np.concatenate([best[rows], queries[rows] @ self.vectors[a:b].T], 1)
                places = np.concatenate([where[rows], np.broadcast_to(self.order[a:b], (len(rows), b - a))], 1)
                top = np.argpartition(-scores, k - 1, 1)[:, :k]
                best[rows], where[rows] = np.take_along_axis(scores, top, 1), np.take_along_axis(places, top, 1)
        return where, best


def _search(k: int, confidence: float, norms: dict[int, float]):
    """Per partition: blocks of vectors, each followed by its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, tree, stored, ids = None, None, [], []
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            mark = np.stack([column("dim"), column("block"), column("query")], 1)
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(mark, axis=0) != 0).any(1)) + 1, [len(mark)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                dim, number, query = mark[a].tolist()
                if block != (dim, number):
                    block, tree, stored, ids = (dim, number), None, [], []
                vectors = batch.column("vector").slice(a, b - a).flatten().to_numpy().astype(np.float64).reshape(-1, dim)
                lists = batch.column("ids").slice(a, b - a)
                if not query:
                    stored.append(vectors)
                    ids += lists.to_pylist()
                    continue
                if not stored and tree is None:
                    continue
                if tree is None:
                    tree, stored = Tree(np.concatenate(stored), norms[dim]), []
                own = lists.flatten().to_numpy()
                for first in range(0, len(own), QUERY_BATCH):
                    yield _answer(tree, ids, own[first:first + QUERY_BATCH], vectors[first:first + QUERY_BATCH], k, confidence)

    return run


def _answer(tree: Tree, ids: list[list[int]], own: np.ndarray, vectors: np.ndarray, k: int, confidence: float) -> pa.RecordBatch:
    """The k best rows of one block for each query but the query itself."""
    where, best = tree.nearest(vectors, min(k + 1, len(ids)), confidence)
    out: tuple[list, list, list] = ([], [], [])
    for query, places, scores in zip(own.tolist(), where.tolist(), best.tolist(), strict=True):
        found = sorted((-s, i) for p, s in zip(places, scores, strict=True) if p >= 0 for i in ids[p] if i != query)[:k]
        out[0].extend([query] * len(found))
        out[1].extend(i for _, i in found)
        out[2].extend(-s for s, _ in found)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])


def search(table: DataFrame, every: int = 20, k: int = 20, confidence: float = CONFIDENCE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose key is divisible by
    ``every``, its k nearest other rows found (all, if fewer), ties to the
    smaller key.

    Takes no part: a null key; a vector that is null, empty, zero, or holds
    null or non-finite components.  Vectors of different lengths are never
    neighbours.  Equal vectors are stored once, with their k + 1 smallest keys
    (no answer can need more), so a very common vector costs no more than a
    rare one.  A repeated key counts once, with its best score.  An empty
    table gives no rows; other columns play no part.
    """
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(whole)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("norm")).collect()   # one row per vector length
    blocks = {r.dim: max(1, -(-r.n * r.dim // BLOCK_VALUES)) for r in sizes}
    count = F.coalesce(*[F.when(F.size("vector") == d, F.lit(n)) for d, n in blocks.items()], F.lit(1)).cast("int")
    by_vector = Window.partitionBy("vector").orderBy("id")
    classes = (rows.withColumn("r", F.dense_rank().over(by_vector)).where(F.col("r") <= k + 1)
               .groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    stored = classes.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), count).cast("int").alias("block"), F.lit(0).alias("query"), "ids", "vector")
    asked = (rows.where(F.col("id") % every == 0)
             .select(F.size("vector").alias("dim"), F.explode(F.sequence(F.lit(0), count - 1)).alias("block"), F.lit(1).alias("query"), F.array("id").alias("ids"), "vector"))
    offset, parts = {}, 0                               # each block has a partition of its own
    for d in sorted(blocks):
        offset[d], parts = parts, parts + blocks[d]
    first = F.coalesce(*[F.when(F.col("dim") == d, F.lit(n)) for d, n in offset.items()], F.lit(0))
    laid = stored.unionByName(asked).repartitionById(max(1, parts), (first + F.col("block")).cast("int")).sortWithinPartitions("dim", "block", "query")
    found = laid.mapInArrow(_search(k, confidence, {r.dim: r.norm for r in sizes}), "query_id bigint, vec_id bigint, score double")
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
