"""Exact search for the largest inner products: ball trees and branch and bound.

Vectors are dealt to shards of bounded size, queries to blocks. Every (shard, block) group builds
the shard's ball tree and goes down it for its queries together: the inner product of a query with
anything in a ball is at most q.c + |q| r, so balls below the query's current k-th score are left
out, and leaves are visited in the order of that bound. The k-th score found in a first shard is
shared with all others before they start, so they mostly prove that they hold nothing better.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import stored

SHARD_ROWS = 16_384
BLOCK_ROWS = 2_048
LEAF_ROWS = 128
NONE = np.iinfo(np.int64).min


def scaled(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component x of embedding, as integers.

    Vectors that are null or hold null or non-finite components, and null ids, are left out; rows
    that repeat an id count once, by the least of their vectors.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    return rows.select("vec_id", whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


class BallTree:
    """Balls over the rows of x: a node is a range of `order`, split at the middle of the direction
    between two far rows."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.centers, self.radii, self.ranges, self.children = [], [], [], []
        self._build(x, 0, len(x))
        self.centers = np.array(self.centers)
        self.radii = np.array(self.radii)
        self.ranges = np.array(self.ranges)
        self.children = np.array(self.children)

    def _build(self, x: np.ndarray, a: int, b: int) -> None:
        todo = [(a, b, -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            rows = x[self.order[a:b]]
            center = rows.mean(axis=0)
            distance = np.sqrt(((rows - center) ** 2).sum(axis=1))
            node = len(self.radii)
            self.centers.append(center)
            self.radii.append(float(distance.max()) * (1 + 1e-9))
            self.ranges.append((a, b))
            self.children.append([-1, -1])
            if parent >= 0:
                self.children[parent][side] = node
            if b - a > LEAF_ROWS and distance.max() > 0:
                far = rows[distance.argmax()]
                other = rows[((rows - far) ** 2).sum(axis=1).argmax()]
                along = rows @ (other - far)
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(along, middle)]
                todo += [(a, a + middle, node, 0), (a + middle, b, node, 1)]


class Best:
    """The k best (score, id) of each query, ties to the smaller id."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.scores = np.full((n, k), NONE)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.least = least  # the k-th score known from elsewhere

    def kth(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.least)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: a row for each of queries, a column for each of ids; NONE is no candidate."""
        s = np.hstack([self.scores[queries], scores])
        i = np.hstack([self.ids[queries], np.broadcast_to(ids, scores.shape)])
        # only what reaches the k-th score can enter
        order = np.lexsort((i, ~s), axis=1)[:, : self.scores.shape[1]]
        self.scores[queries] = np.take_along_axis(s, order, axis=1)
        self.ids[queries] = np.take_along_axis(i, order, axis=1)


def search(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray) -> Best:
    """Best of the rows of x (integers) for each query, except its own id, at `least` or above."""
    best = Best(len(queries), k, least)
    qf, xf = queries.astype(float), x.astype(float)
    exact = np.abs(qf).max(initial=0) * np.abs(xf).max(initial=0) * x.shape[1] < 2**52
    tree = BallTree(xf)
    norms = np.sqrt((qf**2).sum(axis=1))
    pairs = np.stack([np.arange(len(queries)), np.zeros(len(queries), np.int64)], axis=1)
    leaves, bounds = [], []
    while len(pairs):
        q, node = pairs.T
        bound = np.einsum("ij,ij->i", qf[q], tree.centers[node]) + norms[q] * tree.radii[node]
        bound += 1 + 1e-9 * np.abs(bound)  # over any error of rounding
        near = bound >= best.kth()[q]
        q, node, bound = q[near], node[near], bound[near]
        child = tree.children[node]
        leaf = child[:, 0] < 0
        leaves.append(np.stack([q[leaf], node[leaf]], axis=1))
        bounds.append(bound[leaf])
        pairs = np.concatenate([np.stack([q[~leaf], child[~leaf, side]], axis=1) for side in (0, 1)])
    leaves, bounds = np.concatenate(leaves), np.concatenate(bounds)
    while len(leaves):
        order = np.lexsort((-bounds, leaves[:, 0]))
        leaves, bounds = leaves[order], bounds[order]
        first = np.ones(len(leaves), bool)
        first[1:] = leaves[1:, 0] != leaves[:-1, 0]  # the best leaf of each query
        q, node = leaves[first].T
        for n in np.unique(node).tolist():
            mine = q[node == n]
            rows = tree.order[tree.ranges[n][0] : tree.ranges[n][1]]
            scores = (qf[mine] @ xf[rows].T).astype(np.int64) if exact else queries[mine] @ x[rows].T
            scores[query_ids[mine][:, None] == ids[rows]] = NONE
            best.add(mine, scores, ids[rows])
        leaves, bounds = leaves[~first], bounds[~first]
        near = bounds >= best.kth()[leaves[:, 0]]
        leaves, bounds = leaves[near], bounds[near]
    return best


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter vectors filled with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.asarray(lists.value_lengths())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _group(table: pa.Table, k: int) -> pa.Table:
    width = int(max(np.asarray(table.column("v").combine_chunks().value_lengths()), default=0))
    is_query = table.column("is_query").to_numpy()
    ids, least = table.column("vec_id").to_numpy(), table.column("least").to_numpy()
    v = _matrix(table.column("v"), width)
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
    if is_query.any() and not is_query.all():
        best = search(v[is_query], ids[is_query], v[~is_query], ids[~is_query], k, least[is_query])
        real = (best.scores != NONE) & (best.scores >= best.least[:, None])
        q, place = np.nonzero(real)
        out = [ids[is_query][q], best.ids[q, place], best.scores[q, place]]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, out))))


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries (vec_id, v) the k rows of vectors
    (vec_id, v) with the largest integer inner product, ties to the smaller vec_id, its own id
    excepted; fewer when there are fewer. Components missing in a shorter vector count as zero. No
    vectors or no queries give an empty table."""
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    hashed = F.xxhash64("vec_id")
    dealt = vectors.select("vec_id", "v", F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"))
    asked = queries.select("vec_id", "v", F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"))
    kind = "query_id long, vec_id long, score long"

    def searched(candidates: DataFrame, asking: DataFrame) -> DataFrame:
        every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        there = candidates.select(
            "shard", every_block, "vec_id", "v", F.lit(False).alias("is_query"), F.lit(NONE).alias("least")
        )
        both = there.unionByName(asking.select("shard", "block", "vec_id", "v", F.lit(True).alias("is_query"), "least"))
        return both.groupBy("shard", "block").applyInArrow(lambda table: _group(table, k), kind)

    first = asked.withColumns({"shard": F.pmod("block", F.lit(shards)), "least": F.lit(NONE)})
    seen = stored(searched(dealt, first), "first-shard")
    known = (
        seen.groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").alias("least"))
        .select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(NONE)).alias("least"))
    )
    others = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    rest = asked.join(known, "vec_id", "left").select(
        others, "block", "vec_id", "v", F.coalesce("least", F.lit(NONE)).alias("least")
    )
    rest = rest.filter(F.col("shard") != F.pmod("block", F.lit(shards)))
    found = seen if shards == 1 else seen.unionByName(searched(dealt, rest))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
