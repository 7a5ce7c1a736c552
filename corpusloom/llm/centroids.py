"""Exact centroid clustering with the equal-average equal-variance search.

Vectors of integers are assigned to their nearest centroid by squared Euclidean distance, ties to the
smaller number. Centroids are sorted by the sum of their components. Each vector starts at its own sum
and goes outward, always to the side whose sum is nearer. With sums S, deviations V from the mean
(lengths) and d components,

    |x - c|^2  >=  (S_x - S_c)^2 / d  +  (V_x - V_c)^2

so the scan of a vector ends when the first term alone is above its best distance, and a centroid is
rejected without its components when both terms are. What is left is computed in whole numbers. The
bounds are rounded down, so rejecting never loses a nearest centroid.

A round is one pass over the vectors: every task sends one row of sums per centroid, and only the
centroids (k x d numbers) come to the driver.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, stored

LONG = 2**63 - 1
MOST = 2**62  # components beyond count as this


def whole_vectors(vectors: DataFrame, dims: int = 64, scale: int = 1024) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component x of embedding, for the vectors of exactly
    `dims` components that are all finite. Other columns are ignored."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(
        "embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(-float(MOST))))
    )
    rows = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dims)).filter(fine)
    return rows.select("vec_id", scaled.alias("v"))


class Centroids:
    """Centroids in the order of their sums, ready for the search."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.dims = len(rows[0])
        sums = [sum(c) for c in rows]
        self.order = sorted(range(len(rows)), key=lambda i: (sums[i], i))
        self.most = max((abs(x) for c in rows for x in c), default=0)
        if self.most < self.safe:
            self.c = np.array(rows, np.int64)[self.order]
            self.numbers = np.array(self.order)
            self.sums, self.deviations = self._shape(self.c)

    @property
    def safe(self) -> float:
        """Magnitudes below this keep every squared distance within 64 bits."""
        return (2**62 / self.dims) ** 0.5 / 2

    def _shape(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = x.sum(axis=1)
        rest = (x.astype(float) - (sums / self.dims)[:, None]) ** 2
        return sums, np.sqrt(rest.sum(axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each row of x (integers), its squared distance, and how
        many distances were computed."""
        if self.most >= self.safe or np.abs(x).max(initial=0) >= self.safe:
            return self._large(x)
        k, n = len(self.order), len(x)
        sums, deviations = self._shape(x)
        high = np.searchsorted(self.sums, sums)  # next centroid above, next one below
        low = high - 1
        best = np.full(n, LONG)
        number = np.full(n, k)
        alive = np.arange(n)
        computed = 0
        while len(alive):
            up, down = high[alive], low[alive]
            above = np.where(up < k, np.abs(self.sums[np.minimum(up, k - 1)] - sums[alive]), LONG)
            below = np.where(down >= 0, np.abs(self.sums[np.maximum(down, 0)] - sums[alive]), LONG)
            rise = above < below
            at, gap = np.where(rise, up, down), np.where(rise, above, below)
            bound = gap.astype(float) ** 2 / self.dims
            go = (gap < LONG) & (bound * (1 - 1e-9) - 1 <= best[alive])
            alive, at, rise, bound = alive[go], at[go], rise[go], bound[go]
            high[alive] += rise
            low[alive] -= ~rise
            both = bound + (deviations[alive] - self.deviations[at]) ** 2
            near = both * (1 - 1e-9) - 1 <= best[alive]
            rows, cells = alive[near], at[near]
            computed += len(rows)
            distance = ((x[rows] - self.c[cells]) ** 2).sum(axis=1)
            names = self.numbers[cells]
            better = (distance < best[rows]) | ((distance == best[rows]) & (names < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], names[better]
        return number, best, computed

    def _large(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The same in unbounded integers, for components too large for 64-bit squares."""
        number, best = [], []
        for row in x.tolist():
            distance, name = min((sum((a - b) ** 2 for a, b in zip(row, c)), i) for i, c in enumerate(self.rows))
            number.append(name)
            best.append(distance)
        return np.array(number, np.int64), np.array(best, object), len(x) * len(self.rows)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims)


def _sums(batches: Batches, centroids: Centroids) -> Batches:
    """Per centroid with vectors in this task: their number and sums, as decimal strings."""
    total = [[0] * centroids.dims for _ in centroids.rows]
    count = [0] * len(centroids.rows)
    for batch in batches:
        x = _matrix(batch.column("v"), centroids.dims)
        number = centroids.nearest(x)[0]
        for c in np.unique(number).tolist():
            mine = x[number == c]
            kind = object if np.abs(mine).max() > 2**40 else np.int64
            total[c] = [a + b for a, b in zip(total[c], mine.sum(axis=0, dtype=kind).tolist())]
            count[c] += len(mine)
    used = [c for c, n in enumerate(count) if n]
    arrays = [
        pa.array(used, pa.int32()), pa.array([count[c] for c in used], pa.int64()),
        pa.array([[str(x) for x in total[c]] for c in used], pa.list_(pa.string())),
    ]
    yield pa.record_batch(arrays, names=["cluster", "n", "sums"])


def _assign(batches: Batches, centroids: Centroids) -> Batches:
    for batch in batches:
        number, best, _ = centroids.nearest(_matrix(batch.column("v"), centroids.dims))
        distance = [int(x) if x <= LONG else None for x in best.tolist()]
        arrays = [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())]
        yield pa.record_batch(arrays, names=["vec_id", "cluster", "distance"])


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of `seed:vec_id`, in the order of the hashes."""
    name = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    hashed = vectors.filter("vec_id is not null").select(F.sha2(name, 256).alias("h"), "v")
    return [list(r["v"]) for r in hashed.orderBy("h", "v").limit(k).collect()]


def next_centroids(vectors: DataFrame, now: Centroids) -> list[list[int]]:
    """Each centroid replaced by the floor of the mean of its vectors; empty ones stay."""
    sums = mapped(vectors.select("v"), partial(_sums, centroids=now), "cluster int, n long, sums array<string>")
    cells = sums.select("cluster", "n", F.posexplode("sums").alias("at", "s"))
    total = cells.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = [list(c) for c in now.rows]
    for r in total.collect():  # k x d numbers
        rows[r["cluster"]][r["at"]] = int(r["s"]) // r["n"]
    return rows


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> tuple[DataFrame, list[list[int]]]:
    """Per row of vectors (vec_id, v of one length): vec_id, cluster, distance (squared, to the final
    centroid); and the centroids, by number.

    Rows that repeat an id are vectors of their own. A vector without id is assigned and counts, but
    starts no centroid. With fewer than k ids there are fewer centroids, with none the result is
    empty. A distance that no long can hold is null.
    """
    rows = first_centroids(vectors, k, seed)
    kind = "vec_id long, cluster int, distance long"
    if not rows:
        return vectors.sparkSession.createDataFrame([], kind), []
    for _ in range(rounds):
        rows = next_centroids(vectors, Centroids(rows))
    return mapped(vectors.select("vec_id", "v"), partial(_assign, centroids=Centroids(rows)), kind), rows


def cluster_report(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """The rows of `cluster` with cluster_inertia and inertia (sums of distances over the cluster and
    over all; null when a distance or the sum fits no long) and centroid_sha256."""
    found, rows = cluster(vectors, k, rounds, seed)
    assigned = stored(found, "assigned")
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    parts = {r["cluster"]: r["part"] for r in assigned.groupBy("cluster").agg(total.alias("part")).collect()}  # k rows
    every = None if None in parts.values() else _long(sum(parts.values()))
    notes = [
        (c, _long(part), every, hashlib.sha256(",".join(map(str, rows[c])).encode()).hexdigest()) for c, part in parts.items()
    ]
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    named = vectors.sparkSession.createDataFrame(notes, kind)
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(x) -> int | None:
    return int(x) if x is not None and x <= LONG else None
