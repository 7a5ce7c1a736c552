"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter is a direction; a vector belongs to it when their inner product exceeds a bound, that is when
it lies in the cap around the direction. The directions of one table are a product code: a random
rotation, then the dimensions in m parts with b random directions each, which makes b**m filters out of
m b. A vector finds all filters that it exceeds by list decoding: part by part, keeping only beginnings
that the best remaining parts can still lift over the bound.

The bound lets a vector into LISTED filters of a table on average, and b grows with the number of
vectors, so that a filter holds few vectors that are not alike. The share of pairs just at the
threshold that a table brings together is the same for every such pair (the rotation is random); it is
measured once on random pairs, and the number of tables follows from the share of such pairs that may
be missed.

Equal vectors are one class. First only the signs of each class on 128 random planes go to its filters:
a class stays in a filter when another one there has nearly the same signs. Classes that still share
filters meet in the least filter they share, where they are verified by their cosine. Large filters are cut into blocks and every pair of blocks is a task of
its own. A task sends, per class, the number of its links and one class it is connected with, never the
pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, shuffle_parts, stored
from corpusloom.llm.components import connected
from corpusloom.operators.joins import salted_lookup, small

LISTED = 2.2  # filters of a table that a vector belongs to, on average
MISS = 1e-5  # share of pairs just at the threshold that may be missed
PARTS_BASE = 1_024  # directions of a part at most, beyond that there are more parts
BLOCK = 1_024  # classes of a filter that are compared in one task with as many
DECODED = 2_048  # vectors that are decoded at once
SMALL = 48  # filters up to this many classes are verified many at once


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; no row is zero. Scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class ProductCode:
    """Tables of filters for vectors of one length."""

    def __init__(self, dims: int, vectors: int, threshold: float, number: int = 0, seed: int = 13, miss: float = MISS):
        self.dims, self.seed, self.start = dims, seed, number << 48  # filters of two codes have different names
        wanted = max(LISTED * vectors, 4_096)
        parts = 2
        while wanted ** (1 / parts) > PARTS_BASE:
            parts += 1
        self.parts = min(parts, max(1, dims // 4))
        self.base = min(math.ceil(wanted ** (1 / self.parts)), PARTS_BASE, 8 << min(dims, 7))  # few dimensions have few directions
        self.filters = self.base**self.parts
        self.edges = [dims * i // self.parts for i in range(self.parts + 1)]
        rng = np.random.default_rng([seed, dims])
        self.bound = self._bound(_units(rng.normal(size=(256, dims))))
        hit = self._hit(rng, threshold)
        while hit < 0.3 and dims < 16 and self.bound > 0.1:  # in few dimensions small caps hold no neighbours
            self.bound *= 0.9
            hit = self._hit(rng, threshold)
        self.tables = max(1, math.ceil(math.log(miss) / math.log1p(-min(max(hit, 0.01), 0.999))))

    @lru_cache(maxsize=256)  # noqa: B019 (a code lives as long as its task)
    def _table(self, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
        rng = np.random.default_rng([self.seed, self.dims, number])
        turn = np.linalg.qr(rng.normal(size=(self.dims, self.dims)))[0]
        parts = [_units(rng.normal(size=(self.base, b - a))) for a, b in zip(self.edges, self.edges[1:])]
        return turn, [p * math.sqrt(self.dims / self.parts) for p in parts]

    def decode(self, units: np.ndarray, number: int, bound: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter of every filter of a table that a row of units exceeds."""
        bound = self.bound if bound is None else bound
        turn, code = self._table(number)
        turned = units @ turn
        scores = [turned[:, a:b] @ c.T for a, b, c in zip(self.edges, self.edges[1:], code)]
        rest = np.zeros((self.parts + 1, len(units)))
        for i in range(self.parts - 1, -1, -1):
            rest[i] = rest[i + 1] + scores[i].max(axis=1)
        row, so_far, name = np.arange(len(units)), np.zeros(len(units)), np.zeros(len(units), np.int64)
        for i, s in enumerate(scores):
            reached = so_far[:, None] + s[row]
            at, word = np.nonzero(reached >= (bound - rest[i + 1][row])[:, None])
            so_far, name, row = reached[at, word], name[at] * self.base + word, row[at]
        return row, name + (self.start + number * self.filters)

    def _bound(self, units: np.ndarray) -> float:
        """The bound at which tables list LISTED filters a vector."""
        aim = NormalDist().inv_cdf(1 - min(LISTED / self.filters, 0.4))
        low, high = 0.0, aim * 1.5
        for _ in range(16):
            middle = (low + high) / 2
            listed = sum(len(self.decode(units, t, middle)[0]) for t in range(8)) / (8 * len(units))
            low, high = (middle, high) if listed > LISTED else (low, middle)
        return low

    def _hit(self, rng: np.random.Generator, threshold: float) -> float:
        """Share of random pairs at the threshold that share a filter of a table."""
        x = _units(rng.normal(size=(512, self.dims)))
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(axis=1, keepdims=True) * x
        length = np.sqrt((away**2).sum(axis=1, keepdims=True))
        y = threshold * x + math.sqrt(1 - threshold**2) * away / np.where(length > 0, length, 1)
        found = 0
        for t in range(12):
            (i, f), (j, g) = self.decode(x, t), self.decode(y, t)
            both = np.intersect1d(f * len(x) + i, g * len(x) + j)
            found += len(np.unique(both % len(x)))
        return found / (12 * len(x))

    def signs(self, units: np.ndarray) -> np.ndarray:
        """Two words of signs of each row: on which side of 128 random planes it lies."""
        rng = np.random.default_rng([self.seed, self.dims, 1 << 20])
        sides = units @ rng.normal(size=(self.dims, 128)) > 0
        return np.packbits(sides, axis=1).view(np.int64)

    def lists(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter of all tables."""
        found = [self.decode(units, t) for t in range(self.tables)]
        return np.concatenate([r for r, _ in found]), np.concatenate([f for _, f in found])


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length and their vectors as a matrix of units."""
    lengths = np.asarray(column.value_lengths())
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        yield at, _units(column.take(pa.array(at)).flatten().to_numpy().reshape(len(at), n))


def _filters(batches: Batches, codes: dict[int, ProductCode]) -> Batches:
    """class, filter and signs for every filter that a class belongs to."""
    for batch in batches:
        keys = batch.column("class").to_numpy()
        for at, units in _by_length(batch.column("v")):
            code = codes[units.shape[1]]
            for start in range(0, len(at), DECODED):
                row, name = code.lists(units[start : start + DECODED])
                signs = code.signs(units[start : start + DECODED])[row]
                columns = [pa.array(c) for c in (keys[at[start + row]], name, signs[:, 0].copy(), signs[:, 1].copy())]
                yield pa.record_batch(columns, names=["class", "filter", "s0", "s1"])


def _least(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after every connected set has taken its least one."""
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        labels = labels[labels]
        if (labels == before).all():
            return labels


def _small_groups(units: np.ndarray, earlier: list[np.ndarray], start: np.ndarray, stop: np.ndarray, threshold: float):
    """Pairs of rows of the groups start:stop that are linked, and which of them no earlier filter holds."""
    a, b = _pairs_inside(start, stop)
    near = np.zeros(len(a), bool)
    for at in range(0, len(a), 16_384):
        cut = slice(at, at + 16_384)
        near[cut] = np.einsum("ij,ij->i", units[a[cut]], units[b[cut]]) >= threshold
    a, b = a[near], b[near]
    sets = {r: set(earlier[r].tolist()) for r in np.unique(np.concatenate([a, b])).tolist()}
    first = np.array([sets[x].isdisjoint(sets[y]) for x, y in zip(a.tolist(), b.tolist())], bool)
    return a, b, first


def _shared_filters(earlier: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each row of left shares an earlier filter with each row of right."""
    lists = [[earlier[r] for r in side.tolist()] for side in (left, right)]
    both = np.intersect1d(*(np.concatenate(x) for x in lists))
    sides = []
    for side in lists:
        flat = np.concatenate(side)
        owner = np.repeat(np.arange(len(side)), [len(x) for x in side])
        known = np.isin(flat, both)
        has = np.zeros((len(side), len(both)), np.float32)
        has[owner[known], np.searchsorted(both, flat[known])] = 1
        sides.append(has)
    return sides[0] @ sides[1].T > 0


def _block_pair(units: np.ndarray, earlier: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float):
    """The same for the pairs between the rows of left and of right; inside left when both are one."""
    near = units[left] @ units[right].T >= threshold
    if left is right:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    return left[i], right[j], ~_shared_filters(earlier, left, right)[i, j]


def _verify(table: pa.Table, threshold: float) -> pa.Table:
    """Per class with links in this group: class, links (copies of the other class counted, each pair
    where it meets first), other (a class of the same component, or itself)."""
    table = table.sort_by([(c, "ascending") for c in ("filter", "class")])
    column = {c: table.column(c).combine_chunks() for c in table.column_names}
    keys, sizes, blocks, filters = (column[c].to_numpy() for c in ("class", "size", "block", "filter"))
    offsets, flat = np.asarray(column["earlier"].offsets).tolist(), column["earlier"].values.to_numpy()
    earlier = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
    edge = np.flatnonzero(filters[1:] != filters[:-1]) + 1
    start, stop = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
    for at, part in _by_length(column["v"]):
        units = np.zeros((len(keys), part.shape[1]))
        units[at] = part
        mine = np.isin(start, at)  # the vectors of a filter have one length
        small = mine & (stop - start <= SMALL) & (i == j)
        found.append(_small_groups(units, earlier, start[small], stop[small], threshold))
        for s, e in zip(start[mine & ~small].tolist(), stop[mine & ~small].tolist()):
            left = s + np.flatnonzero(blocks[s:e] == i)
            right = left if i == j else s + np.flatnonzero(blocks[s:e] == j)
            if len(left) and len(right):
                found.append(_block_pair(units, earlier, left, right, threshold))
    a, b, first = (np.concatenate(x) for x in zip(*found))
    links = np.zeros(len(keys), np.int64)
    np.add.at(links, a[first], sizes[b[first]])
    np.add.at(links, b[first], sizes[a[first]])
    labels = _least(np.arange(len(keys)), a, b)
    used = np.unique(np.concatenate([a, b]))
    return pa.table({"class": keys[used], "links": links[used], "other": keys[labels[used]]})


def _usable(v: str = "v"):
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(v).isNotNull() & F.col("vec_id").isNotNull() & fine & F.exists(v, lambda x: x != 0)


def most_signs(threshold: float, planes: int = 128) -> int:
    """Planes that may part two vectors at the threshold, with a chance below 1e-9 of more."""
    p = math.acos(threshold) / math.pi
    tail, k = 1.0, 0
    while tail > 1e-9:
        tail -= math.comb(planes, k) * p**k * (1 - p) ** (planes - k)
        k += 1
    return k - 1


def _near_signs(table: pa.Table, most: int) -> pa.Table:
    """class, filter of the rows of a group with signs near those of another row of their filter."""
    table = table.sort_by([("filter", "ascending"), ("class", "ascending")])
    keys, filters, block = (table.column(c).to_numpy() for c in ("class", "filter", "block"))
    signs = np.stack([table.column(c).to_numpy() for c in ("s0", "s1")], axis=1)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    edge = np.flatnonzero(filters[1:] != filters[:-1]) + 1
    start, stop = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
    near = np.zeros(len(keys), bool)

    def compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=-1) <= most

    small = (stop - start > 1) & (stop - start <= SMALL) & (i == j)
    a, b = _pairs_inside(start[small], stop[small])
    for at in range(0, len(a), 1 << 18):
        x, y = a[at : at + (1 << 18)], b[at : at + (1 << 18)]
        hit = compare(signs[x], signs[y])
        near[x[hit]] = near[y[hit]] = True
    large = (stop - start > SMALL) | ((i != j) & (stop - start > 1))
    for s, e in zip(start[large].tolist(), stop[large].tolist()):
        left = s + np.flatnonzero(block[s:e] == i)
        right = left if i == j else s + np.flatnonzero(block[s:e] == j)
        hit = compare(signs[left][:, None], signs[right][None])
        if i == j:
            np.fill_diagonal(hit, False)
        near[left[hit.any(axis=1)]] = near[right[hit.any(axis=0)]] = True
    return pa.table({"class": keys[near], "filter": filters[near]})


def _pairs_inside(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows a < b of the groups start:stop."""
    size = stop - start
    group = np.repeat(np.arange(len(start)), size)
    row = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    later = stop[group] - row - 1  # each row goes with the rows after it in its group
    a = np.repeat(row, later)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)


def _blocks_of(rows: DataFrame, total: int) -> DataFrame:
    """rows (class, filter, n) once per pair of blocks of their filter, with block, bin, i, j. Filters of
    one block share groups by hash, pairs of blocks of a larger filter are a group each."""
    bins = max(1, -(-total // (4 * BLOCK)))
    blocks = F.ceil(F.col("n") / BLOCK)
    every = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda b: F.struct(F.least(F.col("block"), b).alias("i"), F.greatest(F.col("block"), b).alias("j")),
    )
    bin_ = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("filter"), F.lit(bins))).otherwise(-F.col("filter") - 1)
    cut = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    return cut.withColumn("bin", bin_).withColumn("p", F.explode(every)).select("*", "p.i", "p.j").drop("p", "blocks", "n")


def _plausible(filed: DataFrame, threshold: float) -> DataFrame:
    """class, filter of filed where another class of the filter has similar signs. Only signs are sent
    to the filters; vectors follow to those that are left."""
    total = filed.count()
    large = stored(filed.groupBy("filter").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK), "large-filters")
    sized = filed.join(small(large), "filter", "left").withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
    most = most_signs(threshold)
    near = _blocks_of(sized, total).groupBy("bin", "i", "j").applyInArrow(lambda t: _near_signs(t, most), "class long, filter long")
    # a row of a large filter is seen once per pair of blocks
    return stored(near.distinct(), "plausible")


def _met(filed: DataFrame, classes: DataFrame) -> tuple[DataFrame, int]:
    """class, size, v, filters (filter and its number of classes, ascending) of the classes that share
    filters with others; and how many such (class, filter) there are."""
    sizes = stored(filed.groupBy("filter").agg(F.count("*").alias("n")).filter("n > 1"), "filter-sizes")
    rows = sizes.agg(F.sum("n")).first()[0] or 0
    if not rows:
        return classes.select("class", "size", "v", F.array(F.struct(F.lit(0).cast("long").alias("filter"), F.lit(0).cast("long").alias("n"))).alias("filters")).limit(0), 0
    shared = salted_lookup(filed, sizes, "filter", "n", F.col("class"))
    lists = shared.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("filter", "n"))).alias("filters"))
    return classes.join(lists, "class").select("class", "size", "v", "filters"), rows


def _meetings(met: DataFrame, rows: int) -> DataFrame:
    """One row per class, filter and pair of blocks that the class takes part in."""
    each = met.select("class", "size", "v", "filters", F.posexplode("filters").alias("at", "f"))
    cut = each.select(
        "class", "size", "v", F.col("f")["filter"].alias("filter"), F.col("f")["n"].alias("n"),
        F.transform(F.slice("filters", F.lit(1), F.col("at")), lambda x: x["filter"]).alias("earlier"),
    )
    return _blocks_of(cut, rows)


def linked_vectors(vectors: DataFrame, threshold: float = 0.95, miss: float = MISS) -> DataFrame:
    """Per row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors are linked when their cosine is at least the threshold, which is above 0; component_id is
    the least vec_id that links reach, kept marks that vector. Vectors that are null or zero or hold
    null or non-finite components are linked with nothing, nor are vectors of different lengths. Rows
    that repeat a vec_id are vectors of their own. A row without vec_id is linked with nothing, has no
    component_id and is kept. Other columns are ignored, an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    usable = rows.filter(_usable())
    same = usable.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("size"))
    classes = stored(same.select(F.monotonically_increasing_id().alias("class"), "id", "size", "v"), "vector-classes")
    lengths = classes.groupBy(F.size("v").alias("length")).count().orderBy("length").collect()  # one row per length
    codes = {r["length"]: ProductCode(r["length"], r["count"], threshold, i, miss=miss) for i, r in enumerate(lengths)}
    spread = classes.select("class", "v").repartition(shuffle_parts(spark))  # decoding is the work, not the reading
    filed = stored(mapped(spread, partial(_filters, codes=codes), "class long, filter long, s0 long, s1 long"), "filters")
    met, n = _met(_plausible(filed, threshold), classes)
    found = stored(
        _meetings(met, n).groupBy("bin", "i", "j").applyInArrow(lambda t: _verify(t, threshold), "class long, links long, other long"),
        "found-links",
    )
    arcs = found.filter("class <> other").select(F.col("class").alias("a"), F.col("other").alias("b"))
    labels = connected(arcs)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = stored(
        classes.join(links, "class", "left")
        .join(labels.withColumnRenamed("id", "class"), "class", "left")
        .select("v", "id", "size", F.coalesce("label", "class").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")),
        "linked-classes",
    )
    least = named.groupBy("label").agg(F.min("id").alias("component_id"), F.count("*").alias("rows"))
    placed = salted_lookup(named, least, "label", "rows", F.col("id")).select("v", "size", "n_links", "component_id")
    back = salted_lookup(usable, placed, "v", "size", F.col("vec_id")).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(_usable(), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return back.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
