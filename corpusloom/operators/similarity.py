"""Nearest neighbours of document vectors, exactly and without all pairs.

Vectors are reduced to unit length (after centring for Pearson), where angles obey the
triangle inequality. Every vector goes to the cell of its nearest pivot; cells are cut
into blocks of bounded size. A block is first searched against one block of its own
cell, which gives each vector a k-th best similarity so far. A pair of cells is then
visited only if the angle between them, less both radii, can still beat it; the bound
is exact, so nothing is lost. Copies of a vector are searched once and expanded at the
end, so a vector with very many copies costs as much as one.

Many blocks on the left share a task (a tile), through which the blocks on the right pass
one by one, so a block is sent once per tile and not once per pair of blocks. Single
precision rules out almost all pairs there; what it leaves is compared in double.

What reaches the driver: at most MAX_PIVOTS pivots and cell summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions.text import unit_hash
from corpusloom.operators.joins import salted_lookup
from corpusloom.operators.lineage import cut

MAX_PIVOTS = 2048
BLOCK = 1024
TILE = 64  # blocks on the left that a task holds, about 50 MB with 64 components
STREAM = 128  # blocks on the right that pass through a task
STRIP = 4096  # rows of a tile that are multiplied at once
SINGLE = 1e-5  # how far a product in single precision may be off
DIGITS = 9
NOTHING = -1e30
MEASURES = ("cosine", "pearson", "ejaccard")


def _by_i():
    return Window.partitionBy("i").orderBy(F.desc("s"), "j")


def _matrix(rows) -> np.ndarray:
    return np.array([np.asarray(r, dtype=np.float64) for r in rows])


def _unit(m: np.ndarray, measure: str) -> tuple[np.ndarray, np.ndarray]:
    if measure == "pearson":
        m = m - m.mean(axis=1, keepdims=True)
    norms = np.sqrt((m * m).sum(axis=1))
    return m / np.where(norms > 0, norms, 1.0)[:, None], norms


def _scores(left, left_norms, right, right_norms, measure: str) -> np.ndarray:
    return _of_cosines(left @ right.T, left_norms[:, None], right_norms[None, :], measure)


def _of_cosines(cos: np.ndarray, left_norms, right_norms, measure: str) -> np.ndarray:
    if measure != "ejaccard":
        return np.round(cos, DIGITS)
    dot = cos * left_norms * right_norms
    rest = left_norms**2 + right_norms**2 - dot
    return np.round(np.divide(dot, rest, out=np.zeros_like(dot), where=rest > 0), DIGITS)


def _least_cosine(s: np.ndarray, measure: str) -> np.ndarray:
    """Smallest cosine with which a similarity s can be reached."""
    if measure != "ejaccard":
        return s
    return np.where(s > 0, 2 * s / (1 + s), -1.0)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _assign(df: DataFrame, pivots: np.ndarray, measure: str, extra: str = "") -> DataFrame:
    """Unit vector, norm, cell and angle to the pivot for each (id, vec)."""
    names = [c for c in df.columns if c != "vec"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            unit, norms = _unit(_matrix(pdf["vec"]), measure)
            angles = _angles(unit, pivots)
            cell = angles.argmin(axis=1)
            out = pdf[names].copy()
            out["unit"] = list(unit)
            out["norm"] = norms
            out["cell"] = cell.astype("int32")
            out["angle"] = angles[np.arange(len(cell)), cell]
            yield out

    return df.mapInPandas(
        run, f"id bigint{extra}, unit array<double>, norm double, cell int, angle double"
    )


def _pick_pivots(df: DataFrame, n: int, measure: str) -> np.ndarray:
    """One vector per block of rows, in the order of a hash: a bounded driver-side sample."""
    want = int(min(MAX_PIVOTS, -(-n // BLOCK)))
    rows = df.orderBy(unit_hash(1, F.col("id"))).limit(want).select("vec").collect()
    return _unit(_matrix([r["vec"] for r in rows]), measure)[0]


def _blocks(assigned: DataFrame, sizes: dict[int, int], extra: tuple[str, ...] = ()) -> DataFrame:
    """(cell, *extra, chunk, ids, mat, norms): at most about BLOCK vectors in a row."""
    parts = assigned.sparkSession.createDataFrame(
        [(int(c), max(1, -(-int(n) // BLOCK))) for c, n in sizes.items()], "cell int, _parts int"
    )
    placed = assigned.join(F.broadcast(parts), "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")
    )
    packed = placed.groupBy("cell", *extra, "chunk").agg(
        F.sort_array(F.collect_list(F.struct("id", "norm", "unit"))).alias("_m")
    )
    return packed.select(
        "cell",
        *extra,
        "chunk",
        F.transform("_m", lambda x: x["id"]).alias("ids"),
        F.transform("_m", lambda x: x["norm"]).alias("norms"),
        F.flatten(F.transform("_m", lambda x: x["unit"])).alias("mat"),
    )


def _cells(assigned: DataFrame) -> dict[int, tuple[int, float]]:
    rows = assigned.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")
    ).collect()
    return {r["cell"]: (r["n"], r["radius"]) for r in rows}


def _cell_pairs(spark, left, right, pivots: np.ndarray, visit) -> DataFrame:
    """(cell, other) for which visit(angle between pivots, left index, right cells) holds.

    Computed where the rows are; `left` is the list of left cells.
    """
    others = np.array(sorted(right), dtype=int)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c in pdf["cell"]:
                ok = visit(_angles(pivots[[c]], pivots[others])[0], int(c), others)
                hit = others[ok]
                yield pd.DataFrame({"cell": np.full(len(hit), c), "other": hit})

    cells = spark.createDataFrame([(int(c),) for c in sorted(left)], "cell int")
    return cells.mapInPandas(run, "cell int, other int")


def _side(blocks: DataFrame, prefix: str, *names: str) -> DataFrame:
    return blocks.select(*[F.col(n).alias(f"{prefix}{n}") for n in names])


def vector_content() -> Column:
    return F.sha2(F.array_join(F.col("vec").cast("array<string>"), " "), 256)


def distinct_rows(
    df: DataFrame, content: Column, keep: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Split rows with an id into one representative per distinct content and the copies.

    Returns reps (id, copies), the rows of the representatives, members (rep, members:
    the `keep` smallest ids of a copied row), and twins (id, rep) of copied rows.
    """
    keyed = df.select("id", content.alias("_key"))
    groups = cut(
        keyed.groupBy("_key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    copied = groups.where(F.col("copies") > 1)
    twins = salted_lookup(keyed, copied, "_key", "copies", F.col("id")).select("id", "rep")
    w = Window.partitionBy("rep").orderBy("id")
    members = (
        twins.withColumn("_r", F.row_number().over(w))
        .where(F.col("_r") <= keep)
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list("id")).alias("members"))
    )
    reps = groups.select(F.col("rep").alias("id"), "copies")
    return reps, df.join(reps, "id", "left_semi"), members, twins


def neighbours(
    candidates: DataFrame,
    k: int,
    measure: str = "cosine",
    queries: DataFrame | None = None,
) -> DataFrame:
    """(i, j, s, rank): the k most similar candidates j of every i, ties by j.

    Both inputs are (id, vec). Without `queries` each candidate looks for the others.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    spark = candidates.sparkSession
    own = queries is None
    candidates = candidates.select("id", F.col("vec").cast("array<double>").alias("vec"))
    reps, vectors, members, twins = distinct_rows(candidates, vector_content(), k + 1)
    pivots = _pick_pivots(vectors, reps.count(), measure)
    right = cut(_assign(vectors, pivots, measure))
    right_cells = _cells(right)
    r_blocks = cut(_blocks(right, {c: n for c, (n, _) in right_cells.items()}))
    if own:
        q_reps, q_twins, left, left_cells, l_blocks = reps, twins, right, right_cells, r_blocks
    else:
        queries = queries.select("id", F.col("vec").cast("array<double>").alias("vec"))
        q_reps, q_vectors, _, q_twins = distinct_rows(queries, vector_content(), 1)
        left = cut(_assign(q_vectors, pivots, measure))
        left_cells = _cells(left)
        l_blocks = cut(_blocks(left, {c: n for c, (n, _) in left_cells.items()}))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                li, ri = np.asarray(row["l_ids"]), np.asarray(row["r_ids"])
                ln, rn = np.asarray(row["l_norms"]), np.asarray(row["r_norms"])
                lm = np.asarray(row["l_mat"]).reshape(len(li), -1)
                rm = np.asarray(row["r_mat"]).reshape(len(ri), -1)
                s = _scores(lm, ln, rm, rn, measure)
                if own:
                    s[li[:, None] == ri[None, :]] = -np.inf
                yield best_of(s, li, ri, k, row["l_kth"])

    l_radius = {c: r for c, (_, r) in left_cells.items()}
    r_radius = np.zeros(len(pivots))
    for c, (_, r) in right_cells.items():
        r_radius[c] = r

    def visit(angle, c, others, kth):
        closest = np.maximum(angle - l_radius[c] - r_radius[others], 0.0)
        return np.cos(closest) >= _least_cosine(np.asarray(kth), measure) - 1e-7

    def cell_pairs(kth: dict[int, float]) -> DataFrame:
        return _cell_pairs(
            spark, left_cells, right_cells, pivots, lambda angle, c, o: visit(angle, c, o, kth[c])
        )

    payload = ("ids", "norms", "mat")
    _, kth_of_block = first_round(l_blocks, r_blocks, payload, search, k)
    pairs = cell_pairs(_least_kth(kth_of_block))
    lefts = l_blocks.join(kth_of_block, ["cell", "chunk"])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _through_tiles(batches, lambda left: _Best(left, k, measure, own))

    found = _tiled(lefts, r_blocks, {c: n for c, (n, _) in left_cells.items()}, pairs, ("ids", "norms", "mat", "kth"))
    best = (
        found.mapInArrow(tile, "i bigint, j bigint, s double")
        .withColumn("_r", F.row_number().over(_by_i()))
        .where(F.col("_r") <= k)
        .drop("_r")
    )
    everyone = (candidates if own else queries).select("id")
    return expand_copies(best, k, own, everyone, q_reps, q_twins, members)


def similar_pairs(
    df: DataFrame, least: float, measure: str = "cosine"
) -> tuple[DataFrame, DataFrame]:
    """Pairs (i < j, s) of distinct vectors with s >= least, and twins (id, rep) of copies.

    Copies of a vector stand behind one representative, so their pairs are not spelled out.
    """
    df = df.select("id", F.col("vec").cast("array<double>").alias("vec"))
    reps, vectors, _, twins = distinct_rows(df, vector_content(), 1)
    pivots = _pick_pivots(vectors, reps.count(), measure)
    assigned = cut(_assign(vectors, pivots, measure))
    cells = _cells(assigned)
    blocks = cut(_blocks(assigned, {c: n for c, (n, _) in cells.items()}))
    radius = np.zeros(len(pivots))
    for c, (_, r) in cells.items():
        radius[c] = r
    need = _least_cosine(np.asarray(least), measure) - 1e-7

    def visit(angle, c, others):
        closest = np.maximum(angle - radius[c] - radius[others], 0.0)
        return (others >= c) & (np.cos(closest) >= need)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                li, ri = np.asarray(row["l_ids"]), np.asarray(row["r_ids"])
                s = _scores(
                    np.asarray(row["l_mat"]).reshape(len(li), -1), np.asarray(row["l_norms"]),
                    np.asarray(row["r_mat"]).reshape(len(ri), -1), np.asarray(row["r_norms"]),
                    measure,
                )
                a, b = np.nonzero((s >= least) & (li[:, None] != ri[None, :]))
                i, j = np.minimum(li[a], ri[b]), np.maximum(li[a], ri[b])
                out = pd.DataFrame({"i": i, "j": j, "s": s[a, b]})
                yield out.drop_duplicates(["i", "j"])

    keys = blocks.select("cell", "chunk")
    payload = ("cell", "chunk", "ids", "norms", "mat")
    met = (
        _cell_pairs(df.sparkSession, cells, cells, pivots, visit)
        .select(F.col("cell").alias("l_cell"), F.col("other").alias("r_cell"))
        .join(_side(keys, "l_", "cell", "chunk"), "l_cell")
        .join(_side(keys, "r_", "cell", "chunk"), "r_cell")
        .where((F.col("l_cell") < F.col("r_cell")) | (F.col("l_chunk") <= F.col("r_chunk")))
        .join(_side(blocks, "l_", *payload), ["l_cell", "l_chunk"])
        .join(_side(blocks, "r_", *payload), ["r_cell", "r_chunk"])
    )
    return met.mapInPandas(search, "i bigint, j bigint, s double"), twins


def first_round(
    l_blocks: DataFrame, r_blocks: DataFrame, payload: tuple[str, ...], search: Callable, k: int
) -> tuple[DataFrame, DataFrame]:
    """(i, j, s) of every block with one block of its cell, and (cell, chunk, kth): for each id of
    a block the k-th best similarity of these."""
    plain_left = _side(l_blocks, "l_", "cell", "chunk", *payload).withColumn(
        "l_kth", F.lit(None).cast("array<double>")
    )
    near = cut(
        _with_payload(_first_pairs(l_blocks, r_blocks), plain_left, r_blocks, payload).mapInPandas(
            search, "i bigint, j bigint, s double"
        )
    )
    kth = near.groupBy(F.col("i").alias("id")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("s")).otherwise(F.lit(NOTHING)).alias("kth")
    )
    members = l_blocks.select("cell", "chunk", F.posexplode("ids").alias("_p", "id"))
    kth_of_block = cut(
        members.join(kth, "id", "left")
        .withColumn("kth", F.coalesce("kth", F.lit(NOTHING)))
        .groupBy("cell", "chunk")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_p", "kth"))), lambda x: x["kth"]
            ).alias("kth")
        )
    )
    return near, kth_of_block


def _first_pairs(l_blocks: DataFrame, r_blocks: DataFrame) -> DataFrame:
    parts = r_blocks.groupBy("cell").agg(F.count(F.lit(1)).alias("_parts"))
    return l_blocks.select("cell", "chunk").join(parts, "cell").select(
        F.col("cell").alias("l_cell"),
        F.col("chunk").alias("l_chunk"),
        F.col("cell").alias("r_cell"),
        F.pmod("chunk", "_parts").cast("int").alias("r_chunk"),
    )


def _with_payload(pairs: DataFrame, lefts: DataFrame, r_blocks: DataFrame, payload) -> DataFrame:
    return pairs.join(lefts, ["l_cell", "l_chunk"]).join(
        _side(r_blocks, "r_", "cell", "chunk", *payload), ["r_cell", "r_chunk"]
    )


def _least_kth(kth_of_block: DataFrame) -> dict[int, float]:
    rows = kth_of_block.groupBy("cell").agg(F.min(F.array_min("kth")).alias("kth")).collect()
    return {r["cell"]: r["kth"] for r in rows}


def block_search(
    l_blocks: DataFrame,
    r_blocks: DataFrame,
    payload: tuple[str, ...],
    search: Callable,
    k: int,
    cell_pairs: Callable[[dict[int, float]], DataFrame],
) -> DataFrame:
    """(i, j, s): the k best j per i over pairs of blocks, in two rounds.

    Blocks are (cell, chunk, ids, ...). `search` turns rows holding a left and a right
    block into (i, j, s), at most k per i and block, none below `l_kth` where given. The
    first round pairs a block with one block of its cell; the k-th best similarity of
    each i then decides through `cell_pairs` which cells the second round visits.
    """
    near, kth_of_block = first_round(l_blocks, r_blocks, payload, search, k)
    first = _first_pairs(l_blocks, r_blocks)
    l_keys, r_keys = l_blocks.select("cell", "chunk"), r_blocks.select("cell", "chunk")
    second = (
        cell_pairs(_least_kth(kth_of_block))
        .select(F.col("cell").alias("l_cell"), F.col("other").alias("r_cell"))
        .join(_side(l_keys, "l_", "cell", "chunk"), "l_cell")
        .join(_side(r_keys, "r_", "cell", "chunk"), "r_cell")
        .join(first, ["l_cell", "l_chunk", "r_cell", "r_chunk"], "left_anti")
    )
    full_left = _side(
        l_blocks.join(kth_of_block, ["cell", "chunk"]), "l_", "cell", "chunk", *payload, "kth"
    )
    far = _with_payload(second, full_left, r_blocks, payload).mapInPandas(
        search, "i bigint, j bigint, s double"
    )
    return (
        near.unionByName(far)
        .withColumn("_r", F.row_number().over(_by_i()))
        .where(F.col("_r") <= k)
        .drop("_r")
    )


# --- blocks against blocks, tile by tile ----------------------------------------


def _tiled(
    l_blocks: DataFrame, r_blocks: DataFrame, sizes: dict[int, int], pairs: DataFrame, names: tuple[str, ...]
) -> DataFrame:
    """Rows (task, side, cell, cells, *names): the left blocks of a tile, then right blocks with the
    left cells that `pairs` (cell, other) match to theirs, one task after the other.

    Up to TILE blocks make a tile, and up to STREAM blocks on the right pass by it in one task;
    where that makes few tasks, tiles and streams are shorter, about as many of one as of the other. `sizes` are vectors per left cell; columns
    that a side lacks are null.
    """
    spark = l_blocks.sparkSession
    at, starts = 0, []
    for c in sorted(sizes):
        starts.append((int(c), at))
        at += max(1, -(-int(sizes[c]) // BLOCK))
    n_right = max(1, r_blocks.count())
    wanted = 4 * spark.sparkContext.defaultParallelism
    # a left block is sent once per stream, a right one once per tile: about as many of either send least
    tiles = max(1, -(-at // TILE), min(at, round(wanted**0.5)))
    streams = max(-(-n_right // STREAM), min(n_right, -(-wanted // tiles)))
    start = spark.createDataFrame(starts, "cell int, _start int")
    lefts = l_blocks.join(F.broadcast(start), "cell").withColumn(
        "_tile", F.floor((F.col("_start") + F.col("chunk")) / F.lit(max(1, -(-at // tiles)))).cast("int")
    )
    met = pairs.join(lefts.select("cell", "_tile").distinct(), "cell").groupBy("_tile", "other").agg(
        F.collect_set("cell").alias("cells")
    )
    stream = F.pmod(F.xxhash64("cell", "chunk"), F.lit(streams)).cast("int")
    rights = (
        r_blocks.withColumn("_stream", stream)
        .join(met.withColumnRenamed("other", "cell"), "cell")
        .withColumns({"task": F.col("_tile") * F.lit(streams) + F.col("_stream"), "side": F.lit(1)})
    )
    used = rights.select("task").distinct()
    held = lefts.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(streams - 1))).alias("_stream")
    ).withColumns(
        {
            "task": F.col("_tile") * F.lit(streams) + F.col("_stream"), "side": F.lit(0),
            "cells": F.lit(None).cast("array<int>"),
        }
    ).join(F.broadcast(used), "task", "left_semi")
    kinds = dict(l_blocks.dtypes) | dict(r_blocks.dtypes)

    def shaped(df):
        missing = {n: F.lit(None).cast(kinds[n]) for n in names if n not in df.columns}
        return df.withColumns(missing).select("task", "side", "cell", "cells", *names)

    both = shaped(held).unionByName(shaped(rights))
    return both.repartitionById(tiles * streams, F.col("task")).sortWithinPartitions("task", "side")


def _numbers(batch: pa.RecordBatch, name: str, at: int) -> np.ndarray | None:
    value = batch.column(name)[at]
    return value.values.to_numpy(zero_copy_only=False) if value.is_valid else None


def _through_tiles(batches: Iterator[pa.RecordBatch], start: Callable) -> Iterator[pa.RecordBatch]:
    """`start` makes a search of the left blocks, which sees the right blocks one by one and gives its
    result at the end of the task."""
    task, left, search = None, [], None
    for batch in batches:
        for at in range(len(batch)):
            now, side = batch.column("task")[at].as_py(), batch.column("side")[at].as_py()
            if now != task:
                if search is not None:
                    yield search.result()
                task, left, search = now, [], None
            block = {n: _numbers(batch, n, at) for n in batch.schema.names if pa.types.is_list(batch.schema.field(n).type)}
            block |= {n: batch.column(n)[at].as_py() for n in batch.schema.names if n not in block}
            if side == 0:
                left.append(block)
                continue
            if search is None:
                search = start(left)
            search.see(block)
    if search is not None:
        yield search.result()


class _Tile:
    """The left blocks of a task, one matrix."""

    def __init__(self, left: list[dict]):
        sizes = [len(b["ids"]) for b in left]
        self.ids = np.concatenate([b["ids"] for b in left])
        self.rows = np.concatenate([b["mat"].reshape(n, -1) for b, n in zip(left, sizes)])
        self.single = self.rows.astype(np.float32)
        self.cell = np.repeat([b["cell"] for b in left], sizes)
        self.cells = np.unique(self.cell)

    def strips(self, cells: np.ndarray, among: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """Places of the rows in some cells, at most STRIP at once."""
        if among is None and len(np.intersect1d(cells, self.cells)) == len(self.cells):
            at = np.arange(len(self.ids))
        else:
            here = np.isin(self.cell, cells)
            at = np.flatnonzero(here if among is None else here & among)
        for first in range(0, len(at), STRIP):
            yield at[first : first + STRIP]

    def cosines(self, at: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Products with the columns of `right`, in single precision."""
        whole = at[-1] - at[0] + 1 == len(at)
        return (self.single[at[0] : at[-1] + 1] if whole else self.single[at]) @ right


class _Best(_Tile):
    """The k best j of every i of a tile so far."""

    def __init__(self, left: list[dict], k: int, measure: str, own: bool):
        super().__init__(left)
        self.k, self.measure, self.own = k, measure, own
        self.norms = np.concatenate([b["norms"] for b in left])
        self.kth = np.concatenate([b["kth"] for b in left])
        self.s = np.full((len(self.ids), k), -np.inf)
        self.j = np.zeros((len(self.ids), k), np.int64)

    def see(self, block: dict) -> None:
        ids, norms = block["ids"], block["norms"]
        rows = block["mat"].reshape(len(ids), -1)
        single = np.ascontiguousarray(rows.T, np.float32)
        for at in self.strips(block["cells"]):
            least = (_least_cosine(self.kth[at], self.measure) - SINGLE).astype(np.float32)
            i, j = np.nonzero(self.cosines(at, single) >= least[:, None])
            if len(i) > 4 * len(at):
                self._all(at, ids, norms, rows)
                continue
            i = at[i]
            for first in range(0, len(i), STRIP):
                a, b = i[first : first + STRIP], j[first : first + STRIP]
                cos = np.einsum("nd,nd->n", self.rows[a], rows[b])
                self._add(a, ids[b], _of_cosines(cos, self.norms[a], norms[b], self.measure))

    def _all(self, at: np.ndarray, ids: np.ndarray, norms: np.ndarray, rows: np.ndarray) -> None:
        """Every pair in double precision, where few can be ruled out."""
        for first in range(0, len(at), BLOCK):
            part = at[first : first + BLOCK]
            s = _scores(self.rows[part], self.norms[part], rows, norms, self.measure)
            if self.own:
                s[self.ids[part][:, None] == ids[None, :]] = -np.inf
            best = best_of(s, part, ids, self.k, self.kth[part])
            self._add(best["i"].to_numpy(), best["j"].to_numpy(), best["s"].to_numpy())

    def _add(self, i: np.ndarray, j: np.ndarray, s: np.ndarray) -> None:
        keep = np.isfinite(s) & (s >= self.kth[i])
        if self.own:
            keep &= self.ids[i] != j
        i, j, s = i[keep], j[keep], s[keep]
        if not len(i):
            return
        rows = np.unique(i)
        i = np.concatenate([np.repeat(rows, self.k), i])
        j = np.concatenate([self.j[rows].ravel(), j])
        s = np.concatenate([self.s[rows].ravel(), s])
        order = np.lexsort((j, -s, i))
        first = np.searchsorted(i[order], rows)
        top = order[first[:, None] + np.arange(self.k)]
        self.s[rows], self.j[rows] = s[top], j[top]
        self.kth[rows] = np.maximum(self.kth[rows], self.s[rows, -1])

    def result(self) -> pa.RecordBatch:
        i, at = np.nonzero(np.isfinite(self.s))
        return pa.record_batch([pa.array(self.ids[i]), pa.array(self.j[i, at]), pa.array(self.s[i, at])], names=["i", "j", "s"])


class _Ends(_Tile):
    """Least cosine inside clusters and largest between them, from what some probes already reach."""

    def __init__(self, left: list[dict], widest: float, closest: float):
        super().__init__(left)
        self.cluster = np.repeat([b["cluster"] for b in left], [len(b["ids"]) for b in left])
        self.reached = {True: widest, False: closest}
        self.found: dict[bool, float] = {}

    def see(self, block: dict) -> None:
        ids = block["ids"]
        rows = block["mat"].reshape(len(ids), -1)
        single = np.ascontiguousarray(rows.T, np.float32)
        same = self.cluster == block["cluster"] if block["cluster"] is not None else np.zeros(len(self.ids), bool)
        for inside in (True, False):
            for at in self.strips(block["cells"], same if inside else ~same):
                cos = self.cosines(at, single)
                if inside:
                    i, j = np.nonzero(cos <= min(self.reached[True], np.fmin.reduce(cos, axis=None) + SINGLE) + SINGLE)
                else:
                    i, j = np.nonzero(cos >= max(self.reached[False], np.fmax.reduce(cos, axis=None) - SINGLE) - SINGLE)
                i = at[i]
                for first in range(0, len(i), STRIP):
                    a, b = i[first : first + STRIP], j[first : first + STRIP]
                    self._add(inside, np.einsum("nd,nd->n", self.rows[a], rows[b])[self.ids[a] != ids[b]])

    def _add(self, inside: bool, cos: np.ndarray) -> None:
        if not len(cos):
            return
        best = min if inside else max
        end = float(cos.min() if inside else cos.max())
        self.found[inside] = best(self.found.get(inside, end), end)
        self.reached[inside] = best(self.reached[inside], end)

    def result(self) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(list(self.found), pa.bool_()), pa.array([1 - s for s in self.found.values()], pa.float64())], names=["inside", "d"]
        )


def best_of(s: np.ndarray, li, ri, k: int, kth) -> pd.DataFrame:
    """The k best columns per row of a score matrix as (i, j, s).

    Ids of a block are sorted, so a stable sort breaks ties by id.
    """
    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
    best = np.take_along_axis(s, top, axis=1)
    ok = np.isfinite(best)
    if kth is not None:
        ok &= best >= np.asarray(kth)[:, None]
    return pd.DataFrame({"i": np.repeat(li, ok.sum(axis=1)), "j": ri[top][ok], "s": best[ok]})


def expand_copies(
    best: DataFrame,
    k: int,
    own: bool,
    everyone: DataFrame,
    reps: DataFrame,
    twins: DataFrame,
    members: DataFrame,
    self_score: float = 1.0,
) -> DataFrame:
    """From representatives to all rows: a neighbour stands for its smallest ids, and the
    finished list of a representative is handed to all its copies."""
    if own:
        itself = members.select(
            F.col("rep").alias("i"), F.col("rep").alias("j"), F.lit(self_score).alias("s")
        )
        best = best.unionByName(itself)
    expanded = best.join(members.withColumnRenamed("rep", "j"), "j", "left").select(
        "i", F.explode(F.coalesce("members", F.array("j"))).alias("j"), "s"
    )
    lists = (
        expanded.withColumn("_r", F.row_number().over(_by_i()))
        .where(F.col("_r") <= k + 1)
        .groupBy(F.col("i").alias("rep"))
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("n"), "j"))).alias("list"))
    )
    of = everyone.join(twins, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    table = lists.join(reps.withColumnRenamed("id", "rep"), "rep")
    found = salted_lookup(of, table, "rep", "copies", F.col("id"))
    others = F.filter("list", lambda x: x["j"] != F.col("id")) if own else F.col("list")
    return found.select(
        F.col("id").alias("i"), F.posexplode(F.slice(others, 1, k)).alias("_p", "_x")
    ).select(
        "i", F.col("_x.j").alias("j"), (-F.col("_x.n")).alias("s"), (F.col("_p") + 1).alias("rank")
    )


def extreme_distances(df: DataFrame) -> DataFrame:
    """Largest distance inside a cluster and smallest between clusters (1 - cosine): one row.

    `df` is (id, cluster, vec). The best pair among some probes bounds both; only cells
    that can hold a better pair are compared, and a pair of blocks returns two numbers.
    """
    spark = df.sparkSession
    rows = df.select("id", "cluster", F.col("vec").cast("array<double>").alias("vec"))
    keyed = rows.withColumn("_key", vector_content())
    once = keyed.groupBy("cluster", "_key").agg(F.min("id").alias("id"))
    rows = rows.join(once.select("id"), "id", "left_semi")
    n = df.count()
    want = int(min(MAX_PIVOTS, max(16, -(-n // BLOCK))))  # a few more give better bounds
    picked = rows.orderBy(unit_hash(1, F.col("id"))).limit(want).select("vec", "cluster").collect()
    probes = _unit(_matrix([r["vec"] for r in picked]), "cosine")[0]
    pivots = probes[: max(1, -(-n // BLOCK))]
    group = np.array([str(r["cluster"]) for r in picked])
    known = np.array([r["cluster"] is not None for r in picked])
    same = (group[:, None] == group[None, :]) & known[:, None]  # unknown clusters are nobody's
    np.fill_diagonal(same, True)
    cos = probes @ probes.T
    widest = float(cos[same].min())
    closest = float(cos[~same].max()) if (~same).any() else -1.0
    cluster_type = df.schema["cluster"].dataType.simpleString()
    assigned = cut(_assign(rows, pivots, "cosine", f", cluster {cluster_type}"))
    cells = _cells(assigned)
    radius = np.zeros(len(pivots))
    for c, (_, r) in cells.items():
        radius[c] = r
    blocks = cut(_blocks(assigned, {c: m for c, (m, _) in cells.items()}, ("cluster",)))

    def visit(angle, c, others):
        slack = radius[c] + radius[others]
        near = np.cos(np.maximum(angle - slack, 0.0)) >= closest - 1e-7
        wide = np.cos(np.minimum(angle + slack, np.pi)) <= widest + 1e-7
        return (others >= c) & (near | wide)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _through_tiles(batches, lambda left: _Ends(left, widest, closest))

    pairs = _cell_pairs(spark, list(cells), list(cells), pivots, visit)
    sizes = {c: m for c, (m, _) in cells.items()}
    met = _tiled(blocks, blocks, sizes, pairs, ("cluster", "ids", "mat")).mapInArrow(tile, "inside boolean, d double")
    return met.agg(
        F.greatest(F.max(F.when(F.col("inside"), F.col("d"))), F.lit(0.0)).alias("max_diameter"),
        F.min(F.when(~F.col("inside"), F.col("d"))).alias("min_separation"),
    )
