"""Packing documents into training sequences by cutting-stock column generation.

Documents are cut into pieces of few sizes: whole sequences, one piece of a multiple of `unit`
tokens and one tail shorter than `unit`. Over the histogram of those sizes a linear program picks
the mix of patterns (how many pieces of which size fill a sequence); a knapsack dynamic program
prices new patterns until none lowers the number of sequences. Rounded patterns are then given to
the pieces by their rank inside their size. Only the histogram and the patterns, whose number is
bounded by the number of sizes, are on the driver; pieces stay distributed.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, partitions_for, stored, text_or_empty
from corpusloom.llm.words import worker_words

BUCKET_ROWS = 20_000  # pieces that are ranked together


def cut_points(n: int, capacity: int, unit: int) -> list[int]:
    """Where a document of n tokens is cut: starts of its pieces, and n."""
    whole = n // capacity * capacity
    middle = whole + (n - whole) // unit * unit
    return sorted({*range(0, whole + 1, capacity), middle, n})


def _pieces(batches: Batches, path: str, end_id: int, capacity: int, unit: int, with_ids: bool) -> Batches:
    words = worker_words(path)
    end = np.array([end_id], np.uint32)
    for batch in batches:
        rows: list[tuple] = []
        n = 0
        for key, ids in zip(batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist())):
            ids = np.concatenate([ids, end]).astype("<u4")
            points = cut_points(len(ids), capacity, unit)
            for a, b in zip(points[:-1], points[1:]):
                rows.append((key, a, b - a, zlib.crc32(ids[a:b]), len(ids), ids[a:b] if with_ids else None))
            n += len(ids) if with_ids else 1
            if n >= 1 << 20:
                yield _piece_batch(rows, with_ids)
                rows, n = [], 0
        if rows:
            yield _piece_batch(rows, with_ids)


def _piece_batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    *plain, ids = zip(*rows)
    arrays = [pa.array(c, pa.int64()) for c in plain]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    if with_ids:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(offsets, np.concatenate(ids).view(np.int32)))
        names.append("ids")
    return pa.record_batch(arrays, names=names)


def document_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, unit: int = 64, with_ids: bool = False
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of each piece of docs (doc_id, text)."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return mapped(
        docs.select("doc_id", text_or_empty()),
        partial(_pieces, path=tokenizer, end_id=end_id, capacity=capacity, unit=unit, with_ids=with_ids),
        schema + (", ids array<int>" if with_ids else ""),
    )


def best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits, by dynamic programming over the capacity."""
    value = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, side="right")  # sizes ascend
        value[room] = value[room - 1]
        if fits:
            with_one = value[room - sizes[:fits]] + worth[:fits]
            i = int(with_one.argmax())
            if with_one[i] > value[room] + 1e-12:
                value[room], taken[room] = with_one[i], i
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= sizes[taken[room]]
    return float(value[capacity]), pattern


def patterns_for(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-4, rounds: int = 5000
) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, so that exactly `demand` pieces of each size are placed.

    Column generation: revised simplex from patterns of one size, priced by best_pattern, until no
    pattern helps or the lower bound is within `gap`. Whole parts of the solution are used; the few
    pieces left over (fewer than fit one use of each pattern) are filled in by decreasing size.
    """
    m = len(sizes)
    if not m:
        return []
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(rounds):
        worth = inverse.sum(axis=0)
        value, pattern = best_pattern(sizes, worth, capacity)
        total = amount.sum()
        if value <= 1 + 1e-9 or total - total / value <= gap * total:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = pattern
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        amount = np.maximum(inverse @ demand, 0)
    used = np.floor(amount + 1e-9).astype(np.int64)
    result = [(columns[:, j].round().astype(np.int64), int(used[j])) for j in range(m) if used[j]]
    left = demand - sum((a * n for a, n in result), np.zeros(m, np.int64))
    while (left < 0).any():  # rounding of a nearly whole amount upwards: take one use back
        j = next(j for j, (a, _) in enumerate(result) if (a[left < 0] > 0).any())
        a, n = result[j]
        result[j] = (a, n - 1)
        left = left + a
    while left.any():
        room, fill = capacity, np.zeros(m, np.int64)
        for i in range(m - 1, -1, -1):
            fill[i] = min(left[i], room // sizes[i])
            room -= fill[i] * sizes[i]
        times = int((left[fill > 0] // fill[fill > 0]).min())
        result.append((fill, times))
        left = left - fill * times
    return [(a, n) for a, n in result if n]


class Places:
    """Sequence and offset of the r-th piece of each size under given patterns."""

    def __init__(self, sizes: np.ndarray, patterns: list[tuple[np.ndarray, int]]):
        self.first_sequence = np.concatenate([[0], np.cumsum([n for _, n in patterns])]).astype(np.int64)
        self.by_size = {}
        for i, size in enumerate(sizes.tolist()):
            use = [(p, a, n) for p, (a, n) in enumerate(patterns) if a[i]]
            upto = np.cumsum([a[i] * n for _, a, n in use])
            offset = [int((a[i + 1 :] * sizes[i + 1 :]).sum()) for _, a, _ in use]  # large pieces first
            self.by_size[size] = (
                np.array([p for p, _, _ in use]),
                np.array([a[i] for _, a, _ in use]),
                upto,
                np.array(offset),
            )

    def of(self, size: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pattern, each, upto, offset = self.by_size[size]
        p = np.searchsorted(upto, rank, side="right")
        inside = rank - np.concatenate([[0], upto])[p]
        sequence = self.first_sequence[pattern[p]] + inside // each[p]
        return sequence, offset[p] + inside % each[p] * size


def _place(batches: Batches, places: Places) -> Batches:
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length).tolist():
            mine = length == size
            sequence[mine], offset[mine] = places.of(size, rank[mine])
        keep = batch.schema.names[:-1]
        yield pa.record_batch(
            [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)],
            names=[*keep, "sequence_id", "offset"],
        )


def ranked(pieces: DataFrame) -> DataFrame:
    """pieces with rank: 0, 1, ... inside each length, without gaps.

    Each length is dealt to hash buckets, whose number grows with the table; totals of buckets
    before plus the place inside the bucket give the rank, so no length is sorted in one task.
    """
    buckets = partitions_for(pieces, BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    totals = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (
        dealt.withColumn("place", F.row_number().over(inside))
        .join(bases, ["length", "bucket"])
        .select(*pieces.columns, (F.col("base") + F.col("place") - 1).alias("rank"))
    )


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """pieces (doc_id, start, length, ids_crc32, doc_tokens) with sequence_id and offset.

    Every piece has one place; places of a sequence are gapless from 0 and end by `capacity`.
    Repeated rows are pieces of their own; an empty table stays empty.
    """
    counts = sorted((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect())
    sizes = np.array([s for s, _ in counts], np.int64)  # at most capacity / unit + unit of them
    demand = np.array([n for _, n in counts], np.int64)
    places = Places(sizes, patterns_for(sizes, demand, capacity))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rows = ranked(pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens"))
    return mapped(rows, partial(_place, places=places), schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, unit: int = 64
) -> DataFrame:
    """Tokenize docs (doc_id, text), cut them and place every piece; see pack.

    Null and empty texts are documents of the end id alone. Other columns are ignored.
    """
    return pack(stored(document_pieces(docs, tokenizer, end_id, capacity, unit), "pieces"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096,
              unit: int = 64, pad_id: int = 0) -> DataFrame:
    """sequence_id and its ids (padded to capacity) and the number of real ids, from packed."""
    key = ["doc_id", "start", "length", "ids_crc32"]
    pieces = document_pieces(docs, tokenizer, end_id, capacity, unit, with_ids=True)
    placed = packed.dropDuplicates([*key, "sequence_id", "offset"]).select(*key, "sequence_id", "offset")
    joined = placed.join(pieces.dropDuplicates(key).select(*key, "ids"), key)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most capacity ids
    return (
        joined.groupBy("sequence_id")
        .agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
        .select(
            "sequence_id",
            F.size("ids").alias("n_ids"),
            F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.size("ids"))).alias("ids"),
        )
    )
