"""Removal of repeated byte strings by suffix arrays over anchored suffixes.

A byte string of `length` bytes is repeated when it also starts anywhere else in the corpus. Any
such string (window) holds, at a place that its own bytes decide, one anchor: the lead of LEAD bytes
with the least hash, the first of equal ones. So equal windows share their lead, and only the
suffixes of anchors have to be brought together:

1. Each document gives its anchors, with the range of windows that chose them (a context: about
   one per 140 bytes) and a fingerprint of the context's bytes. Contexts are counted per lead.
2. A context found twice is repeated as a whole. A lead with one context only has no repeat.
3. What remains are leads with differing contexts, at the edges of copied passages. One context of
   each kind is fetched with its bytes. Sampled splitters deal them to ranges of leading bytes;
   each range sorts the suffixes of its windows by multikey quicksort, eight bytes at a time, and
   neighbours that agree over `length` bytes are repeats. Splitters fall between leads, and equal
   windows have equal leads, so no run of equal suffixes goes on over the boundary of a range.
4. A lead with more than HOT_CONTEXTS differing contexts would not fit one task: its windows are
   counted one by one under digests of all their bytes, with partial aggregation.

Spans of repeats are then united per document and cut out.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, shuffle_parts, stored, text_or_empty
from corpusloom.llm.words import PrefixHash, mixed

LEAD = 128
STRETCH = 1 << 20  # bytes that are handled at once; 22 bits hold a place
PLACE_BITS = 22
HOT_CONTEXTS = 5_000
BUCKET_BYTES = 4 << 20  # bytes of contexts per range


def _window_min(values: np.ndarray, width: int, n: int) -> np.ndarray:
    """Least value of values[s : s + width] for s in 0 .. n - 1."""
    top = np.iinfo(values.dtype).max
    blocks = np.concatenate([values, np.full(-len(values) % width, top, values.dtype)]).reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray, length: int, lead: int, prefix: PrefixHash):
    """Contexts of one buffer of texts that end at `ends`: text number, lead's hash, fingerprint,
    first window, number of windows, all windows inside one text."""
    n = len(data) - length + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty
    at = np.arange(len(data) - lead + 1)
    hashes = prefix.of(data, at, at + lead)
    key = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | at.astype(np.uint64)
    chosen = (_window_min(key, length - lead + 1, n) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    text = np.searchsorted(ends, np.arange(n), side="right")
    inside = np.arange(n) + length <= ends[text]
    fresh = np.ones(n, bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh & inside)
    # a run of windows ends where the next one begins or where windows leave the text
    stop = np.flatnonzero(np.concatenate([fresh[1:] | ~inside[1:], [True]]) & inside) + 1
    spot = chosen[first]
    print_ = prefix.of(data, first, stop - 1 + length)
    print_ = mixed(print_ + (spot - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text[first], hashes[spot], print_, first, stop - first


def _contexts(batches: Batches, length: int, lead: int) -> Batches:
    prefix = PrefixHash()

    def out(parts: list[tuple[int, int, bytes]]):
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        ends = np.cumsum([len(p) for _, _, p in parts])
        text, leads, prints, first, n = anchors(data, ends, length, lead, prefix)
        key = np.array([k for k, _, _ in parts], np.int64)[text]
        shift = np.array([at for _, at, _ in parts], np.int64) - np.concatenate([[0], ends[:-1]])
        return pa.record_batch(
            [
                pa.array(leads.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(key),
                pa.array(first + shift[text]), pa.array(n.astype(np.int32)),
            ],
            names=["lead", "print", "key", "first", "n"],
        )

    for batch in batches:
        parts, size = [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode()
            # a long text comes in parts that share length - 1 bytes: no window is in two parts
            for at in range(0, max(len(data) - length + 1, 0), STRETCH):
                parts.append((key, at, data[at : at + STRETCH + length - 1]))
                size += len(parts[-1][2])
                if size >= STRETCH:
                    yield out(parts)
                    parts, size = [], 0
        if parts:
            yield out(parts)


def _slices(batches: Batches, length: int) -> Batches:
    """Bytes of the wanted contexts of each document."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            data = text.encode()
            rows += [
                (w["lead"], w["key"], w["first"], w["n"], w["m"], data[w["first"] : w["first"] + w["n"] - 1 + length])
                for w in wanted
            ]
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["lead", "key", "first", "n", "m", "bytes"]
        )


def equal_windows(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Those of `starts` whose `length` bytes also begin at another of them: multikey quicksort.

    Suffixes are kept in groups that agree so far. Each step looks at the next eight bytes (big
    endian, so that their order is that of bytes), sorts the groups in which they differ, splits
    them, and drops suffixes that are alone: their neighbours on both sides differ.
    """
    whole = np.frombuffer(data + bytes(8), np.uint8)
    words = np.zeros(len(whole) - 7, np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | whole[i : len(whole) - 7 + i]
    group = np.zeros(len(starts), np.int64)
    for depth in range(0, length, 8):
        if not len(starts):
            break
        key = words[starts + depth]
        if length - depth < 8:
            key = key >> np.uint64(8 * (8 - length + depth))
        fresh = np.ones(len(starts), bool)
        fresh[1:] = group[1:] != group[:-1]
        head = key[np.flatnonzero(fresh)[group]]
        uneven = np.zeros(group[-1] + 1, bool)
        uneven[group[key != head]] = True
        at = np.flatnonzero(uneven[group])
        if not len(at):
            continue
        order = np.lexsort((key[at], group[at])) if group[-1] else np.argsort(key[at])
        starts[at], key[at] = starts[at][order], key[at][order]
        fresh[1:] |= key[1:] != key[:-1]
        kept = ~(fresh & np.concatenate([fresh[1:], [True]]))
        starts, fresh = starts[kept], fresh[kept]
        group = np.cumsum(fresh) - 1
    return starts


def _runs(key: np.ndarray, window: np.ndarray, length: int) -> list[pa.Array]:
    """key, first byte and end of runs of windows that follow each other."""
    order = np.lexsort((window, key))
    key, window = key[order], window[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (window[1:] > window[:-1] + length)
    last = np.concatenate([fresh[1:], [True]]) if len(key) else fresh
    return [pa.array(key[fresh]), pa.array(window[fresh]), pa.array(window[last] + length)]


def _sorted_bucket(batches: Batches, length: int) -> Batches:
    """Spans of the repeats among the contexts of one range of leading bytes."""
    found = list(batches)
    if not found:
        return
    table = pa.Table.from_batches(found).select(["key", "first", "n", "bytes"])
    key, first, n = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "first", "n"))
    data = b"".join(table.column("bytes").to_pylist())
    begin = np.concatenate([[0], np.cumsum(n + length - 1)])[:-1]  # of each context in data
    total = np.cumsum(n)
    starts = np.arange(total[-1] if len(total) else 0) + np.repeat(begin - (total - n), n)
    starts = equal_windows(data, starts, length)
    owner = np.searchsorted(begin, starts, side="right") - 1
    yield pa.record_batch(_runs(key[owner], first[owner] + starts - begin[owner], length), names=["key", "a", "b"])


def _windows(batches: Batches, length: int) -> Batches:
    """One row per window of hot contexts: digest of all its bytes, document and place."""
    for batch in batches:
        keys, firsts = batch.column("key").to_pylist(), batch.column("first").to_pylist()
        for key, first, data in zip(keys, firsts, batch.column("bytes").to_pylist()):
            n = len(data) - length + 1
            digests = [hashlib.blake2b(data[i : i + length], digest_size=16).digest() for i in range(n)]
            yield pa.record_batch(
                [pa.array(digests, pa.binary()), pa.array(np.full(n, key)), pa.array(np.arange(first, first + n))],
                names=["digest", "key", "a"],
            )


def repeated_spans(docs: DataFrame, length: int = 400, lead: int = LEAD) -> DataFrame:
    """key, a, b: byte ranges of repeats (they may overlap) in docs (key, text); equal keys mean
    equal rows. Strings are judged on the input as it is."""
    rows = "lead long, print long, key long, first long, n int"
    found = stored(mapped(docs.select("key", "text"), partial(_contexts, length=length, lead=lead), rows), "contexts")
    one = F.min(F.struct("key", "first", "n")).alias("one")
    kinds = stored(found.groupBy("lead", "print").agg(F.count("*").alias("times"), one), "kinds")
    copied = kinds.filter("times > 1").select("lead", "print")
    whole = found.join(copied, ["lead", "print"]).select(
        "key", F.col("first").alias("a"), (F.col("first") + F.col("n") - 1 + length).alias("b")
    )
    mixed_leads = (
        kinds.groupBy("lead").agg(F.count("*").alias("m"), F.min("times").alias("least")).filter("m > 1 and least = 1")
    )
    wanted = (
        kinds.join(mixed_leads, "lead")
        .select("one.key", F.struct("lead", "one.*", "m").alias("w"))
        .groupBy("key")
        .agg(F.collect_list("w").alias("wanted"))  # contexts of one document
    )
    open_ = stored(
        mapped(
            docs.dropDuplicates(["key"]).join(wanted, "key").select("text", "wanted"),
            partial(_slices, length=length),
            "lead long, key long, first long, n int, m long, bytes binary",
        ),
        "open-contexts",
    )
    sizes = open_.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0)).alias("n"), F.max("m").alias("m")).first()
    ranges = max(shuffle_parts(docs.sparkSession), -(-sizes["n"] // BUCKET_BYTES))
    sort = partial(_sorted_bucket, length=length)
    sorted_ = mapped(
        open_.filter(F.col("m") <= HOT_CONTEXTS).repartitionByRange(ranges, "lead"), sort, "key long, a long, b long"
    )
    if (sizes["m"] or 0) <= HOT_CONTEXTS:
        return whole.unionByName(sorted_)
    windows = stored(
        mapped(open_.filter(F.col("m") > HOT_CONTEXTS), partial(_windows, length=length), "digest binary, key long, a long"),
        "windows",
    )
    twice = windows.groupBy("digest").count().filter("count > 1").select("digest")
    hot = windows.join(twice, "digest").select("key", "a", (F.col("a") + length).alias("b"))
    return whole.unionByName(sorted_).unionByName(hot)


def _cut(batches: Batches) -> Batches:
    for batch in batches:
        kept, sizes, spans = [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            data = text.encode()
            united: list[list[int]] = []
            for s in sorted((s["a"], s["b"]) for s in found or ()):
                if united and s[0] <= united[-1][1]:
                    united[-1][1] = max(united[-1][1], s[1])
                else:
                    united.append(list(s))
            edges = [0, *(x for s in united for x in s), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2])))
            sizes.append(len(data))
            spans.append([{"first": a, "end": b} for a, b in united])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
            names=["doc_id", "n_bytes", "kept", "spans"],
        )


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, kept (remaining bytes), spans removed.

    All bytes covered by a string of `length` bytes that also starts anywhere else, in the same
    document or another, are removed, in every copy. Null text is empty; texts shorter than `length`
    stay whole; repeated rows are copies of each other; null doc_ids are allowed; other columns are
    ignored. An empty table gives an empty result.
    """
    text = text_or_empty()
    keyed = docs.select("doc_id", text).withColumn("key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(keyed, length).groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("found"))
    return mapped(
        keyed.join(spans, "key", "left").select("doc_id", "text", "found"),
        _cut,
        "doc_id long, n_bytes long, kept binary, spans array<struct<first: long, end: long>>",
    )
