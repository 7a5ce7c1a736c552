"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped edges.

A document's set holds the hashes of its distinct five-word shingles. One permutation splits the
hash range into bins, each keeping its least hash; empty bins borrow from a bin that a fixed random
order over bins finds first (optimal densification), so equal sets and similar sets borrow alike.
Bins are read in bands; documents that share a band meet in a bucket. The number of bands follows
from the threshold: a pair just at it is missed with probability MISS.

Documents with equal sets are one class. Inside a bucket only star edges are formed: from the class
that shares most places in buckets, the likely centre, to the others. They are confirmed on the full
sets. A star can lose a link between two classes that are both far from its centre. So classes that
buckets hold together, directly or by steps, are a cluster, and clusters whose stars left several
components are compared in full, in pairs of blocks of bounded size: bins first (five standard
deviations below the threshold), then the sets, and only across components. Such a comparison gives
its links alone, never its pairs.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, stored, text_or_empty
from corpusloom.llm.components import connected
from corpusloom.llm.words import PrefixHash, mixed, word_bounds
from corpusloom.operators.joins import salted_lookup

WORDS = 5
ROWS = 5  # bins per band
MISS = 1e-8
STAR = 500  # members of a star that are compared in one group
BLOCK_SETS = 1_000  # sets of a block that is compared in full with another, and their hashes
BLOCK_HASHES = 1 << 20
STRETCH = 1 << 20

_MULTIPLIERS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def _word_hashes(data: bytes, prefix: PrefixHash) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of data, in stretches that end at white space."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        stop = min(at + 2 * STRETCH, len(data))
        if stop < len(data):
            cut = max(data.rfind(c, at, stop) for c in (b" ", b"\n"))
            stop = cut + 1 if cut > at else len(data)
        view = np.frombuffer(data, np.uint8, stop - at, at)
        a, b = word_bounds(view)
        hashes.append(prefix.of(view, a, b))
        starts.append(a + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str], prefix: PrefixHash) -> list[np.ndarray]:
    """Ascending distinct hashes of the shingles of each text; empty without words.

    A-Z are lower-cased; words are runs without ASCII white space. A text of fewer than WORDS words
    has its whole sequence as one shingle.
    """
    raw = [t.encode().lower() for t in texts]
    hashes, starts = _word_hashes(b"\n".join(raw), prefix)
    ends = np.cumsum([len(r) + 1 for r in raw])
    last = np.searchsorted(starts, ends)
    first = np.concatenate([[0], last[:-1]])
    n = len(hashes) - WORDS + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for j in range(WORDS):
            rolled += hashes[j : n + j] * _MULTIPLIERS[j]
        rolled = mixed(rolled)
    sets = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= WORDS:
            sets.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            short = (hashes[a:b] * _MULTIPLIERS[8 : 8 + b - a]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mixed(short + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


class Sketcher:
    """Band keys of shingle sets."""

    def __init__(self, bands: int, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self._tag = mixed(np.arange(1000, 1000 + bands, dtype=np.uint64))

    def _order(self, attempt: int) -> np.ndarray:
        """The bin that each bin asks at its attempt-th try."""
        asks = mixed(np.arange(self.bins, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(attempt * 7919 + 17))
        return (asks % np.uint64(self.bins)).astype(np.int64)

    def bins_of(self, hashes: np.ndarray) -> np.ndarray:
        """Densified bins of a set of ascending hashes, not empty."""
        home = ((hashes >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        fresh = np.ones(len(home), bool)
        fresh[1:] = home[1:] != home[:-1]  # ascending, so the first of a bin is its least
        values = np.zeros(self.bins, np.uint64)
        filled = np.zeros(self.bins, bool)
        values[home[fresh]] = hashes[fresh]
        filled[home[fresh]] = True
        empty = np.flatnonzero(~filled)
        attempt = 0
        while len(empty):
            attempt += 1
            asked = self._order(attempt)[empty]
            hit = filled[asked]
            values[empty[hit]] = values[asked[hit]]
            empty = empty[~hit]
        return values

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        bins = self.bins_of(hashes).reshape(self.bands, self.rows)
        return mixed((bins * _MULTIPLIERS[: self.rows]).sum(axis=1, dtype=np.uint64) + self._tag)


def _groups(keys: list, texts: list[str]):
    """Rows of a batch in groups of about STRETCH characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STRETCH or i == len(texts) - 1:
            yield keys[at : i + 1], texts[at : i + 1]
            at, size = i + 1, 0


def text_key(name: str = "text") -> Column:
    """A hash that tells apart the texts of one doc_id; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(name), F.lit("")))


def _sketch(batches: Batches, bands: int) -> Batches:
    prefix, sketcher = PrefixHash(), Sketcher(bands)
    for batch in batches:
        named = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
        for rows, texts in _groups(named, batch.column(1).to_pylist()):
            keys, marks = zip(*rows)
            sets = shingle_sets(texts, prefix)
            digests = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
            bands_ = [sketcher.keys(s).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bands_])]).astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array(keys, pa.int64()), pa.array(marks, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.int64()), pa.ListArray.from_arrays(offsets, np.concatenate(bands_)),
                ],
                names=["doc_id", "text_key", "n_shingles", "digest", "bands"],
            )


def _sets_for_hubs(batches: Batches) -> Batches:
    """The set of each document once per group of the stars it takes part in."""
    prefix = PrefixHash()
    for batch in batches:
        stars = batch.column("stars").to_pylist()
        rows = list(zip(batch.column("id").to_pylist(), stars))
        for part, texts in _groups(rows, batch.column("text").to_pylist()):
            out = [(s["hub"], s["salt"], k != s["hub"], k, x) for (k, ss), x in zip(part, shingle_sets(texts, prefix)) for s in ss]
            hub, salt, member, key, sets = zip(*out)
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            at = 0
            while at < len(sets):  # batches of a bounded number of hashes
                stop, n = at, 0
                while stop < len(sets) and (stop == at or n + len(sets[stop]) <= STRETCH):
                    n += len(sets[stop])
                    stop += 1
                arrays = [pa.array(c[at:stop], k) for c, k in zip((hub, salt, member, key), kinds)]
                arrays.append(pa.array([x.tobytes() for x in sets[at:stop]], pa.binary()))
                yield pa.record_batch(arrays, names=["hub", "salt", "member", "id", "hashes"])
                at = stop


def _confirm(batches: Batches, percent: int) -> Batches:
    """Links of the rows of (hub, salt) groups, the hub's own row first in each."""
    hub, hub_set = None, np.zeros(0, np.uint64)
    for batch in batches:
        found: list[tuple[int, int]] = []
        columns = (batch.column(c).to_pylist() for c in ("hub", "member", "id", "hashes"))
        for h, member, key, data in zip(*columns):
            mine = np.frombuffer(data, np.uint64)
            if not member:
                hub, hub_set = h, mine
                continue
            if h != hub:
                raise RuntimeError("a star lacks its hub")
            both = len(np.intersect1d(hub_set, mine, assume_unique=True))
            if 100 * both >= percent * (len(hub_set) + len(mine) - both):
                found.append((h, key))
        a, b = zip(*found) if found else ((), ())
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _confirmed(texts: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """Those of edges (hub, member) whose sets are similar enough.

    A star goes to groups of about STAR members, each with a copy of the hub, so a hub of any
    number of members is compared by many tasks.
    """
    sizes = edges.groupBy("hub").agg(F.ceil(F.count("*") / STAR).alias("salts"))
    members = edges.join(sizes, "hub").select(
        F.col("member").alias("id"), F.struct("hub", F.pmod(F.xxhash64("member"), "salts").alias("salt")).alias("s")
    )
    hubs = sizes.select(
        F.col("hub").alias("id"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    ).select("id", F.struct(F.col("id").alias("hub"), F.col("salt").cast("long").alias("salt")).alias("s"))
    wanted = members.unionByName(hubs).groupBy("id").agg(F.collect_set("s").alias("stars"))
    sets = mapped(
        texts.join(wanted, "id").select("id", "text", "stars"),
        _sets_for_hubs,
        "hub long, salt long, member boolean, id long, hashes binary",
    )
    dealt = sets.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member")
    return mapped(dealt, partial(_confirm, percent=percent), "a long, b long")


def _sets_for_blocks(batches: Batches) -> Batches:
    """The set of each document once per pair of blocks that it takes part in."""
    prefix = PrefixHash()
    names = ["cluster", "i", "j", "block", "id", "label", "hashes"]
    for batch in batches:
        rows = batch.select(["id", "label", "block", "pairs"]).to_pylist()
        for part, texts in _groups(rows, batch.column("text").to_pylist()):
            for row, mine in zip(part, shingle_sets(texts, prefix)):
                out = [(p["cluster"], p["i"], p["j"], row["block"], row["id"], row["label"]) for p in row["pairs"]]
                arrays = [pa.array(c, pa.int64()) for c in zip(*out)]
                yield pa.record_batch([*arrays, pa.array([mine.tobytes()] * len(out), pa.binary())], names=names)


def _links_of_blocks(table: pa.Table, percent: int) -> pa.Table:
    """Links across components between two blocks of a cluster (or inside one)."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    block = table.column("block").to_numpy()
    ids, label = table.column("id").to_numpy(), table.column("label").to_numpy().copy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    share = percent / 100
    sketcher = Sketcher(bands_for(share))
    bins = np.array([(sketcher.bins_of(x) >> np.uint64(40)).astype(np.uint16) for x in sets])
    sizes = np.array([len(x) for x in sets])
    others = np.flatnonzero(block == j)
    links = []
    for u in np.flatnonzero(block == i).tolist():
        there = others[others > u] if i == j else others
        there = there[label[there] != label[u]]
        # sets smaller than the number of bins borrow, so they count for fewer
        sure = np.minimum(np.minimum(sizes[u], sizes[there]), sketcher.bins)
        enough = share - 5 * np.sqrt(share * (1 - share) / sure)
        for v in there[(bins[there] == bins[u]).mean(axis=1) >= enough].tolist():
            if label[u] == label[v]:
                continue
            both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
            if 100 * both >= percent * (sizes[u] + sizes[v] - both):
                links.append((ids[u], ids[v]))
                label[label == label[v]] = label[u]
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links_of_clusters(bodies: DataFrame, stars: DataFrame, labels: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Links that the confirmed stars (labels) have left out inside the clusters of all stars."""
    clusters = connected(stars.select(F.col("hub").alias("a"), F.col("member").alias("b")))
    named = stored(
        clusters.withColumnRenamed("label", "cluster")
        .join(labels, "id", "left")
        .join(sizes, "id")
        .select("id", "cluster", F.coalesce("label", "id").alias("label"), "n_shingles"),
        "clusters",
    )
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_HASHES))
    open_ = (
        named.groupBy("cluster")
        .agg(parts.alias("blocks"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
        .select("cluster", "blocks")
    )
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    pair = F.transform(
        every,
        lambda b: F.struct(
            F.col("cluster").alias("cluster"), F.least(F.col("block"), b).alias("i"), F.greatest(F.col("block"), b).alias("j")
        ),
    )
    members = (
        named.join(open_, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
        .select("id", "label", "block", pair.alias("pairs"))
    )
    sets = mapped(
        bodies.join(members, "id").select("id", "text", "label", "block", "pairs"),
        _sets_for_blocks,
        "cluster long, i long, j long, block long, id long, label long, hashes binary",
    )
    return sets.groupBy("cluster", "i", "j").applyInArrow(lambda table: _links_of_blocks(table, percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept, text_key.

    Documents are linked when 100 * intersection >= percent * union of their sets of shingles;
    component_id is the least doc_id that links reach, kept marks that document. Documents without
    words are linked with nothing. Null texts count as empty; rows that repeat a doc_id
    and its text are one document, rows with one doc_id and other texts are documents of their own,
    told apart by text_key, a hash of the text that follows as a fifth column; a row without doc_id
    is linked with nothing, has no component_id and is kept. Other columns are ignored, an empty
    table gives an empty result.
    """
    bands = bands_for(percent / 100)
    texts = docs.select(F.col("doc_id"), text_or_empty()).withColumn("text_key", text_key())
    sketches = stored(
        mapped(
            texts.select("doc_id", "text", "text_key"),
            partial(_sketch, bands=bands),
            "doc_id long, text_key long, n_shingles long, digest long, bands array<long>",
        ),
        "sketches",
    )
    real = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    filled = sketches.filter(real)
    # documents with equal sets are one class, named by the digest of the set
    classes = stored(
        filled.groupBy(F.col("digest").alias("id"))
        .agg(F.min(F.struct("doc_id", "text_key")).alias("r"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("n"))
        .select("id", "r.doc_id", "r.text_key", "n_shingles", "n"),
        "classes",
    )
    members = filled.groupBy(F.col("digest").alias("id")).agg(F.first("bands").alias("bands")).select("id", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stored(members.join(shared, "bucket"), "buckets")
    central = buckets.groupBy("id").agg(F.sum("n").alias("places"))
    hubs = buckets.join(central, "id").groupBy("bucket").agg(F.max_by("id", F.struct("places", -F.col("id"))).alias("hub"))
    stars = stored(
        buckets.join(hubs, "bucket").filter("id <> hub").select("hub", F.col("id").alias("member")).distinct(), "stars"
    )
    # all comparisons are among classes that share a bucket: a text of each is fetched once
    met = classes.join(buckets.select("id").distinct(), "id", "left_semi").select("id", "doc_id", "text_key")
    bodies = stored(texts.join(met, ["doc_id", "text_key"]).select("id", "text").dropDuplicates(["id"]), "bodies")
    links = stored(_confirmed(bodies, stars, percent), "links")
    sizes = classes.select("id", "n_shingles")
    further = stored(_links_of_clusters(bodies, stars, connected(links), sizes, percent), "further-links")
    labels = connected(links.unionByName(further))
    named = stored(classes.join(labels, "id", "left").select("id", "doc_id", "n", F.coalesce("label", "id").alias("label")), "labelled-classes")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    groups = salted_lookup(named.select("id", "n", "label"), least, "label", "rows", F.col("id"))
    placed = salted_lookup(
        filled.select("doc_id", "text_key", "n_shingles", F.col("digest").alias("id")),
        groups.select("id", "n", "component_id"), "id", "n", F.col("doc_id"),
    )
    alone = sketches.filter(~F.coalesce(real, F.lit(False))).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "text_key"]
    every = placed.select(*columns).unionByName(alone.select(*columns))
    return every.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key"
    )
