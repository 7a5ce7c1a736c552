"""Statistics of the prefix trie of conversations, from adaptive radix trees over turn ids.

A turn is named by 16 bytes: the first half of the SHA-256 of its role and text, a big-endian number
of fixed width. The key of a conversation is the names of its turns in a row, so two conversations
share their first d turns exactly when their keys share their first 16 d bytes.

Equal keys are one sequence with a count, its least conversation and a digest of its members. Distinct
keys are range-partitioned, so that a first turn that a third of all conversations share is spread over
as many ranges as it needs. Every range builds an adaptive radix tree: inner nodes of 4, 16, 48 or
256 places that grow as children arrive, paths without branches compressed into one node. A walk from
the leaves up emits one trie node per depth that ends a whole turn, on compressed paths too.

Only nodes on the first or last key of a range can reach into another one. A range gets the keys next
to it, so it knows which of its nodes an earlier range counts, and which go on in a later one. All
sums then add up over ranges, and these few nodes are merged by the digest of their path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, stored
from corpusloom.operators.joins import salted_lookup

WIDTH = 16  # bytes of a turn id
RANGE_BYTES = 2 << 20  # keys of a range, about
PIECE_IDS = 50_000  # conversation ids in a piece of a list
WORDS = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()


# --- adaptive radix tree ---------------------------------------------------------------------------


class Node:
    """A tree node after a compressed path. `value` is the sequence that ends here; children are kept
    in one of four layouts, by number."""

    __slots__ = ("path", "value", "kind", "index", "places")

    def __init__(self, path: bytes, value: int | None = None):
        self.path, self.value = path, value
        self.kind = 4
        self.index = bytearray()  # 4 and 16: sorted bytes; 48: place of each byte, plus one; 256: unused
        self.places: list[Node | None] = []

    def find(self, byte: int) -> Node | None:
        if self.kind == 256:
            return self.places[byte]
        if self.kind == 48:
            at = self.index[byte]
            return self.places[at - 1] if at else None
        at = self.index.find(byte)
        return self.places[at] if at >= 0 else None

    def put(self, byte: int, child: Node) -> None:
        """Add child, or set it in place of the one at this byte."""
        if self.kind <= 16:
            at = self.index.find(byte)
            if at >= 0:
                self.places[at] = child
                return
            if len(self.places) == self.kind:
                self._grow()
                self.put(byte, child)
                return
            at = sum(b < byte for b in self.index)
            self.index.insert(at, byte)
            self.places.insert(at, child)
        elif self.kind == 48:
            if self.index[byte]:
                self.places[self.index[byte] - 1] = child
            elif len(self.places) == 48:
                self._grow()
                self.put(byte, child)
            else:
                self.places.append(child)
                self.index[byte] = len(self.places)
        else:
            self.places[byte] = child

    def _grow(self) -> None:
        if self.kind == 4:
            self.kind = 16
        elif self.kind == 16:
            places = bytearray(256)
            for i, b in enumerate(self.index):
                places[b] = i + 1
            self.kind, self.index = 48, places
        else:
            direct: list[Node | None] = [None] * 256
            for b in range(256):
                if self.index[b]:
                    direct[b] = self.places[self.index[b] - 1]
            self.kind, self.index, self.places = 256, bytearray(), direct

    def children(self) -> Iterator[Node]:
        """In the order of their bytes."""
        if self.kind <= 16:
            yield from self.places
        elif self.kind == 48:
            yield from (self.places[self.index[b] - 1] for b in range(256) if self.index[b])
        else:
            yield from (c for c in self.places if c is not None)


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the common beginning of a and b."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value: int) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.value = value
                return
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Node(key[at:], value))
                return
            same = shared_length(child.path, key[at : at + len(child.path)])
            if same < len(child.path):  # cut the path where the keys part
                upper = Node(child.path[:same])
                child.path = child.path[same:]
                upper.put(child.path[0], child)
                node.put(key[at], upper)
                child = upper
            node, at = child, at + same


# --- statistics of one range -----------------------------------------------------------------------


class Stats:
    """What is summed up over the part of a subtree that lies in this range. conv, n: least member and
    members of the node last emitted; some: a sequence below it; children: emitted nodes right below
    the present place that this range counts; below: whether any node is there; waiting: the rows of
    those nodes, which still lack their parent."""

    __slots__ = ("conv", "n", "some", "children", "below", "leaves", "saved", "waiting")

    def __init__(self):
        self.conv, self.n, self.some = None, 0, -1
        self.children, self.below, self.leaves, self.saved = 0, False, 0, 0
        self.waiting: list[dict] = []

    def add(self, other: Stats) -> None:
        self.conv = other.conv if self.conv is None else min(self.conv, other.conv)
        self.n += other.n
        self.some = other.some
        self.children += other.children
        self.below |= other.below
        self.leaves += other.leaves
        self.saved += other.saved
        self.waiting += other.waiting


def range_nodes(rows: list[dict], before: bytes | None, after: bytes | None) -> Iterator[dict]:
    """Trie nodes of the sequences of a range (key, n, conv, words, ends), given the last key of the
    range before and the first one of the range after (None: there is none).

    edge: the digest of the path of a node that may be in another range too, else null; parent_edge
    likewise for its parent, whose conversation is then left null. n_children, n_leaves and
    saved_tokens leave out what an earlier range counts.
    """
    tree = RadixTree()
    keys = [r["key"] for r in rows]
    for i, key in enumerate(keys):
        tree.insert(key, i)
    first, last = min(keys), max(keys)
    back = shared_length(first, before) // WIDTH if before is not None else -1
    ahead = shared_length(last, after) // WIDTH if after is not None else -1
    sure = {d: hashlib.sha256(first[: d * WIDTH]).hexdigest() for d in range(back + 1)}
    sure_next = {d: hashlib.sha256(last[: d * WIDTH]).hexdigest() for d in range(ahead + 1)}

    def emit(depth: int, at: Stats, value: int | None) -> Iterator[dict]:
        """The trie node of `depth` above what `at` holds; at becomes what its parent adds."""
        row = rows[value] if value is not None else None
        if row:
            at.conv = row["conv"] if at.conv is None else min(at.conv, row["conv"])
            at.n += row["n"]
            at.some = value
        key = keys[at.some]
        shared_before = depth <= back and key[: depth * WIDTH] == first[: depth * WIDTH]
        shared_after = depth <= ahead and key[: depth * WIDTH] == last[: depth * WIDTH]
        edge = sure[depth] if shared_before else sure_next[depth] if shared_after else None
        words = rows[at.some]["words"][depth - 1] if depth else 0
        at.saved += at.n * words - (0 if shared_before else words)
        at.leaves += not at.below and not shared_after
        for child in at.waiting:
            child["parent_conv_id"] = None if edge else at.conv
            child["parent_edge"] = edge
            yield child
        node = {
            "edge": edge, "conv_id": at.conv, "depth": depth, "parent_conv_id": None, "parent_edge": None, "n_convs": at.n,
            "n_children": at.children, "n_leaves": at.leaves, "saved_tokens": at.saved, "ends_sha256": row["ends"] if row else None,
        }
        at.waiting, at.children, at.below = [node], int(not shared_before), True

    stack: list[tuple[Node, int, Iterator[Node], Stats]] = [(tree.root, 0, tree.root.children(), Stats())]
    while stack:
        node, end, left, at = stack[-1]
        child = next(left, None)
        if child is not None:
            stack.append((child, end + len(child.path), child.children(), Stats()))
            continue
        stack.pop()
        begin = end - len(node.path)
        lowest = end // WIDTH
        top = begin // WIDTH + 1 if stack else 0  # the root's depth is 0
        for depth in range(lowest, top - 1, -1):
            yield from emit(depth, at, node.value if depth * WIDTH == end else None)
        if stack:
            stack[-1][3].add(at)
        else:
            yield from at.waiting


NODE = (
    "edge string, conv_id long, depth long, parent_conv_id long, parent_edge string, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
_NODE = pa.schema(
    [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in NODE.split(", ")]
)


def _range(sequences: pa.Table, around: pa.Table) -> pa.Table:
    near = around.to_pylist()[0]
    return pa.Table.from_pylist(list(range_nodes(sequences.to_pylist(), near["before"], near["after"])), schema=_NODE)


# --- from turns to sequences -----------------------------------------------------------------------


def turn_id() -> Column:
    """16 bytes that name role and text; the length of the role keeps the two apart."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(named, 256), 1, 2 * WIDTH))


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as an array of (turn, id, words). Null turns come first, equal
    ones follow by their id; null roles and texts are empty; rows without conv_id are left out."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long")
    rows = turns.filter("conv_id is not null").select("conv_id", F.struct("turn", turn_id().alias("id"), words.alias("words")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(convs: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % group (all of them
    if it has fewer, none if there is no such), h = crc32(c) % most."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    base = convs.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head")
    )
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(base, "base", "left")
    head = F.slice(F.coalesce("head", F.filter("turns", lambda t: F.lit(False))), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.size("turns"))
    return own.select("conv_id", F.concat(head, rest).alias("turns"))


def _pieces(batches: Batches) -> Batches:
    """Runs of one sequence in rows sorted by (seq, conv_id), cut into pieces: seq, low, n, ids (joined)."""
    names = ["seq", "low", "n", "ids"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        out: list[tuple] = []
        seq, run = None, []
        for s, conv in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if run and (s != seq or len(run) == PIECE_IDS):
                out.append((seq, run[0], len(run), ",".join(map(str, run)).encode()))
                run = []
            seq = s
            run.append(conv)
        if run:
            out.append((seq, run[0], len(run), ",".join(map(str, run)).encode()))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds)], names=names)


def _ends(batches: Batches) -> Batches:
    """seq, n, conv, ends of pieces sorted by (seq, low), hashed as they come by."""
    seq, n, low, digest = None, 0, None, hashlib.sha256()
    schema = pa.schema([("seq", pa.binary()), ("n", pa.int64()), ("conv", pa.int64()), ("ends", pa.string())])
    for batch in batches:
        out = []
        for s, first, count, ids in zip(*(batch.column(c).to_pylist() for c in ("seq", "low", "n", "ids"))):
            if s != seq:
                if seq is not None:
                    out.append((seq, n, low, digest.hexdigest()))
                seq, n, low, digest = s, 0, first, hashlib.sha256()
            digest.update((b"," if n else b"") + ids)
            n += count
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 4, schema)], schema=schema)
    if seq is not None:
        yield pa.record_batch([pa.array([x], f.type) for x, f in zip((seq, n, low, digest.hexdigest()), schema)], schema=schema)


def sequences(convs: DataFrame) -> DataFrame:
    """Distinct sequences of convs (conv_id, turns): key, words, n (members), conv (the least one) and
    ends, the SHA-256 of the members' ids, ascending and comma-joined.

    Members are sorted over all tasks and joined into pieces first, so the one task that has to hash a
    list in order reads it as a stream of few rows.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    rows = stored(
        convs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words")).withColumn(
            "seq", F.unhex(F.sha2("key", 256))
        ),
        "rebuilt",
    )
    kept = rows.groupBy("seq").agg(F.first("key").alias("key"), F.first("words").alias("words"))
    sorted_ = rows.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    pieces = mapped(sorted_, _pieces, "seq binary, low long, n long, ids binary")
    members = mapped(
        pieces.repartition("seq").sortWithinPartitions("seq", "low"), _ends, "seq binary, n long, conv long, ends string"
    )
    return kept.join(members, "seq").select("key", "words", "n", "conv", "ends")


def trie_nodes(convs: DataFrame) -> DataFrame:
    """Every node of the trie of convs (conv_id distinct, turns an array of (turn, id, words)), from
    the root (depth 0): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    A conversation without turns is a member of the root alone. No conversations give no node. One
    conversation's ids are handled as one row.
    """
    found = stored(sequences(convs), "sequences")
    size = found.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    parts = int(size // RANGE_BYTES) + 1
    ranged = stored(found.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "ranges")
    bounds = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    around = stored(
        bounds.select("part")
        .join(bounds.select((F.col("part") + 1).alias("part"), F.col("last").alias("before")), "part", "left")
        .join(bounds.select((F.col("part") - 1).alias("part"), F.col("first").alias("after")), "part", "left"),
        "around",
    )
    nodes = stored(ranged.groupBy("part").cogroup(around.groupBy("part")).applyInArrow(_range, NODE), "trie-nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    edges = stored(
        nodes.filter("edge is not null")
        .groupBy("edge")
        .agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.max("parent_edge").alias("parent_edge"),
            *sums, F.max("ends_sha256").alias("ends_sha256"),
        ),
        "edges",
    )
    every = nodes.filter("edge is null").drop("edge").unionByName(edges.drop("edge").withColumn("parent_conv_id", F.lit(None).cast("long")))
    # children of a node that is in several ranges: at the root, a third of all nodes or more
    parents = edges.select(F.col("edge").alias("parent_edge"), F.col("conv_id").alias("known"), (F.col("n_children") + 1).alias("rows"))
    below = salted_lookup(every.filter("parent_edge is not null"), parents, "parent_edge", "rows", F.col("conv_id"))
    placed = below.withColumn("parent_conv_id", F.col("known")).drop("known", "rows")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return (
        every.filter("parent_edge is null")
        .unionByName(placed)
        .select(*columns, F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    )
