import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from corpusloom.llm import prefix_trie


def brute(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append(((turn is not None, turn or 0, name), (role, text)))
    convs = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, children = collections.defaultdict(list), collections.defaultdict(set)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if built[c] == p)))
        up = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), up, len(members[p]), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, words string")
    got = prefix_trie.trie_nodes(prefix_trie.rebuilt(prefix_trie.conversations_of(frame)))
    return sorted((tuple(r) for r in got.collect()), key=str)


def table(seed=5):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-30, 250), 10**12, 10**12 + 1]:
        for t in range(rnd.choice([1, 1, 2, 3, 4, 6, 9])):
            turn = t if rnd.random() > 0.05 else None
            rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "c\td e", "", "hello there x", None, "é y"])))
    rows += [(None, 1, "a", "b"), (7, 0, "user", "a b"), (7, 0, "user", "a b")]
    rows += [(c, i, "u", f"w{i % 7}") for c in (777, 778) for i in range(c - 600)]  # long, one the beginning of the other
    return rows


@pytest.mark.parametrize("size", [2 << 20, 600])
def test_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(prefix_trie, "RANGE_BYTES", size)  # small: many ranges, so nodes reach over their edges
    rows = table()
    assert run(spark, rows) == brute(rows)


def test_copies_and_no_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    rows = [(c, t, "user", "same words here") for c in range(60) for t in range(2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_ranges_of_a_tree_add_up():
    """Whatever the cuts, the sums over ranges are those of one range."""
    rnd = random.Random(1)
    seqs = sorted({tuple(rnd.randrange(3) for _ in range(rnd.randrange(9))) for _ in range(200)})
    rows = [
        {"key": b"".join(bytes(15) + bytes([x]) for x in s), "n": 1 + i % 3, "conv": i, "words": [x + 1 for x in s], "ends": "e"}
        for i, s in enumerate(seqs)
    ]

    def totals(cuts):
        total = collections.Counter()
        ranges = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]) if a < b]
        for i, part in enumerate(ranges):
            before = ranges[i - 1][-1]["key"] if i else None
            after = ranges[i + 1][0]["key"] if i + 1 < len(ranges) else None
            for r in prefix_trie.range_nodes(part, before, after):
                if r["depth"] == 0:
                    total.update({c: r[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")})
        return total

    whole = totals([])
    for _ in range(50):
        assert totals(sorted(rnd.sample(range(1, len(rows)), rnd.randrange(1, 12)))) == whole


def test_layouts_grow_and_keep_order():
    tree = prefix_trie.RadixTree()
    keys = [bytes([b]) + bytes(3) for b in random.Random(2).sample(range(256), 256)]
    kinds = set()
    for i, key in enumerate(keys):
        tree.insert(key, i)
        kinds.add(tree.root.kind)
    assert kinds == {4, 16, 48, 256}
    assert [keys[c.value] for c in tree.root.children()] == sorted(keys)
    assert all(tree.root.find(k[0]).value == i for i, k in enumerate(keys))
