"""Benchmark passages in documents, exact or with few edits: pigeonhole pieces and Myers distance.

An item of n characters (lower case, marks and white space as single spaces) may differ by up to
n // chars_per_edit edits. Split into one piece more than edits, at least one piece of a passage
within the budget is intact, so exact hits of pieces, found together by an Aho-Corasick automaton,
lead to every such passage. Around each hit the edit distance is verified by Myers' bit-parallel
algorithm on whole integers of any length.

The benchmark is sent to tasks in blocks of at most BLOCK_CHARS characters; documents are read
through all blocks, row by row, and never shuffled.
"""

from __future__ import annotations

import re
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, text_or_empty

BLOCK_CHARS = 4 << 20
CHARS_PER_EDIT = 16
LEAST_CHARS = 24  # items shorter than this are too common as phrases to tell

_MARKS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
_NOT_WORD = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    """Lower case, anything but letters and digits as one space."""
    text = text.lower()
    if text.isascii():
        return b" ".join(text.encode().translate(_MARKS).split()).decode()
    return " ".join(_NOT_WORD.sub(" ", text).split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of item of nearly equal length, with their places."""
    n = edits + 1
    cuts = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of pattern to any part of text, and the first end of such a part."""
    n = len(pattern)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best = (n, 0)
    for j, c in enumerate(text, 1):
        x = where.get(c, 0) | down
        same = (((x & up) + up) ^ up) | x
        right, left = down | (full & ~(same | up)), up & same
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        if score < best[0]:
            best = (score, j)
        shifted = (right << 1) & full
        up = ((left << 1) & full) | (full & ~(same | shifted))
        down = shifted & same
    return best


class Finder:
    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int):
        self.items = [(key, text, len(text) // chars_per_edit) for key, text in items]
        hits: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, edits) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                hits.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in hits.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best passage of each item in a normal text."""
        best: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        for end, (length, places) in self.automaton.iter(text) if self.items else ():
            for i, at in places:
                start = end + 1 - length - at  # of the item, if the piece is in its place
                if (i, start) in tried or best.get(i, (1,))[0] == 0:
                    continue
                tried.add((i, start))
                _, item, edits = self.items[i]
                if text.startswith(item, start) and start >= 0:
                    best[i] = (0, start, start + len(item))
                    continue
                a, b = max(0, start - edits), min(len(text), start + len(item) + edits)
                distance, stop = myers(item, text[a:b])
                if distance <= edits and distance < best.get(i, (edits + 1,))[0]:
                    _, back = myers(item[::-1], text[a : a + stop][::-1])
                    best[i] = (distance, a + stop - back, a + stop)
        return sorted((self.items[i][0], *found) for i, found in best.items())


def _mark(batches: Batches, items: list[tuple[int, str]], chars_per_edit: int) -> Batches:
    finder = Finder(items, chars_per_edit)
    names = ("item_id", "distance", "start", "end")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in names]))
    for batch in batches:
        before = batch.column("matches").to_pylist()
        texts = batch.column("text").to_pylist()
        found = [b + [dict(zip(names, m)) for m in finder.matches(normal(t))] for b, t in zip(before, texts)]
        rest = [n for n in batch.schema.names if n != "matches"]
        yield pa.record_batch([*(batch.column(n) for n in rest), pa.array(found, kind)], names=[*rest, "matches"])


def mark(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, least_chars: int = LEAST_CHARS) -> DataFrame:
    """docs with column matches: array of (item_id, distance, start, end), the best passage of each
    item of benchmark (item_id, text) within its budget of edits; start and end are places in the
    text as normal() writes it.

    Null texts are empty and match nothing; items of fewer than least_chars characters are not
    looked for, items with null id neither; repeated items are found one by one; an input column
    named matches is replaced; an empty benchmark marks nothing.
    """
    usable = benchmark.filter("item_id is not null and text is not null").select("item_id", "text")
    chars = usable.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    rest = docs.drop("matches").withColumn("text", text_or_empty())
    empty = F.array().cast("array<struct<item_id: bigint, distance: bigint, start: bigint, end: bigint>>")
    out = rest.withColumn("matches", empty)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for b in range(blocks):
        rows = usable.filter(block == b).collect()  # about BLOCK_CHARS characters
        items = sorted((r["item_id"], normal(r["text"])) for r in rows)
        items = [(key, text) for key, text in items if len(text) >= least_chars]
        out = mapped(out, partial(_mark, items=items, chars_per_edit=chars_per_edit), schema)
    return out
