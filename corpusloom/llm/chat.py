"""Conversations from reply trees.

Messages point to their parent. Iterative self-joins double the reach of every message (parents of
parents) until all reach their root, and add up scores on the way, so the number of joins grows with
the logarithm of the depth. Every leaf ends one branch; the branches of a tree are ranked by the
mean score of their messages. A chosen branch finds its messages by walking the same table of jumps
back from its leaf, and is formatted as one conversation.

Format: <|im_start|>role, newline, text, <|im_end|>, newline for each turn. Inside texts `\\` is
written `\\\\` and `<|` is written `<\\|`, so a text never holds a control string and reads back as it
was; in roles `%`, newline and `<|` are written %25, %0A and <%7C. The loss mask covers the texts of
assistant turns, as spans of code points of the formatted string.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, stored

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"

_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END), re.S)


def escape_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape_text(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return role.replace("%", "%25").replace("\n", "%0A").replace("<|", "<%7C")


def unescape_role(role: str) -> str:
    return role.replace("<%7C", "<|").replace("%0A", "\n").replace("%25", "%")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted conversation."""
    return [(unescape_role(r), unescape_text(t)) for r, t in _TURN.findall(formatted)]


def threads(turns: DataFrame, tree: str = "conv_id", order: str = "turn") -> DataFrame:
    """Messages (tree, id, parent, role, text, score) of linear conversations: each turn replies to
    the one before it. Rows with equal turns follow by role and text; null turns come first."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    by = Window.partitionBy("tree").orderBy(F.col(order).asc_nulls_first(), "role", "text")
    rows = turns.select(F.col(tree).alias("tree"), order, role.alias("role"), text.alias("text"))
    place = F.row_number().over(by).cast("long")
    return rows.select(
        "tree",
        place.alias("id"),
        F.when(place > 1, place - 1).alias("parent"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def _reach(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of jumps (tree, id, up) of 1, 2, 4, ... messages, and for each message its depth and
    the sum of scores from its root."""
    step = stored(
        messages.select("tree", "id", F.col("parent").alias("up"), F.lit(1).cast("long").alias("n"), F.col("score").alias("total")),
        "jumps",
    )
    jumps = [step.filter("up is not null").select("tree", "id", "up")]
    for _ in range(messages.count().bit_length() + 1):  # what goes further up than all messages is a cycle
        if step.filter("up is not null").isEmpty():
            break
        far = step.select("tree", F.col("id").alias("up"), F.col("up").alias("up2"), F.col("n").alias("n2"), F.col("total").alias("total2"))
        going = step.filter("up is not null").join(far, ["tree", "up"], "left")
        step = stored(
            step.filter("up is null").unionByName(
                going.select(
                    "tree", "id", F.col("up2").alias("up"),
                    (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"),
                    (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
                )
            ),
            "jumps",
        )
        jumps.append(step.filter("up is not null").select("tree", "id", "up"))
    return jumps[:-1], step.filter("up is null").select("tree", "id", F.col("n").alias("depth"), "total")


def branches(messages: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Every root-to-leaf path as (tree, leaf, depth, score, rank), best mean score first, ties to
    the deeper branch and then the smaller leaf; the depth of each message; the jumps to walk."""
    jumps, reached = _reach(messages)
    parents = messages.select("tree", F.col("parent").alias("id")).filter("id is not null").distinct()
    leaves = reached.join(parents, ["tree", "id"], "left_anti")
    score = F.col("total") / F.col("depth")
    by = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf")
    return (
        leaves.select("tree", F.col("id").alias("leaf"), "depth", score.alias("score"))
        .withColumn("rank", F.row_number().over(by)),
        reached.select("tree", "id", "depth"),
        jumps,
    )


def _on_paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """tree, leaf, id of all messages on the chosen branches: from the longest jump down, whatever
    is found jumps once more, which fills the gaps between."""
    found = chosen.select("tree", "leaf", F.col("leaf").alias("id"))
    for jump in reversed(jumps):
        further = found.join(jump, ["tree", "id"]).select("tree", "leaf", F.col("up").alias("id"))
        found = stored(found.unionByName(further).distinct(), "paths")
    return found


def _format(batches: Batches) -> Batches:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        formatted, masks = [], []
        for turns in batch.column("turns").to_pylist():
            parts, spans, at = [], [], 0
            for t in turns:
                head, body = f"{START}{escape_role(t['role'])}\n", escape_text(t["text"])
                if t["role"] == LEARNED:
                    spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
                parts += [head, body, END]
                at += len(head) + len(body) + len(END)
            formatted.append("".join(parts))
            masks.append(spans)
        columns = [batch.column(c) for c in ("tree", "leaf")]
        yield pa.record_batch(
            [*columns, pa.array(formatted, pa.string()), pa.array(masks, kind)], names=["tree", "leaf", "formatted", "mask"]
        )


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """tree, leaf, formatted, mask of the `best` branches of each tree of messages
    (tree, id, parent, role, text, score); mask is an array of (start, end).

    Null roles and texts are empty, null scores 0, null trees are one tree. A message whose parent
    is missing is a root; rows that repeat (tree, id) are one message, the least of them. Messages
    on a cycle, or below one, have no root and are left out. An empty table gives an empty result.
    """
    key = F.coalesce(F.col("tree"), F.lit(-(2**63)))
    filled = messages.select(
        key.alias("tree"), "id", "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    one = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    said = stored(filled.groupBy("tree", "id").agg(one).select("tree", "id", "m.*"), "messages")
    # whose parent is there is found without the texts
    links = said.select("tree", "id", "parent", "score")
    known = links.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    rows = stored(
        links.join(known, ["tree", "parent"], "left").select(
            "tree", "id", F.when(F.col("known"), F.col("parent")).alias("parent"), "score"
        ),
        "links",
    )
    ranked, depths, jumps = branches(rows)
    chosen = stored(ranked.filter(F.col("rank") <= best), "chosen")
    said = said.join(depths, ["tree", "id"]).select("tree", "id", "depth", "role", "text")
    turns = F.transform(
        F.sort_array(F.collect_list(F.struct("depth", "id", "role", "text"))),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
    )
    paths = _on_paths(chosen, jumps).join(said, ["tree", "id"]).groupBy("tree", "leaf").agg(turns.alias("turns"))
    named = paths.select(F.when(F.col("tree") != -(2**63), F.col("tree")).alias("tree"), "leaf", "turns")
    return mapped(named, _format, "tree long, leaf long, formatted string, mask array<struct<start: long, end: long>>")


def _read_back(batches: Batches) -> Batches:
    for batch in batches:
        rows = []
        for tree, text, mask in zip(*(batch.column(c).to_pylist() for c in ("tree", "formatted", "mask"))):
            turns = read_turns(text)
            loss = "".join(unescape_text(text[m["start"] : m["end"]]) for m in mask)
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
            rows.append((tree, len(turns), digests[0], len(loss), digests[1], len(text)))
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def digests(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation, from a reading of its string and mask: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return mapped(formatted, _read_back, schema)
