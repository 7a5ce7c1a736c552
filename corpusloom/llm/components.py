"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stored


def _roots(arcs: DataFrame) -> DataFrame:
    """id, label of every end of arcs (a < b): each points to its least neighbour below it, and
    pointers are followed to their ends."""
    ends = arcs.select(F.col("b").alias("id"), "a").unionByName(arcs.select(F.col("a").alias("id"), "a"))
    labels = stored(ends.groupBy("id").agg(F.min("a").alias("label")), "labels")
    while True:
        further = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        step = stored(labels.join(further, "label").select("id", "label", "next"), "labels")
        labels = step.select("id", F.col("next").alias("label"))
        if step.filter("label <> next").isEmpty():
            return labels


def connected(links: DataFrame) -> DataFrame:
    """id, label of every end of links (a, b): label is the least id of its component.

    Each round gives all nodes their root and contracts the links to links between roots, so a star
    of any size is one node after a round and rounds grow with the logarithm of the nodes at most.
    Minima are aggregated before they are shuffled, so a node with very many links does not fill a
    task. No links give an empty table.
    """
    pairs = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    arcs = stored(pairs.distinct(), "arcs")
    found = _roots(arcs)
    step = found
    while True:
        left = step.select(F.col("id").alias("a"), F.col("label").alias("low"))
        right = step.select(F.col("id").alias("b"), F.col("label").alias("high"))
        ends = arcs.join(left, "a").join(right, "b").filter("low <> high")
        arcs = stored(ends.select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b")).distinct(), "arcs")
        if arcs.isEmpty():
            return found
        step = _roots(arcs)
        moved = step.select(F.col("id").alias("label"), F.col("label").alias("root"))
        found = stored(found.join(moved, "label", "left").select("id", F.coalesce("root", "label").alias("label")), "labels")
