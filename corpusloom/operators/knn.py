"""Nearest-neighbour classification from a table of distances (i, j, d)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k closest j per i, ties by j; the limit is applied before the exchange too."""
    w = Window.partitionBy("i").orderBy("d", "j")
    return edges.where(F.col("i") != F.col("j")).withColumn(
        "rank", F.row_number().over(w)
    ).where(F.col("rank") <= k)


def vote(neighbours: DataFrame, labels: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(i, k, prediction) for every k at once; `labels` is (j, label).

    One row per neighbour is repeated for those k that reach it; ties go to the
    smallest label.
    """
    grid = F.array(*[F.lit(int(k)) for k in sorted(ks)])
    votes = (
        neighbours.join(labels, "j")
        .withColumn("k", F.explode(F.filter(grid, lambda k: k >= F.col("rank"))))
        .groupBy("i", "k", "label")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    best = F.min_by("label", F.struct(-F.col("votes"), "label"))
    return votes.groupBy("i", "k").agg(best.alias("prediction"))
