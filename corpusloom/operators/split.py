"""Reproducible splits and folds in the order of a seeded hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.text import unit_hash
from corpusloom.operators.joins import small
from corpusloom.operators.lineage import cut
from corpusloom.operators.order_stats import hash_cuts, hash_ranks


def _train_up_to(df: DataFrame, order: Column, cuts: DataFrame, strata: list[str]) -> DataFrame:
    """Rows stay where they are: their own hash is compared with the one at the cut."""
    if strata:
        placed = df.join(small(cut(cuts)), strata)
    else:
        placed = df.withColumn("cut", cuts.select("cut").scalar())
    return placed.withColumn("split", F.when(order <= F.col("cut"), "train").otherwise("test")).drop("cut")


def stratified_split(
    df: DataFrame, label: str, key: str, p: float = 0.8, seed: int = 42
) -> DataFrame:
    """Column `split`: the first ceil(p * n) keys of each class are 'train', the rest 'test'.
    Keys are unique; rows without a class are left out."""
    order = unit_hash(seed, F.col(key))
    cuts = hash_cuts(df, order, lambda n: F.ceil(n * F.lit(p)), [label])
    return _train_up_to(df, order, cuts, [label])


def random_split(df: DataFrame, key: str, p: float = 0.75, seed: int = 42) -> DataFrame:
    """As above without classes; the training size is p * n rounded half to even."""
    order = unit_hash(seed, F.col(key))
    cuts = hash_cuts(df, order, lambda n: F.bround(n * F.lit(p), 0))
    return _train_up_to(df, order, cut(cuts), [])


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Column `fold` (0-based): classes are dealt out evenly over the folds."""
    ranked = hash_ranks(df, unit_hash(seed, F.col(key)), [label])
    return ranked.withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop(
        "rank", "stratum_n"
    )
