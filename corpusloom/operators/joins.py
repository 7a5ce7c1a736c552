"""Equi-joins that stay balanced when a few keys hold much of one side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.lineage import cut

HOT_SHARE = 0.001
SMALL_ROWS = 100_000
SHORT_ROWS = 1_000_000  # rows of a word and a number or two, some 100 MB when broadcast


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it is no longer than `rows`, else as it is. For tables with one
    short row per group, class or value; df is counted, so it should be a written table."""
    return F.broadcast(df) if df.count() <= rows else df


def salted_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    spread: Column,
    how: str = "inner",
    hot_share: float = HOT_SHARE,
    most: int = 0,
) -> DataFrame:
    """Join many rows to a table that has one row per key.

    `weight` is the number of `rows` per key, a column of the table. A key with more than
    `hot_share` of all rows is spread over as many salts as it has such shares, so no salt
    holds more than that share. At most 1 / hot_share keys can be that heavy, which bounds
    the broadcast list of them and the copies of the table's rows. A table of at most `most` rows,
    which should be short ones, is broadcast whole, and `rows` stay where they are.
    """
    table = cut(table)  # read three times below
    if most and table.count() <= most:
        return rows.join(F.broadcast(table), key, how)
    total = table.agg(F.sum(weight)).scalar()
    salts = F.ceil(F.col(weight) / (total * F.lit(hot_share)))
    hot = table.where(salts > 1).select(key, salts.alias("_salts"))
    left = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0))
    )
    copies = F.sequence(F.lit(0).cast("bigint"), F.greatest(salts, F.lit(1)) - 1)
    right = table.withColumn("_salt", F.explode(copies))
    return left.drop("_salts").join(right, [key, "_salt"], how).drop("_salt")
