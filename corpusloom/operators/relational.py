"""Small table helpers that the analyses share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def groups_starting(df: DataFrame, group: str, prefix: str) -> DataFrame:
    """A prefix test reaches the scan; a regular expression would not."""
    return df.where(F.col(group).startswith(prefix))


def groups_in(df: DataFrame, group: str, names: Sequence[str]) -> DataFrame:
    return df.where(F.col(group).isin(list(names)))


def without_ids(df: DataFrame, key: str, ids: Sequence[int]) -> DataFrame:
    return df.where(~F.col(key).isin(list(ids)))


def recode(col: Column, levels: Mapping[str, str]) -> Column:
    """Labels from a short fixed mapping; unknown levels become null."""
    pairs = [F.lit(x) for kv in levels.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col)


def best_row(results: DataFrame, by: Sequence[str], metric: str, param: str) -> DataFrame:
    """The row of the best tuning value: highest metric, then lowest parameter."""
    rest = [c for c in results.columns if c not in by]
    best = F.min_by(F.struct(*rest), F.struct(-F.col(metric), F.col(param)))
    return results.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def positions_in_ranking(df: DataFrame, name: str, value: str, items: Sequence[str]) -> DataFrame:
    """(name, position) of the given items when rows are ranked by value, then name.

    The position is one more than the number of rows ranked before the item: a count
    with partial sums instead of a row number over the whole table.
    """
    wanted = df.where(F.col(name).isin(list(items))).agg(
        F.collect_list(F.struct(F.col(name).alias("k"), F.col(value).alias("v")))
    ).scalar()
    ahead = F.filter(
        "_w",
        lambda x: (F.col(value) > x["v"]) | ((F.col(value) == x["v"]) & (F.col(name) <= x["k"])),
    )
    return (
        df.withColumn("_w", wanted)
        .select(F.explode(ahead).alias("_x"))
        .groupBy(F.col("_x.k").alias(name))
        .agg(F.count(F.lit(1)).alias("position"))
    )
