"""Statistics of a corpus and of its documents."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import text as X
from corpusloom.operators.lineage import cut
from corpusloom.operators.order_stats import (
    cumulative,
    hinge_position,
    order_statistics,
    pick,
    quantile_position,
    value_counts,
)


def corpus_stats(posts: DataFrame, text: str = "text") -> DataFrame:
    """Types, tokens (punctuation counts), sentences and type-token ratio per post, row by row."""
    df = posts.withColumn("_toks", X.tokens(F.col(text), X.WORD_OR_MARK))
    return (
        df.withColumn("types", F.size(F.array_distinct("_toks")).cast("bigint"))
        .withColumn("tokens", F.size("_toks").cast("bigint"))
        .withColumn("sentences", X.sentence_count(F.col(text)).cast("bigint"))
        .withColumn("ttr", F.try_divide("types", "tokens"))
        .drop("_toks", text)
    )


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, sum, mean, median, min and max per group, from the counted values."""
    counts = cut(value_counts(df, value, [group]))
    n, v = F.col("n"), F.col("value")
    plain = counts.groupBy(group).agg(
        F.sum(n).alias("cnt"),
        F.sum(v * n).alias("total"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    median = {"median": quantile_position(0.5)}
    return plain.join(pick(cumulative(counts, [group]), median, [group]).drop("n"), group)


def six_numbers(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, quartiles, mean and maximum in one pass over the value counts."""
    counts = cut(value_counts(df, value, by))
    ranked = cumulative(counts, by)
    at = {
        "min": quantile_position(0.0),
        "q1": quantile_position(0.25),
        "median": quantile_position(0.5),
        "q3": quantile_position(0.75),
        "max": quantile_position(1.0),
    }
    # the mean rides along as the weighted mean of the counted values
    means = counts.groupBy(*by).agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean")
    )
    picked = pick(ranked, at, by)
    if by:
        return picked.join(means, list(by))
    return picked.withColumn("mean", means.scalar())


def boxplot_numbers(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Hinges, median, whisker ends (most extreme values inside the fences)."""
    by = list(by)
    counts = cut(value_counts(df, value, by))
    h = pick(
        cumulative(counts, by),
        {
            "lower_hinge": hinge_position(False),
            "median": quantile_position(0.5),
            "upper_hinge": hinge_position(True),
        },
        by,
    )
    spread = F.col("upper_hinge") - F.col("lower_hinge")
    h = h.withColumn("lower_fence", F.col("lower_hinge") - 1.5 * spread).withColumn(
        "upper_fence", F.col("upper_hinge") + 1.5 * spread
    )
    if by:
        joined = counts.join(h.drop("n"), by)
    else:
        fences = h.select(F.struct("lower_fence", "upper_fence")).scalar()
        joined = counts.withColumn("_f", fences).select("*", "_f.*")
    ok = (F.col("value") >= F.col("lower_fence")) & (F.col("value") <= F.col("upper_fence"))
    ends = joined.groupBy(*by).agg(
        F.min(F.when(ok, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(ok, F.col("value"))).alias("upper_whisker"),
        F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )
    if by:
        return h.join(ends, by)
    row = ends.select(F.struct("*")).scalar()
    return h.withColumn("_e", row).select("*", "_e.*").drop("_e")


def tukey_outliers(df: DataFrame, value: str) -> DataFrame:
    """Rows beyond hinge -/+ 1.5 times the hinge spread."""
    h = order_statistics(
        df, value, {"lo": hinge_position(False), "hi": hinge_position(True)}
    ).select(
        F.struct(
            (F.col("lo") - 1.5 * (F.col("hi") - F.col("lo"))).alias("lo"),
            (F.col("hi") + 1.5 * (F.col("hi") - F.col("lo"))).alias("hi"),
        )
    ).scalar()
    fences = df.withColumn("_f", h)
    return fences.where(
        (F.col(value) < F.col("_f.lo")) | (F.col(value) > F.col("_f.hi"))
    ).drop("_f")


def top_outlier_rows(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose value is among the n largest outlying values (ties give more rows).

    The n-th value is taken over rows, as a sorted list of outliers would give it.
    """
    largest = tukey_outliers(df, value).orderBy(F.desc(value)).limit(n).select(value).distinct()
    return df.join(largest, value, "left_semi")


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """H with tie correction, degrees of freedom and p-value; one row.

    Ranks come from counts per distinct value, never from sorting rows in one task.
    """
    per = cut(value_counts(df.where(F.col(group).isNotNull()), value, [group]))
    merged = per.groupBy("value").agg(F.sum("n").alias("n"))
    ranks = cumulative(merged).select(
        "value",
        (F.col("cum") - (F.col("n") - 1) / 2).alias("rank"),
        F.col("n").alias("tied"),
        "total",
    )
    groups = (
        per.join(ranks, "value")
        .groupBy(group)
        .agg(
            F.sum("n").alias("m"),
            F.sum(F.col("n") * F.col("rank")).alias("r"),
            F.first("total").alias("total"),
        )
    )
    ties = merged.agg(F.sum(F.pow("n", F.lit(3)) - F.col("n"))).scalar()
    n = F.first("total").cast("double")
    raw = 12.0 / (n * (n + 1)) * F.sum(F.col("r") * F.col("r") / F.col("m")) - 3 * (n + 1)
    out = groups.agg(
        (raw).alias("_raw"), n.alias("n"), (F.count(F.lit(1)) - 1).alias("df")
    ).select(
        F.col("n").cast("bigint").alias("n"),
        "df",
        (F.col("_raw") / (1 - ties / (F.pow("n", F.lit(3)) - F.col("n")))).alias("h"),
    )
    return out.withColumn("p_value", _chi2_upper(F.col("h"), F.col("df")))


def _chi2_upper(x, dof):
    """Upper tail of the chi-square law for whole degrees of freedom, as a finite series."""
    half = x / 2

    def series(first, count, step):
        start = F.struct(first.alias("term"), F.lit(0.0).alias("sum"))
        added = F.aggregate(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            start,
            lambda acc, i: F.struct(
                (acc["term"] * half / (i + step)).alias("term"),
                (acc["sum"] + acc["term"]).alias("sum"),
            ),
        )
        return F.when(count >= 1, added["sum"]).otherwise(F.lit(0.0))

    even_terms = F.floor(dof / 2).cast("int") - 1
    odd_terms = F.floor((dof - 1) / 2).cast("int")
    even = F.exp(-half) * (1 + series(half, even_terms, 1.0))
    odd = _erfc(F.sqrt(half)) + F.exp(-half) * series(
        F.sqrt(half) * (2 / math.sqrt(math.pi)), odd_terms, 0.5
    )
    return F.when(dof % 2 == 0, even).otherwise(odd)


def _erfc(z):
    """Rational approximation of the complementary error function (relative error < 1.2e-7)."""
    t = 1.0 / (1.0 + 0.5 * z)
    # Chebyshev coefficients of the published approximation.
    coefficients = [
        -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
        0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
    ]
    poly = F.lit(0.0)
    for c in reversed(coefficients):
        poly = poly * t + c
    return t * F.exp(-z * z + poly)


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Count and share per class; the total is one scalar over the counted classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def posts_per_group(df: DataFrame, group: str, key: str) -> DataFrame:
    """Distinct keys per group: first made distinct on the full key, so a group of any
    size is counted in parallel."""
    return (
        df.select(group, key).distinct().groupBy(group).agg(F.count(key).alias("n_posts"))
    )
