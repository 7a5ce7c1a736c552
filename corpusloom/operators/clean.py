"""Cleaning of raw discussion posts.

Two shapes are served. A post held as one row with its lines in an array
(`lines: array<struct<line_no, text>>`, what the file source returns) is cleaned
inside that row, without a shuffle. A table with one row per line is cleaned with
one shuffle on the post key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

LINE = "struct<line_no:int,text:string>"

# What marks a line as reply matter.
CONTENT_LINE = r"^[^>|}]+[A-Za-z0-9]"
ATTRIBUTION_END = r"writes(:|\.\.\.)$"
ARTICLE_START = "In article <"


def _is_content(text: Column) -> Column:
    return (
        text.rlike(CONTENT_LINE)
        & ~text.rlike(ATTRIBUTION_END)
        & ~text.startswith(ARTICLE_START)
        & (text != "")
    )


# --- one post per row ------------------------------------------------------

def body_of(lines: Column) -> Column:
    """Lines from the first empty one up to the first one that starts with '-'.

    A post without an empty line, or with a '-' line above it, keeps nothing.
    """
    size = F.size(lines)
    first_empty = F.array_position(F.transform(lines, lambda x: x["text"] == ""), True)
    first_dash = F.array_position(
        F.transform(lines, lambda x: x["text"].startswith("-")), True
    )
    end = F.when(first_dash == 0, size + 1).otherwise(first_dash)
    keep = (first_empty > 0) & (end > first_empty)
    return F.when(
        keep, F.slice(lines, first_empty.cast("int"), (end - first_empty).cast("int"))
    ).otherwise(F.array().cast(f"array<{LINE}>"))


def unquoted(lines: Column) -> Column:
    return F.filter(lines, lambda x: _is_content(x["text"]))


def merged(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda x: x["text"]), " ")


def clean_posts(posts: DataFrame, lines: str = "lines", text: str = "post_txt") -> DataFrame:
    """Raw posts to cleaned posts; posts left without a line disappear."""
    kept = posts.withColumn(lines, body_of(F.col(lines)))
    kept = kept.withColumn(lines, unquoted(F.col(lines))).where(F.size(lines) > 0)
    return kept.withColumn(text, merged(F.col(lines))).drop(lines)


def to_lines(posts: DataFrame, lines: str = "lines") -> DataFrame:
    others = [c for c in posts.columns if c != lines]
    return (
        posts.select(*others, F.explode_outer(lines).alias("_line"))
        .where(F.col("_line").isNotNull())
        .select(*others, "_line.line_no", "_line.text")
    )


# --- one line per row ------------------------------------------------------

def strip_header_and_signature(
    lines: DataFrame, post: Sequence[str] = ("newsgroup", "id"), order: str = "line_no"
) -> DataFrame:
    whole = Window.partitionBy(*post)
    first_empty = F.min(F.when(F.col("text") == "", F.col(order))).over(whole)
    first_dash = F.min(F.when(F.col("text").startswith("-"), F.col(order))).over(whole)
    return (
        lines.withColumn("_from", first_empty)
        .withColumn("_to", first_dash)
        .where(F.col(order) >= F.col("_from"))
        .where(F.col("_to").isNull() | (F.col(order) < F.col("_to")))
        .drop("_from", "_to")
    )


def strip_quotes(lines: DataFrame) -> DataFrame:
    return lines.where(_is_content(F.col("text")))


def merge_lines(
    lines: DataFrame,
    post: Sequence[str] = ("newsgroup", "id"),
    order: str = "line_no",
    text: str = "post_txt",
) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(order, "text")))
    return lines.groupBy(*post).agg(
        F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias(text)
    )
