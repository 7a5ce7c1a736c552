"""Pre-trained word vectors from a text file: 'word v1 ... vd' per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def parse_vector_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """(term, vec): long instead of one column per word."""
    parts = F.split(F.col(value), " ")
    return lines.select(
        parts[0].alias("term"),
        F.slice(parts, 2, F.size(parts) - 1).cast("array<double>").alias("vec"),
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    return parse_vector_lines(spark.read.text(path))
