"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a local one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """fn over the Arrow batches of each partition."""
    return df.mapInArrow(fn, schema)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def partitions_for(df: DataFrame, rows_each: int) -> int:
    """A number of parts that grows with the rows of df (one count of df)."""
    return max(1, -(-df.count() // rows_each))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
