"""Cutting the lineage of long or iterative jobs on reliable storage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a local folder only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return
    if current is not None:
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_tidied: dict[str, tuple[int, str | None]] = {}  # by session: calls under way, the setting before them


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go as soon as it is done; otherwise they stay until the
    driver collects garbage, and those of all rounds of a loop lie on disk at once. A plan that is
    run again makes them again."""
    key = str(spark.sparkContext.applicationId)
    with _lock:
        n, before = _tidied.get(key, (0, None))
        if not n:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _tidied[key] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _tidied[key]
            _tidied[key] = n - 1, before
            if n == 1 and before is None:
                spark.conf.unset(_CLEANUP)
            elif n == 1:
                spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from the written copy. What was shuffled for it is
    removed."""
    ensure_checkpoint_dir(df.sparkSession)
    with _tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # planned anew: a plan keeps the setting it was made under


class Turns:
    """The state of a loop, written to two folders of the checkpoint folder in turn, so that however
    many rounds there are, the last two states are all that lies on disk."""

    def __init__(self, spark: SparkSession):
        ensure_checkpoint_dir(spark)
        self.spark, self.n = spark, 0
        self.path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/turns_{uuid.uuid4().hex}"

    def cut(self, df: DataFrame) -> DataFrame:
        """df as it was written; it may read the state before, but none older."""
        self.n += 1
        path = f"{self.path}/{self.n % 2}"
        with _tidy(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, keys: list[str]) -> Iterator[DataFrame]:
    """df as a table bucketed and sorted by keys, for many joins on them: it is never shuffled again,
    and results grouped by the same keys are joined to it where they are. The table lies in the
    checkpoint folder and is dropped from the catalog at the end."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}"
    with _tidy(spark):
        df.repartition(parts, *keys).write.bucketBy(parts, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
