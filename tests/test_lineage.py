"""What loops leave on disk."""

import os
import tempfile
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import keywords as G, lineage


def shuffled(spark):
    """Shuffle files of this machine."""
    named = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", None) or "/tmp"
    tops = {*named.split(","), tempfile.gettempdir()}
    return {f for top in tops for f in Path(top).glob("**/blockmgr-*/*/shuffle_*.data")}


def written(spark):
    lineage.ensure_checkpoint_dir(spark)
    top = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    return {f for f in top.iterdir()}


def test_cut_leaves_no_shuffle_files(spark):
    before = shuffled(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    kept = lineage.cut(df)
    for _ in range(100):
        if not shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffled(spark) - before
    assert {r.k: r.n for r in kept.collect()} == {r.k: r.n for r in df.collect()}  # runs again where it is asked for
    assert spark.conf.get(lineage._CLEANUP, None) in (None, "false")


def test_turns_keep_two_states(spark):
    turns = lineage.Turns(spark)
    now = spark.createDataFrame([(i, float(i)) for i in range(20)], "id bigint, x double")
    for _ in range(5):
        now = turns.cut(now.withColumn("x", F.col("x") + 1))
    assert {(r.id, r.x) for r in now.collect()} == {(i, i + 5.0) for i in range(20)}
    assert len(list(Path(turns.path.removeprefix("file:")).iterdir())) == 2


@pytest.mark.parametrize("tolerance", [1e-5, 1e-15])
def test_rounds_of_ranks_write_no_more_for_more_rounds(spark, tolerance):
    pairs = [(f"w{i}", f"w{(i * i + 1) % 30}", 1 + i % 4) for i in range(30)]
    edges = spark.createDataFrame([("g", min(a, b), max(a, b), w) for a, b, w in pairs], "grp string, a string, b string, w bigint")
    edges = edges.groupBy("grp", "a", "b").agg(F.sum("w").alias("w"))
    before = written(spark)
    assert G.pagerank(edges, tolerance=tolerance, local_edges=5).count() == 30
    # edges, sizes, large groups, two of strengths, words, links, states
    assert len(written(spark) - before) <= 8
