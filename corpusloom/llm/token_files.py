"""Token-ID output: ORC files of token ids with row indexes and Bloom filters.

One row per document: doc_id, n_tokens, ids (array of int). Files hold ascending ranges of doc_id.
ORC writes ids by integer run-length encoding in stripes, min/max row indexes every few thousand
rows and Bloom filters on doc_id, so readers take single stripes and skip those without their ids.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, mapped, text_or_empty
from corpusloom.llm.words import worker_words

OUT_VALUES = 1 << 20  # ids per Arrow batch that goes back to Spark


def _encode(batches: Batches, path: str, end_id: int) -> Batches:
    words = worker_words(path)
    end = np.array([end_id], np.uint32)

    def out(keys, parts):
        lens = np.fromiter(map(len, parts), np.int32, len(parts))
        offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
        ids = np.concatenate(parts).view(np.int32)
        return pa.record_batch(
            [pa.array(keys, pa.int64()), pa.array(lens.astype(np.int64)), pa.ListArray.from_arrays(offsets, ids)],
            names=["doc_id", "n_tokens", "ids"],
        )

    for batch in batches:
        keys, parts, n = [], [], 0
        for key, ids in zip(batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist())):
            keys.append(key)
            parts += [np.concatenate([ids, end])]
            n += len(ids)
            if n >= OUT_VALUES:
                yield out(keys, parts)
                keys, parts, n = [], [], 0
        if keys:
            yield out(keys, parts)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, stride: int = 2000, false_positives: float = 0.01
) -> None:
    """Tokenize the whole text of every row of docs (doc_id, text) and write ORC files to path.

    A null or empty text gives the end id alone; repeated doc_ids are kept as rows of their own; an
    empty table writes a folder without rows. Other columns are not read. Documents are dealt to
    sorted, disjoint ranges of doc_id (sampled range partitioning, as text, which is smaller than
    ids), then tokenized where they are written, so ids are never shuffled.
    """
    dealt = docs.select("doc_id", text_or_empty()).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    tokens = mapped(
        dealt, partial(_encode, path=tokenizer, end_id=end_id), "doc_id long, n_tokens long, ids array<int>"
    )
    (
        tokens.write.option("compression", "zstd")
        .option("orc.row.index.stride", str(stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(false_positives))
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the token files; doc_ids are looked up through row indexes and Bloom filters."""
    df = spark.read.schema("doc_id long, n_tokens long, ids array<int>").orc(path)
    return df if doc_ids is None else df.filter(F.col("doc_id").isin(doc_ids))


def _digests(batches: Batches) -> Batches:
    for batch in batches:
        ids = batch.column("ids")
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = ids.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64()), batch.column("file")],
            names=["doc_id", "n_tokens", "ids_crc32", "file"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens and the
    crc32 of its ids as little-endian unsigned 32-bit integers.

    Files hold disjoint ranges of doc_id, so only one total per file is ordered globally; starts
    inside a file are a running sum of its rows.
    """
    rows = mapped(
        read_token_files(spark, path).select("doc_id", "ids", F.input_file_name().alias("file")),
        _digests,
        "doc_id long, n_tokens long, ids_crc32 long, file string",
    )
    files = (
        read_token_files(spark, path)
        .select("doc_id", "n_tokens", F.input_file_name().alias("file"))
        .groupBy("file")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum("n_tokens").alias("n"))
    )
    order = Window.orderBy(F.col("first").asc_nulls_first(), F.col("last").asc_nulls_first(), "file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("file")
        .orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(F.broadcast(bases), "file")  # one row per file
        .withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .select("doc_id", "start", "n_tokens", "ids_crc32")
    )
