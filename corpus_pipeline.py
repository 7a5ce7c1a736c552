"""From raw documents to packed training sequences: five stages, each on what the one before kept."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusloom.llm import decontaminate, near_dups, packing, secret_scan, toxicity  # noqa: E402
from corpusloom.llm.common import shared_path  # noqa: E402


# Every stage keeps null texts null and all other columns as they were, whatever their names; rows that
# repeat are judged alike; an empty table stays empty; texts are read whole, however long.


def _bare(docs: DataFrame) -> DataFrame:
    """doc_id, text and all else in one column, so that no name clashes with an operator's own."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.col("text").isNull().alias("no_text"), F.struct(*rest).alias("of")).alias("_rest"))


def _whole(docs: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of documents again, those in `new` changed."""
    text = F.when(~F.col("_rest.no_text"), F.col("text"))
    made = {"doc_id": F.col("doc_id"), "text": text, **new}
    return docs.select(*[made.get(c, F.col("_rest.of")[c]).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of `labels` scores below 0.5. It is fitted on the labelled rows of
    the documents given, at most 20,000 of them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return _whole(toxicity.score(_bare(docs), model).filter("score < 0.5"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near duplicates (similarity 0.8 or more). Rows
    with one doc_id and other texts are documents of their own; of rows that repeat both, one stays."""
    kept = near_dups.near_duplicates(docs, percent=80).filter("kept").select("doc_id", F.col("text_key").alias("_key")).distinct()
    named = docs.withColumn("_key", near_dups.text_key()).join(kept, ["doc_id", "_key"], "left_semi")
    return named.dropDuplicates(["doc_id", "_key"]).select(docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of `benchmark`, exact or within its budget of edits."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _whole(decontaminate.mark(_bare(docs), benchmark).filter(F.size("matches") == 0), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark and n_chars counted anew."""
    found = secret_scan.scan(_bare(docs), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # a column of its own: beside a new `text`, expressions inside the mask would read that one
    clean = found.withColumn("_clean", secret_scan.masked(F.col("text"), F.col("spans")))
    count = F.when(F.size("spans") > 0, F.length("_clean").cast("long")).otherwise(F.col("_rest.of")["n_chars"])
    return _whole(clean, docs.columns, text=F.when(~F.col("_rest.no_text"), F.col("_clean")), n_chars=count)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # models, hashing and tokenizers have no SQL form; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn on documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
