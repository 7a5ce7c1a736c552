"""Posts as files, and as tables of cleaned posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CLEAN_SCHEMA = "newsgroup string, id string, post_txt string"


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """(newsgroup, id, lines) from a folder <path>/<newsgroup>/<id>.

    A file is read whole, which keeps the order of its lines inside one row.
    """
    files = spark.read.text(f"{path}/*/*", wholetext=True).withColumn("_path", F.input_file_name())
    lines = F.split("value", "\r?\n")
    last_blank = F.element_at(lines, -1) == ""
    lines = F.when(last_blank, F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return files.select(
        F.url_decode(F.regexp_extract("_path", "([^/]+)/[^/]+$", 1)).alias("newsgroup"),
        F.url_decode(F.regexp_extract("_path", "([^/]+)$", 1)).alias("id"),
        F.transform(
            lines, lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("text"))
        ).alias("lines"),
    )


def read_split_posts(spark: SparkSession, path: str, splits=("train", "test")) -> DataFrame:
    """The posts of <path>/<split>/<newsgroup>/<id>, with the split as a column."""
    frames = [read_posts(spark, f"{path}/{s}").withColumn("split", F.lit(s)) for s in splits]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """(id, line_no, text): the lines of every file of one folder."""
    files = spark.read.text(path, wholetext=True).withColumn("_path", F.input_file_name())
    lines = F.split("value", "\r?\n")
    size = F.size(lines)
    exploded = files.select(
        F.url_decode(F.regexp_extract("_path", "([^/]+)$", 1)).alias("id"),
        size.alias("_n"),
        F.posexplode(lines).alias("_p", "text"),
    )
    return exploded.where((F.col("_p") < F.col("_n") - 1) | (F.col("text") != "")).select(
        "id", (F.col("_p") + 1).alias("line_no"), "text"
    )


def read_clean_csv(spark: SparkSession, path: str, schema: str = CLEAN_SCHEMA) -> DataFrame:
    return spark.read.csv(
        path, schema=schema, header=True, multiLine=True, escape='"', quote='"'
    )


def write_clean_csv(posts: DataFrame, path: str) -> None:
    posts.write.csv(path, header=True, escape='"', quote='"', mode="overwrite")


def write_clean(posts: DataFrame, path: str) -> None:
    """Parquet keeps types and line breaks and can be split; CSV with line breaks cannot."""
    posts.write.parquet(path, mode="overwrite")
