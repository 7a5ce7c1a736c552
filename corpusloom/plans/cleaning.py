"""Cleaning of raw posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import clean
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import RAW_SQL, raw_posts


@query("usenet_header_signature", f"WITH {RAW_SQL} SELECT grp, id, line_no, text FROM body")
def header_signature(spark, sf):
    return clean.to_lines(raw_posts(spark, sf).withColumn("lines", clean.body_of(F.col("lines"))))


@query(
    "usenet_running_flags",
    f"WITH {RAW_SQL} SELECT grp, id, line_no, text FROM body",
)
def running_flags(spark, sf):
    """The same from a table with one row per line."""
    return clean.strip_header_and_signature(clean.to_lines(raw_posts(spark, sf)), ("grp", "id"))


@query("usenet_quotes", f"WITH {RAW_SQL} SELECT grp, id, line_no, text FROM content")
def quotes(spark, sf):
    posts = raw_posts(spark, sf).withColumn("lines", clean.body_of(F.col("lines")))
    return clean.to_lines(posts.withColumn("lines", clean.unquoted(F.col("lines"))))


@query(
    "usenet_merge",
    f"""WITH {RAW_SQL} SELECT grp, id, string_agg(text, ' ' ORDER BY line_no) AS post_txt
    FROM content GROUP BY grp, id""",
)
def merge(spark, sf):
    return clean.clean_posts(raw_posts(spark, sf))


@query(
    "usenet_line_counts",
    f"""WITH {RAW_SQL} SELECT r.grp, r.n_raw, b.n_body, c.n_content FROM
    (SELECT grp, count(*) AS n_raw FROM raw_lines GROUP BY grp) r
    JOIN (SELECT grp, count(*) AS n_body FROM body GROUP BY grp) b USING (grp)
    JOIN (SELECT grp, count(*) AS n_content FROM content GROUP BY grp) c USING (grp)""",
)
def line_counts(spark, sf):
    """Lines per group before and after the two cleaning steps, in one pass."""
    body = clean.body_of(F.col("lines"))
    return (
        raw_posts(spark, sf)
        .select("grp", "lines", body.alias("body"))
        .groupBy("grp")
        .agg(
            F.sum(F.size("lines")).alias("n_raw"),
            F.sum(F.size("body")).alias("n_body"),
            F.sum(F.size(clean.unquoted(F.col("body")))).alias("n_content"),
        )
    )
