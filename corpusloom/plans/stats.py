"""Corpus statistics, quantiles, outliers, tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import stats as S
from corpusloom.operators.order_stats import quantiles
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import DTM_SQL, documents, q, table
from corpusloom.plans.terms import term_totals

CORPUS_SQL = f"""
toks AS (SELECT doc_id, lang, source, regexp_extract_all(text, {q(X.WORD_OR_MARK)}) AS a,
         len(regexp_extract_all(text, {q(X.SENTENCE)})) AS sentences FROM documents),
corpus AS (SELECT doc_id, lang, source, len(list_distinct(a)) AS types, len(a) AS tokens, sentences,
           len(list_distinct(a)) / nullif(len(a), 0) AS ttr FROM toks)
"""


def corpus(spark, sf):
    return S.corpus_stats(documents(spark, sf))


@query(
    "corpus_stats",
    f"WITH {CORPUS_SQL} SELECT doc_id, lang, source, types, tokens, sentences, ttr FROM corpus",
)
def corpus_stats(spark, sf):
    return corpus(spark, sf)


@query(
    "corpus_group_stats",
    f"""WITH {CORPUS_SQL} SELECT source, count(*) AS cnt, sum(tokens)::BIGINT AS total, round(avg(tokens), 2) AS mean,
    quantile_cont(tokens, 0.5) AS median, min(tokens) AS min, max(tokens) AS max FROM corpus GROUP BY source""",
)
def corpus_group_stats(spark, sf):
    return S.group_stats(corpus(spark, sf), "source", "tokens").withColumn(
        "mean", F.round("mean", 2)
    )


@query(
    "long_posts_dropped",
    f"WITH {CORPUS_SQL} SELECT doc_id, tokens FROM corpus WHERE tokens <= 1100",
)
def long_posts_dropped(spark, sf):
    return corpus(spark, sf).where(F.col("tokens") <= 1100).select("doc_id", "tokens")


@query(
    "group_post_counts",
    "SELECT source, count(DISTINCT doc_id) AS n_posts FROM documents GROUP BY source ORDER BY n_posts, source",
)
def group_post_counts(spark, sf):
    return S.posts_per_group(table(spark, sf, "documents"), "source", "doc_id").orderBy(
        "n_posts", "source"
    )


_HINGES = """
ord AS (SELECT tokens AS x, row_number() OVER (ORDER BY tokens, doc_id) AS r, count(*) OVER () AS n FROM corpus),
d AS (SELECT *, floor((n + 3) / 2) / 2 AS n4 FROM ord),
h AS (SELECT (max(CASE WHEN r = floor(n4) THEN x END) + max(CASE WHEN r = ceil(n4) THEN x END)) / 2 AS lo,
             (max(CASE WHEN r = floor(n + 1 - n4) THEN x END) + max(CASE WHEN r = ceil(n + 1 - n4) THEN x END)) / 2 AS hi FROM d),
outl AS (SELECT doc_id, tokens FROM corpus, h WHERE tokens < lo - 1.5 * (hi - lo) OR tokens > hi + 1.5 * (hi - lo))"""


@query("tukey_outliers", f"WITH {CORPUS_SQL}, {_HINGES} SELECT doc_id, tokens FROM outl")
def tukey_outliers(spark, sf):
    return S.tukey_outliers(corpus(spark, sf), "tokens").select("doc_id", "tokens")


@query(
    "outlier_value_semi",
    f"""WITH {CORPUS_SQL}, {_HINGES} SELECT doc_id, tokens FROM corpus WHERE tokens IN
    (SELECT tokens FROM outl ORDER BY tokens DESC LIMIT 7)""",
)
def outlier_value_semi(spark, sf):
    return S.top_outlier_rows(corpus(spark, sf), "tokens", 7).select("doc_id", "tokens")


@query(
    "boxplot_numbers",
    f"""WITH {CORPUS_SQL},
    ord AS (SELECT lang, ttr AS x, row_number() OVER (PARTITION BY lang ORDER BY ttr, doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n
            FROM corpus WHERE ttr IS NOT NULL),
    d AS (SELECT *, floor((n + 3) / 2) / 2 AS n4 FROM ord),
    h AS (SELECT lang, any_value(n) AS n, quantile_cont(x, 0.5) AS median,
      (max(CASE WHEN r = floor(n4) THEN x END) + max(CASE WHEN r = ceil(n4) THEN x END)) / 2 AS lo,
      (max(CASE WHEN r = floor(n + 1 - n4) THEN x END) + max(CASE WHEN r = ceil(n + 1 - n4) THEN x END)) / 2 AS hi FROM d GROUP BY lang),
    f AS (SELECT *, lo - 1.5 * (hi - lo) AS lf, hi + 1.5 * (hi - lo) AS uf FROM h)
    SELECT f.lang, any_value(f.n) AS n, round(any_value(lo), 9) AS lower_hinge, round(any_value(median), 9) AS median, round(any_value(hi), 9) AS upper_hinge,
      round(any_value(lf), 9) AS lower_fence, round(any_value(uf), 9) AS upper_fence,
      min(CASE WHEN x BETWEEN lf AND uf THEN x END) AS lower_whisker, max(CASE WHEN x BETWEEN lf AND uf THEN x END) AS upper_whisker,
      sum(CASE WHEN x BETWEEN lf AND uf THEN 0 ELSE 1 END)::BIGINT AS n_outliers
    FROM f JOIN ord ON ord.lang = f.lang GROUP BY f.lang""",
)
def boxplot_numbers(spark, sf):
    out = S.boxplot_numbers(corpus(spark, sf), "ttr", ["lang"])
    rounded = ["lower_hinge", "median", "upper_hinge", "lower_fence", "upper_fence"]
    return out.select(
        "lang", "n", *[F.round(c, 9).alias(c) for c in rounded],
        "lower_whisker", "upper_whisker", "n_outliers",
    )


@query(
    "kruskal_h",
    f"""WITH {CORPUS_SQL}, c AS (SELECT * FROM corpus WHERE ttr IS NOT NULL),
    v AS (SELECT ttr, count(*) AS t FROM c GROUP BY ttr),
    r AS (SELECT ttr, t, sum(t) OVER (ORDER BY ttr) - (t - 1) / 2 AS rk FROM v),
    g AS (SELECT source, count(*) AS m, sum(rk) AS rs FROM c JOIN r USING (ttr) GROUP BY source),
    n AS (SELECT count(*)::DOUBLE AS n FROM c)
    SELECT max(n.n)::BIGINT AS n, count(*) - 1 AS df,
     round((12 / (max(n.n) * (max(n.n) + 1)) * sum(rs * rs / m) - 3 * (max(n.n) + 1))
      / (1 - (SELECT sum(t::DOUBLE ** 3 - t) FROM v) / (max(n.n) ** 3 - max(n.n))), 6) AS h FROM g, n""",
)
def kruskal_h(spark, sf):
    return S.kruskal_wallis(corpus(spark, sf), "ttr", "source").select(
        "n", "df", F.round("h", 6).alias("h")
    )


@query(
    "class_balance",
    "SELECT quality, count(*) AS n, count(*) / (SELECT count(*) FROM labels) AS share FROM labels GROUP BY quality",
)
def class_balance(spark, sf):
    return S.class_shares(table(spark, sf, "labels"), "quality")


@query(
    "term_summary6",
    f"""WITH {DTM_SQL} SELECT count(*) AS n, min(total)::DOUBLE AS min, quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.5) AS median,
    round(avg(total), 6) AS mean, quantile_cont(total, 0.75) AS q3, max(total)::DOUBLE AS max FROM terms""",
)
def term_summary6(spark, sf):
    return S.six_numbers(term_totals(spark, sf), "total").withColumn("mean", F.round("mean", 6))


_PROBS = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p975": 0.975, "p99": 0.99}


@query(
    "term_quantiles",
    f"""WITH {DTM_SQL} SELECT count(*) AS n, {", ".join(f"round(quantile_cont(total, {p}), 9) AS {k}" for k, p in _PROBS.items())} FROM terms""",
)
def term_quantiles(spark, sf):
    out = quantiles(term_totals(spark, sf), "total", _PROBS)
    return out.select("n", *[F.round(k, 9).alias(k) for k in _PROBS])
