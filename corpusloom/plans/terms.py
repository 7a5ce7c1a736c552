"""Document-term tables, weights and feature selection."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from corpusloom.operators import dtm as D, tokens as T
from corpusloom.operators.split import random_split
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import DTM_SQL, clean_tokens, documents, dtm, n_docs

_COUNTS = "count(*)"


@query("dtm_counts", f"WITH {DTM_SQL} SELECT doc_id, term, tf FROM dtm")
def dtm_counts(spark, sf):
    return dtm(spark, sf).select("doc_id", "term", "tf")


@query("term_totals", f"WITH {DTM_SQL} SELECT term, total FROM terms")
def term_totals(spark, sf):
    """Straight from the tokens: partial counts before the only exchange."""
    toks = documents_tokens(spark, sf)
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("total"))


def documents_tokens(spark, sf):
    toks = T.classify_tokens(documents(spark, sf, "doc_id", "text")).select("toks")
    return T.explode_tokens(toks, out="term")


@query("doc_freq", f"WITH {DTM_SQL} SELECT term, doc_freq FROM terms")
def doc_freq(spark, sf):
    """Distinct terms inside each row, then counted."""
    return D.document_frequencies(T.classify_tokens(documents(spark, sf, "doc_id", "text")))


@query(
    "dtm_sparsity",
    f"""WITH {DTM_SQL} SELECT n.n AS n_docs, (SELECT count(*) FROM terms) AS n_terms, (SELECT count(*) FROM dtm) AS nnz,
    round(1 - (SELECT count(*) FROM dtm) / (n.n * (SELECT count(*) FROM terms)), 9) AS sparsity FROM n""",
)
def dtm_sparsity(spark, sf):
    return D.shape(dtm(spark, sf), n_docs(spark, sf)).withColumn(
        "sparsity", F.round("sparsity", 9)
    )


@query(
    "dtm_row_totals",
    f"""WITH {DTM_SQL} SELECT doc_id, sum(tf)::BIGINT AS n_tokens, (SELECT sum(tf)::BIGINT FROM dtm) AS grand_total
    FROM dtm GROUP BY doc_id""",
)
def dtm_row_totals(spark, sf):
    """Row sums and the grand total; the length of a post is known inside its row."""
    rows = clean_tokens(spark, sf).select("doc_id", F.size("toks").cast("bigint").alias("n_tokens"))
    grand = rows.agg(F.sum("n_tokens")).scalar()
    return rows.where(F.col("n_tokens") > 0).withColumn("grand_total", grand)


@query("dtm_trim_termfreq", f"WITH {DTM_SQL} SELECT term, total FROM terms WHERE total >= 2")
def trim_termfreq(spark, sf):
    toks = documents_tokens(spark, sf)
    totals = toks.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    return totals.where(F.col("total") >= 2)


@query("dtm_trim_docfreq", f"WITH {DTM_SQL} SELECT term, doc_freq FROM terms WHERE doc_freq >= 2")
def trim_docfreq(spark, sf):
    return doc_freq(spark, sf).where(F.col("doc_freq") >= 2)


@query(
    "tf_prop",
    f"WITH {DTM_SQL} SELECT doc_id, term, tf / doc_len AS tf_prop FROM sized",
)
def tf_prop(spark, sf):
    return dtm(spark, sf).select("doc_id", "term", D.tf_prop().alias("tf_prop"))


@query(
    "idf_log10",
    f"WITH {DTM_SQL} SELECT term, round(log10(n.n / doc_freq), 9) AS idf FROM terms, n",
)
def idf_log10(spark, sf):
    freq = doc_freq(spark, sf)
    return freq.select(
        "term", F.round(D.idf(F.col("doc_freq"), n_docs(spark, sf)), 9).alias("idf")
    )


@query(
    "tfidf",
    f"""WITH {DTM_SQL} SELECT doc_id, term, round(tf / doc_len * log10(n.n / doc_freq), 9) AS w
    FROM sized JOIN terms USING (term), n""",
)
def tfidf(spark, sf):
    """Document frequencies in a first pass that shuffles terms only, weights in a second."""
    freq = doc_freq(spark, sf)
    return D.tfidf(dtm(spark, sf), n_docs(spark, sf), freq).select(
        "doc_id", "term", F.round("w", 9).alias("w")
    )


@query("tfidf_totals", f"WITH {DTM_SQL} SELECT term, round(weight, 6) AS weight FROM weights")
def tfidf_totals(spark, sf):
    return D.tfidf_totals(dtm(spark, sf), n_docs(spark, sf)).select(
        "term", F.round("weight", 6).alias("weight")
    )


def _rounded_weights(spark, sf):
    return D.tfidf_totals(dtm(spark, sf), n_docs(spark, sf)).withColumn(
        "weight", F.round("weight", 6)
    )


_ROUNDED = """rw AS MATERIALIZED (SELECT term, round(weight, 6) AS weight FROM weights),
cutoff AS MATERIALIZED (SELECT round(quantile_cont(weight, 0.75), 9) AS q FROM rw)"""


@query(
    "tfidf_keep_above",
    f"WITH {DTM_SQL}, {_ROUNDED} SELECT term, weight FROM rw, cutoff WHERE weight > q",
)
def tfidf_keep_above(spark, sf):
    return D.terms_above(_rounded_weights(spark, sf), "weight", 0.75).select("term", "weight")


@query(
    "tfidf_drop_up_to",
    f"""WITH {DTM_SQL}, {_ROUNDED.replace("0.75", "0.975")} SELECT term, weight FROM rw, cutoff WHERE weight > q""",
)
def tfidf_drop_up_to(spark, sf):
    return D.terms_above(_rounded_weights(spark, sf), "weight", 0.975).select("term", "weight")


@query(
    "tfidf_drop_below_keep_counts",
    f"""WITH {DTM_SQL}, {_ROUNDED}, kept AS MATERIALIZED (SELECT term FROM rw WHERE weight >= (SELECT q FROM cutoff))
    SELECT doc_id, term, tf FROM dtm JOIN kept USING (term)""",
)
def tfidf_drop_below_keep_counts(spark, sf):
    """Chosen by weight, kept as counts; terms at the threshold stay."""
    counts = dtm(spark, sf)
    vocabulary = D.terms_from(_rounded_weights(spark, sf), "weight", 0.75)
    return D.keep_terms(counts, vocabulary).select("doc_id", "term", "tf")


@query(
    "terms_above_median",
    f"""WITH {DTM_SQL} SELECT term, total FROM terms WHERE total > (SELECT quantile_cont(total, 0.5) FROM terms)""",
)
def terms_above_median(spark, sf):
    return D.terms_above(term_totals(spark, sf), "total", 0.5)


@query(
    "top_terms_per_group",
    f"""WITH {DTM_SQL}, g AS (SELECT source, term, round(sum(tf / doc_len) * log10(any_value(n.n) / any_value(doc_freq)), 6) AS weight
      FROM sized JOIN terms USING (term), n GROUP BY source, term)
    SELECT source, term, weight FROM g QUALIFY rank() OVER (PARTITION BY source ORDER BY weight DESC) <= 10""",
)
def top_terms_per_group(spark, sf):
    """Ten heaviest terms of every source, ties kept.

    Summed per (source, term) before the IDF is joined, and cut to ten per task before
    the exchange on the source.
    """
    counts = dtm(spark, sf, keep=["source"])
    sums = counts.groupBy("source", "term").agg(
        F.sum(D.tf_prop()).alias("s"), F.count(F.lit(1)).alias("n")
    )
    idfs = D.idf_table(
        sums.groupBy("term").agg(F.sum("n").alias("doc_freq")), n_docs(spark, sf)
    )
    weighted = sums.join(idfs, "term").select(
        "source", "term", F.round(F.col("s") * F.col("idf"), 6).alias("weight")
    )
    w = Window.partitionBy("source").orderBy(F.desc("weight"))
    return weighted.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= 10).drop("_r")


# --- training and new documents ------------------------------------------------

_SPLIT = """split AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id))
  <= round_even(count(*) OVER () * 0.75, 0) THEN 'train' ELSE 'test' END AS split FROM documents)"""


def _splits(spark, sf):
    docs = random_split(documents(spark, sf, "doc_id", "lang", "source", "text"), "doc_id")
    counts = D.document_terms(T.classify_tokens(T.colocate(docs)), keep=["split"])
    train = counts.where(F.col("split") == "train")
    test = counts.where(F.col("split") == "test")
    return docs, train, test


_SPLIT_DTM = f"""{DTM_SQL}, {_SPLIT},
s AS (SELECT d.*, split FROM sized d JOIN split USING (doc_id)),
train_terms AS (SELECT term, count(*) AS doc_freq FROM s WHERE split = 'train' GROUP BY term)"""


@query(
    "vocab_align",
    f"""WITH {_SPLIT_DTM} SELECT doc_id, term, tf FROM s WHERE split = 'test' AND term IN (SELECT term FROM train_terms)""",
)
def vocab_align(spark, sf):
    """Test documents restricted to the training vocabulary."""
    _, train, test = _splits(spark, sf)
    return D.keep_terms(test, train.select("term").distinct()).select("doc_id", "term", "tf")


@query(
    "vocab_diff",
    f"""WITH {_SPLIT_DTM}, test_terms AS (SELECT DISTINCT term FROM s WHERE split = 'test')
    SELECT term, 'train' AS only_in FROM (SELECT term FROM train_terms EXCEPT SELECT term FROM test_terms)
    UNION ALL SELECT term, 'test' FROM (SELECT term FROM test_terms EXCEPT SELECT term FROM train_terms)""",
)
def vocab_diff(spark, sf):
    """Both differences of the vocabularies from one aggregation."""
    _, train, test = _splits(spark, sf)
    sides = train.unionByName(test).groupBy("term").agg(
        F.min("split").alias("lo"), F.max("split").alias("hi")
    )
    return sides.where(F.col("lo") == F.col("hi")).select("term", F.col("lo").alias("only_in"))


@query(
    "vocab_common",
    f"""WITH {_SPLIT_DTM} SELECT term FROM train_terms INTERSECT SELECT term FROM s WHERE split = 'test'""",
)
def vocab_common(spark, sf):
    _, train, test = _splits(spark, sf)
    return train.select("term").intersect(test.select("term"))


@query(
    "tfidf_project_test",
    f"""WITH {_SPLIT_DTM},
    n_train AS (SELECT count(*) AS n FROM split WHERE split = 'train'),
    a AS (SELECT doc_id, term, tf, doc_freq, sum(tf) OVER (PARTITION BY doc_id) AS kept
          FROM s JOIN train_terms USING (term) WHERE split = 'test')
    SELECT doc_id, term, round(tf / kept * log10(n_train.n / doc_freq), 9) AS w FROM a, n_train""",
)
def tfidf_project_test(spark, sf):
    docs, train, test = _splits(spark, sf)
    n_train = D.row_count(docs.where(F.col("split") == "train"))
    return D.project(test, D.term_stats(train), n_train).select(
        "doc_id", "term", F.round("w", 9).alias("w")
    )


@query(
    "empty_docs",
    f"""WITH {_SPLIT_DTM}, sel AS (SELECT term FROM train_terms WHERE doc_freq >= 2)
    SELECT doc_id FROM split WHERE split = 'test' AND doc_id NOT IN
    (SELECT doc_id FROM s WHERE split = 'test' AND term IN (SELECT term FROM sel))""",
)
def empty_docs(spark, sf):
    """Test documents without any selected training term."""
    docs, train, test = _splits(spark, sf)
    vocabulary = D.term_stats(train).where(F.col("doc_freq") >= 2)
    kept = D.keep_terms(test, vocabulary)
    return D.lost_documents(docs.where(F.col("split") == "test"), kept)


@query(
    "log_entropy",
    f"""WITH {DTM_SQL},
    e AS MATERIALIZED (SELECT term, ln(sum(tf)) - sum(tf * ln(tf)) / sum(tf) AS entropy, count(*) AS doc_freq FROM dtm GROUP BY term)
    SELECT doc_id, term, CASE WHEN doc_freq > 1 THEN round(ln(tf + 1) / entropy, 6) END AS w FROM dtm JOIN e USING (term)""",
)
def log_entropy(spark, sf):
    return D.log_entropy(dtm(spark, sf)).select("doc_id", "term", F.round("w", 6).alias("w"))
