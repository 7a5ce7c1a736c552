"""Document-term table as long triples: counts, weights, feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.operators.joins import SHORT_ROWS, salted_lookup
from corpusloom.operators.order_stats import quantiles


def document_terms(
    docs: DataFrame, key: str = "doc_id", keep: Sequence[str] = (), toks: str = "toks"
) -> DataFrame:
    """(key, *keep, doc_len, term, tf). Without an exchange if docs are placed by key."""
    keys = [key, *keep]
    long = docs.select(
        *keys, F.size(toks).cast("bigint").alias("doc_len"), F.explode_outer(toks).alias("term")
    ).where(F.col("term").isNotNull())
    return long.groupBy(*keys, "doc_len", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(dtm: DataFrame) -> DataFrame:
    """(term, total, doc_freq)."""
    return dtm.groupBy("term").agg(
        F.sum("tf").alias("total"), F.count(F.lit(1)).alias("doc_freq")
    )


def document_frequencies(docs: DataFrame, toks: str = "toks") -> DataFrame:
    """(term, doc_freq) straight from the token arrays.

    Nothing per (document, term) is shuffled: each task sends one partial count per term.
    """
    once = docs.select(F.explode_outer(F.array_distinct(toks)).alias("term"))
    return once.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq")
    )


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def idf(doc_freq: Column, n_docs: Column) -> Column:
    return F.log10(n_docs / doc_freq)


def tf_prop(denominator: str = "full") -> Column:
    """tf over the length of the document, or over what is left of it ('kept').

    'kept' assumes rows are placed by document, so its window adds no exchange.
    """
    if denominator == "full":
        return F.col("tf") / F.col("doc_len")
    return F.col("tf") / F.sum("tf").over(Window.partitionBy("doc_id"))


def idf_table(stats: DataFrame, n_docs: Column) -> DataFrame:
    return stats.select("term", "doc_freq", idf(F.col("doc_freq"), n_docs).alias("idf"))


def tfidf(dtm: DataFrame, n_docs: Column, stats: DataFrame | None = None) -> DataFrame:
    """Add tf_prop, idf and w to every triple; frequent terms are salted in the join."""
    idfs = idf_table(stats if stats is not None else term_stats(dtm), n_docs)
    return (
        salted_lookup(dtm, idfs, "term", "doc_freq", F.col("doc_id"))
        .withColumn("tf_prop", tf_prop())
        .withColumn("w", F.col("tf_prop") * F.col("idf"))
    )


def tfidf_totals(dtm: DataFrame, n_docs: Column) -> DataFrame:
    """(term, total, doc_freq, weight) with weight = sum of TF-IDF over documents.

    The IDF is constant per term, so it multiplies the sum: no join of triples.
    """
    return dtm.groupBy("term").agg(
        F.sum("tf").alias("total"),
        F.count(F.lit(1)).alias("doc_freq"),
        (F.sum(tf_prop()) * idf(F.count(F.lit(1)), n_docs)).alias("weight"),
    )


def threshold(df: DataFrame, value: str, p: float) -> Column:
    return quantiles(df, value, {"q": p}).select("q").scalar()


def terms_above(stats: DataFrame, value: str, p: float) -> DataFrame:
    """Terms strictly above the p-quantile (same as removing those at or below it)."""
    return stats.where(F.col(value) > threshold(stats, value, p))


def terms_from(stats: DataFrame, value: str, p: float) -> DataFrame:
    """Terms at or above the p-quantile (same as removing those below it)."""
    return stats.where(F.col(value) >= threshold(stats, value, p))


def keep_terms(dtm: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Align triples to a vocabulary; absent terms stay implicit zeros."""
    return dtm.join(vocabulary.select("term"), "term", "left_semi")


def drop_terms(dtm: DataFrame, words: DataFrame) -> DataFrame:
    return dtm.join(words.select("term"), "term", "left_anti")


def lost_documents(docs: DataFrame, dtm: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that kept no feature."""
    return docs.select(key).join(dtm.select(key), key, "left_anti")


def shape(dtm: DataFrame, n_docs: Column) -> DataFrame:
    """Number of documents, terms and cells, and the share of empty cells."""
    per_term = dtm.groupBy("term").agg(F.count(F.lit(1)).alias("cells"))
    return per_term.agg(
        F.sum("cells").alias("nnz"), F.count(F.lit(1)).alias("n_terms")
    ).select(
        n_docs.alias("n_docs"),
        "n_terms",
        "nnz",
        (1 - F.col("nnz") / (n_docs * F.col("n_terms"))).alias("sparsity"),
    )


def project(
    new_dtm: DataFrame, train_stats: DataFrame, n_train: Column, denominator: str = "kept"
) -> DataFrame:
    """New documents in the training TF-IDF space: align, renormalise, weigh by training IDF.

    `train_stats` has the selected training terms with their training `doc_freq`.
    """
    idfs = idf_table(train_stats, n_train)
    aligned = salted_lookup(new_dtm, idfs, "term", "doc_freq", F.col("doc_id"), most=SHORT_ROWS)
    return aligned.withColumn("w", tf_prop(denominator) * F.col("idf"))


def log_entropy(dtm: DataFrame) -> DataFrame:
    """Local weight ln(tf + 1) over the entropy of the term's distribution on documents.

    The entropy per term is ln(T) - sum(tf ln tf) / T, from sums that combine map-side.
    A term of a single document has entropy 0 and no weight (null).
    """
    per_term = dtm.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"),
        F.sum("tf").alias("total"),
        F.sum(F.col("tf") * F.ln("tf")).alias("_s"),
    ).select(
        "term",
        "doc_freq",
        F.when(
            F.col("doc_freq") > 1, F.ln("total") - F.col("_s") / F.col("total")
        ).alias("entropy"),
    )
    joined = salted_lookup(dtm, per_term, "term", "doc_freq", F.col("doc_id"))
    return joined.withColumn("w", F.ln(F.col("tf") + 1) / F.col("entropy"))
