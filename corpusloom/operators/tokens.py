"""Token tables: posts with an array of tokens, `toks`, and the pipeline presets.

The presets differ in the order of the steps, and the order changes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import text as X
from corpusloom.functions.words import ENGLISH_STOPWORDS


TEXT_BYTES = 8_000_000  # text of a task; its counted tokens take some 30 times as much memory
LEAST_BYTES = 1_000_000  # less is not worth a task


def colocate(posts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place posts by key once, while they are still compact text.

    Everything counted per post afterwards (terms, n-grams, lengths) then needs no
    further exchange, instead of shuffling the much larger exploded tokens. The number of
    tasks follows from the text, so that what each of them counts is of bounded size.
    """
    size = posts.agg(F.sum(F.octet_length(text)).alias("n")).head()["n"] or 0
    cores = posts.sparkSession.sparkContext.defaultParallelism
    return posts.repartition(max(1, -(-size // TEXT_BYTES), min(cores, -(-size // LEAST_BYTES))), key)


def _step(df: DataFrame, expr: Column, col: str = "toks") -> DataFrame:
    return df.withColumn(col, expr)


def tokenise(posts: DataFrame, text: str = "text") -> DataFrame:
    """Words without numbers, punctuation, symbols and URLs, in text order."""
    df = posts.withColumn("toks", X.tokens(X.without_urls(F.col(text)))).drop(text)
    return _step(df, X.without_numbers(F.col("toks")))


def add_bigrams(df: DataFrame) -> DataFrame:
    return _step(df, F.concat(F.col("toks"), X.ngrams(F.col("toks"), 2)))


def classify_tokens(posts: DataFrame, text: str = "text", bigrams: bool = False) -> DataFrame:
    """Length, e-mail, case, stopwords; n-grams come last."""
    t = F.col("toks")
    df = tokenise(posts, text)
    df = _step(df, X.without_emails(X.at_least(t, 3)))
    df = _step(df, X.without_words(X.lowered(t), ENGLISH_STOPWORDS))
    return add_bigrams(df) if bigrams else df


def cluster_tokens(posts: DataFrame, text: str = "text") -> DataFrame:
    """N-grams come first, so bigrams may hold stopwords and count as one token."""
    t = F.col("toks")
    df = _step(add_bigrams(tokenise(posts, text)), X.lowered(t))
    return _step(df, X.at_least(X.without_words(t, ENGLISH_STOPWORDS), 3))


def embed_tokens(posts: DataFrame, text: str = "text") -> DataFrame:
    """Unstemmed, possessive cut off after the length rule."""
    t = F.col("toks")
    df = _step(tokenise(posts, text), X.lowered(X.without_tag_marks(t)))
    df = _step(df, X.at_least(X.without_words(t, ENGLISH_STOPWORDS), 3))
    return _step(df, X.without_possessive(t))


def topic_tokens(posts: DataFrame, text: str = "text") -> DataFrame:
    t = F.col("toks")
    df = _step(tokenise(posts, text), X.lowered(t))
    return _step(df, X.at_least(X.without_words(t, ENGLISH_STOPWORDS), 2))


def explode_tokens(df: DataFrame, col: str = "toks", out: str = "tok") -> DataFrame:
    """One row per token with its 0-based position."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode_outer(col).alias("pos", out)).where(
        F.col(out).isNotNull()
    )


def replace_from_table(
    toks: DataFrame, mapping: DataFrame, tok: str = "tok", new: str = "replacement"
) -> DataFrame:
    """Replace tokens that the mapping (tok, replacement) knows."""
    return (
        toks.join(mapping, tok, "left")
        .withColumn(tok, F.coalesce(F.col(new), F.col(tok)))
        .drop(new)
    )
