"""Tokens and n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.words import ENGLISH_STOPWORDS, TOPIC_STOPWORDS
from corpusloom.operators import tokens as T
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import CLEAN_SQL, WORDS_SQL, clean_tokens, documents, q, table, words_in

_ALL = f"SELECT doc_id, unnest(regexp_extract_all(text, {q(X.WORD)})) AS tok FROM documents"
_ALL_POS = f"""SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) - 1 AS pos
 FROM (SELECT doc_id, regexp_extract_all(text, {q(X.WORD)}) AS a FROM documents)"""


def _docs(spark, sf):
    return documents(spark, sf, "doc_id", "text")


@query("tokens_word", f"SELECT doc_id, pos::INTEGER AS pos, tok FROM ({_ALL_POS})")
def tokens_word(spark, sf):
    toks = _docs(spark, sf).select("doc_id", X.tokens(F.col("text")).alias("toks"))
    return T.explode_tokens(toks)


@query("numbers_urls_removed", f"WITH {WORDS_SQL} SELECT doc_id, tok, count(*) AS n FROM word GROUP BY ALL")
def numbers_urls_removed(spark, sf):
    toks = T.tokenise(T.colocate(_docs(spark, sf)))
    return T.explode_tokens(toks).groupBy("doc_id", "tok").agg(F.count(F.lit(1)).alias("n"))


@query("tokens_clean", f"WITH {CLEAN_SQL} SELECT doc_id, tok, count(*) AS n FROM clean GROUP BY ALL")
def tokens_clean(spark, sf):
    return (
        T.explode_tokens(clean_tokens(spark, sf).select("doc_id", "toks"))
        .groupBy("doc_id", "tok")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "email_tokens_removed",
    f"SELECT tok, count(*) AS n FROM ({_ALL}) WHERE NOT regexp_matches(tok, {q(X.EMAIL)}) GROUP BY tok",
)
def email_tokens_removed(spark, sf):
    toks = _docs(spark, sf).select(X.without_emails(X.tokens(F.col("text"))).alias("toks"))
    return T.explode_tokens(toks).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ngrams_bigram",
    f"""WITH {WORDS_SQL.replace("unnest(a) AS tok FROM cut", "unnest(a) AS tok, generate_subscripts(a, 1) AS p FROM cut").replace("SELECT doc_id, lang, source, tok FROM (", "SELECT doc_id, lang, source, tok, p FROM (")},
    kept AS (SELECT doc_id, lower(tok) AS tok, p FROM word
             WHERE length(tok) >= 3 AND NOT regexp_matches(tok, {q(X.EMAIL)})
               AND lower(tok) NOT IN ({words_in(ENGLISH_STOPWORDS)})),
    grams AS (SELECT doc_id, tok || '_' || lead(tok) OVER (PARTITION BY doc_id ORDER BY p) AS gram FROM kept)
    SELECT gram, count(*) AS n, count(DISTINCT doc_id) AS doc_freq FROM
    (SELECT doc_id, tok AS gram FROM kept UNION ALL SELECT doc_id, gram FROM grams WHERE gram IS NOT NULL)
    GROUP BY gram""",
)
def ngrams_bigram(spark, sf):
    """Unigrams and bigrams with corpus and document frequency."""
    grams = clean_tokens(spark, sf, bigrams=True).select("doc_id", "toks")
    per_doc = (
        T.explode_tokens(grams, out="gram").groupBy("doc_id", "gram").agg(F.count(F.lit(1)).alias("c"))
    )
    return per_doc.groupBy("gram").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("doc_freq")
    )


@query(
    "possessive_strip",
    f"""SELECT doc_id, regexp_replace(tok, {q(X.POSSESSIVE)}, '\\1') AS tok, count(*) AS n
    FROM ({_ALL}) GROUP BY ALL""",
)
def possessive_strip(spark, sf):
    toks = T.colocate(_docs(spark, sf)).select(
        "doc_id", X.without_possessive(X.tokens(F.col("text"))).alias("toks")
    )
    return T.explode_tokens(toks).groupBy("doc_id", "tok").agg(F.count(F.lit(1)).alias("n"))


@query(
    "token_replace",
    f"""WITH t AS (SELECT doc_id, lower(tok) AS tok FROM ({_ALL})),
    m AS (SELECT DISTINCT tok, left(tok, length(tok) - 2) AS replacement FROM t WHERE length(tok) > 4 AND tok LIKE '%ed')
    SELECT coalesce(m.replacement, t.tok) AS tok, count(*) AS n FROM t LEFT JOIN m ON t.tok = m.tok GROUP BY 1""",
)
def token_replace(spark, sf):
    """Replacement table made from the vocabulary itself, applied to counted tokens."""
    toks = _docs(spark, sf).select(X.lowered(X.tokens(F.col("text"))).alias("toks"))
    counts = T.explode_tokens(toks).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    mapping = counts.where((F.char_length("tok") > 4) & F.col("tok").endswith("ed")).select(
        "tok", F.expr("left(tok, char_length(tok) - 2)").alias("replacement")
    )
    return (
        T.replace_from_table(counts, mapping).groupBy("tok").agg(F.sum("n").alias("n"))
    )


@query(
    "twitter_marks_stripped",
    """SELECT tok, count(*) AS n FROM (SELECT regexp_replace(tok, '^[#@]+', '') AS tok FROM
    (SELECT unnest(regexp_extract_all(text, '[#@]*[\\p{L}\\p{N}_]+')) AS tok FROM conversations)) GROUP BY tok""",
)
def twitter_marks_stripped(spark, sf):
    toks = table(spark, sf, "conversations").select(
        X.without_tag_marks(X.tokens(F.col("text"), r"[#@]*[\p{L}\p{N}_]+")).alias("toks")
    )
    return T.explode_tokens(toks).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))


def _preset_sql(body: str) -> str:
    return f"""WITH {WORDS_SQL}, t AS ({body})
    SELECT doc_id, count(tok) AS n_tokens, count(DISTINCT tok) AS n_types
    FROM documents LEFT JOIN t USING (doc_id) GROUP BY doc_id"""


def _per_doc(toks):
    """Counts per post inside its own row."""
    return toks.select(
        "doc_id",
        F.size("toks").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("toks")).cast("bigint").alias("n_types"),
    )


_STOP = f"lower(tok) NOT IN ({words_in(ENGLISH_STOPWORDS)})"


@query(
    "preset_topics",
    _preset_sql(f"SELECT doc_id, lower(tok) AS tok FROM word WHERE {_STOP} AND length(lower(tok)) >= 2"),
)
def preset_topics(spark, sf):
    return _per_doc(T.topic_tokens(_docs(spark, sf)))


@query(
    "preset_embed",
    _preset_sql(
        f"""SELECT doc_id, regexp_replace(lower(tok), {q(X.POSSESSIVE)}, '\\1') AS tok
        FROM word WHERE {_STOP} AND length(lower(tok)) >= 3"""
    ),
)
def preset_embed(spark, sf):
    return _per_doc(T.embed_tokens(_docs(spark, sf)))


@query(
    "preset_cluster",
    f"""WITH cut AS (SELECT doc_id, regexp_extract_all(regexp_replace(text, {q(X.URL)}, ' ', 'g'), {q(X.WORD)}) AS a FROM documents),
    w AS (SELECT doc_id, tok, p FROM (SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) AS p FROM cut)
          WHERE NOT regexp_matches(tok, {q(X.NUMBER)})),
    g AS (SELECT doc_id, tok FROM w UNION ALL
          SELECT doc_id, tok || '_' || nxt FROM (SELECT doc_id, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM w)
          WHERE nxt IS NOT NULL),
    t AS (SELECT doc_id, lower(tok) AS tok FROM g WHERE {_STOP} AND length(lower(tok)) >= 3)
    SELECT doc_id, count(tok) AS n_tokens, count(DISTINCT tok) AS n_types
    FROM documents LEFT JOIN t USING (doc_id) GROUP BY doc_id""",
)
def preset_cluster(spark, sf):
    return _per_doc(T.cluster_tokens(_docs(spark, sf)))


@query(
    "custom_stopwords",
    f"""WITH {CLEAN_SQL} SELECT tok AS term, count(*) AS total FROM clean
    WHERE tok NOT IN ({words_in(TOPIC_STOPWORDS)}) GROUP BY tok""",
)
def custom_stopwords(spark, sf):
    toks = clean_tokens(spark, sf).select(
        X.without_words(F.col("toks"), TOPIC_STOPWORDS).alias("toks")
    )
    return (
        T.explode_tokens(toks, out="term").groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    )
