"""Input tables and the shared pieces of the SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions import text as X
from corpusloom.functions.words import ENGLISH_STOPWORDS
from corpusloom.operators import clean, dtm as D, tokens as T
from corpusloom.sources.tables import read_table, spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    cols = cols or ("doc_id", "lang", "source", "text")
    rows = table(spark, sf, "documents").select(*cols)
    return spread(rows) if "text" in cols else rows


def n_docs(spark: SparkSession, sf: str):
    return D.row_count(table(spark, sf, "documents"))


def q(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def words_in(words) -> str:
    return ", ".join(q(w) for w in words)


# Posts with a header, reply lines and a signature around every document.
def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")

    def line(no, text):
        no = F.lit(no) if isinstance(no, int) else no
        text = F.lit(text) if isinstance(text, str) else text
        return F.struct(no.cast("int").alias("line_no"), text.alias("text"))

    none = F.array().cast(f"array<{clean.LINE}>")
    head = F.array(
        line(1, F.concat(F.lit("From: user"), d.cast("string"), F.lit("@example.edu"))),
        line(
            2,
            F.when(d % 17 == 0, "--odd header--").otherwise(
                F.concat(F.lit("Subject: post "), d.cast("string"))
            ),
        ),
    )
    blank = F.when(d % 19 != 0, F.array(line(3, ""))).otherwise(none)
    reply = F.when(
        d % 3 == 0,
        F.array(
            line(4, "In article <1@x.edu> someone writes:"),
            line(5, "> quoted line 1"),
            line(6, "}quoted line 2"),
        ),
    ).otherwise(none)
    body = F.transform(F.split("text", "\n"), lambda x, p: line(p + 100, x))
    sign = F.when(
        d % 2 == 0, F.array(line(1_000_000, "--"), line(1_000_001, "signature line"))
    ).otherwise(none)
    return documents(spark, sf, "doc_id", "source", "text").select(
        F.col("source").alias("grp"),
        d.alias("id"),
        F.concat(head, blank, reply, body, sign).alias("lines"),
    )


RAW_SQL = """
raw_lines AS (
  SELECT source AS grp, doc_id AS id, 1 AS line_no, 'From: user' || doc_id || '@example.edu' AS text FROM documents
  UNION ALL SELECT source, doc_id, 2, CASE WHEN doc_id % 17 = 0 THEN '--odd header--' ELSE 'Subject: post ' || doc_id END FROM documents
  UNION ALL SELECT source, doc_id, 3, '' FROM documents WHERE doc_id % 19 <> 0
  UNION ALL SELECT source, doc_id, 4, 'In article <1@x.edu> someone writes:' FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT source, doc_id, 5, '> quoted line 1' FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT source, doc_id, 6, '}quoted line 2' FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT grp, id, 99 + p, t FROM (
    SELECT source AS grp, doc_id AS id, unnest(a) AS t, generate_subscripts(a, 1) AS p
    FROM (SELECT source, doc_id, string_split(text, chr(10)) AS a FROM documents))
  UNION ALL SELECT source, doc_id, 1000000, '--' FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT source, doc_id, 1000001, 'signature line' FROM documents WHERE doc_id % 2 = 0),
seen AS (
  SELECT *, sum(CASE WHEN text = '' THEN 1 ELSE 0 END) OVER w AS empties,
         sum(CASE WHEN regexp_matches(text, '^-+') THEN 1 ELSE 0 END) OVER w AS dashes
  FROM raw_lines WINDOW w AS (PARTITION BY grp, id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
body AS (SELECT grp, id, line_no, text FROM seen WHERE empties > 0 AND dashes = 0),
content AS (
  SELECT * FROM body WHERE regexp_matches(text, '^[^>|}]+[A-Za-z0-9]')
    AND NOT regexp_matches(text, 'writes(:|\\.\\.\\.)$') AND NOT regexp_matches(text, '^In article <') AND text <> '')
"""

# Tokens of the classification pipeline (unstemmed).
_WORD, _URL = q(X.WORD), q(X.URL)
WORDS_SQL = f"""
cut AS (SELECT doc_id, lang, source, regexp_extract_all(regexp_replace(text, {_URL}, ' ', 'g'), {_WORD}) AS a FROM documents),
word AS (SELECT doc_id, lang, source, tok FROM (SELECT doc_id, lang, source, unnest(a) AS tok FROM cut)
         WHERE NOT regexp_matches(tok, {q(X.NUMBER)}))
"""
CLEAN_SQL = f"""
{WORDS_SQL},
clean AS (SELECT doc_id, lang, source, lower(tok) AS tok FROM word
          WHERE length(tok) >= 3 AND NOT regexp_matches(tok, {q(X.EMAIL)})
            AND lower(tok) NOT IN ({words_in(ENGLISH_STOPWORDS)}))
"""
DTM_SQL = f"""
{CLEAN_SQL},
dtm AS MATERIALIZED (SELECT doc_id, lang, source, tok AS term, count(*) AS tf FROM clean GROUP BY ALL),
sized AS MATERIALIZED (SELECT *, sum(tf) OVER (PARTITION BY doc_id) AS doc_len FROM dtm),
n AS (SELECT count(*) AS n FROM documents),
terms AS MATERIALIZED (SELECT term, sum(tf)::BIGINT AS total, count(*) AS doc_freq FROM dtm GROUP BY term),
weights AS MATERIALIZED (SELECT term, sum(tf / doc_len) * log10(any_value(n.n) / count(*)) AS weight FROM sized, n GROUP BY term)
"""


def clean_tokens(spark: SparkSession, sf: str, bigrams: bool = False) -> DataFrame:
    return T.classify_tokens(T.colocate(documents(spark, sf)), bigrams=bigrams)


def dtm(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    return D.document_terms(clean_tokens(spark, sf), keep=keep)
