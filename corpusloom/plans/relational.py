"""Filters, joins, set operations, orderings on the given tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from corpusloom.functions import text as X
from corpusloom.operators import relational as R
from corpusloom.plans.catalog import query
from corpusloom.plans.stats import CORPUS_SQL, corpus
from corpusloom.plans.tables import DTM_SQL, documents, n_docs, q, table
from corpusloom.plans.terms import documents_tokens, term_totals, top_terms_per_group
from corpusloom.sources.vectors import parse_vector_lines

_ALL = f"SELECT doc_id, lang, source, unnest(regexp_extract_all(text, {q(X.WORD)})) AS tok FROM documents"


@query("scan_documents", "SELECT doc_id, lang, source, n_chars FROM documents")
def scan_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


@query("group_prefix_filter", "SELECT doc_id, source FROM documents WHERE source LIKE 'src1%'")
def group_prefix_filter(spark, sf):
    return R.groups_starting(documents(spark, sf, "doc_id", "source"), "source", "src1")


@query("group_list_filter", "SELECT doc_id, source FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3')")
def group_list_filter(spark, sf):
    docs = documents(spark, sf, "doc_id", "source")
    return R.groups_in(docs, "source", ["src0", "src1", "src2", "src3"])


@query("id_list_drop", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (9, 99, 149)")
def id_list_drop(spark, sf):
    return R.without_ids(documents(spark, sf, "doc_id", "lang"), "doc_id", [9, 99, 149])


_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


@query(
    "label_recode",
    f"""SELECT doc_id, CASE lang {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _NAMES.items())} END AS language FROM documents""",
)
def label_recode(spark, sf):
    return documents(spark, sf, "doc_id", "lang").select(
        "doc_id", R.recode(F.col("lang"), _NAMES).alias("language")
    )


@query("two_way_label", "SELECT doc_id, CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS label FROM documents")
def two_way_label(spark, sf):
    return documents(spark, sf, "doc_id", "lang").select(
        "doc_id", F.when(F.col("lang") == "en", "english").otherwise("other").alias("label")
    )


@query("point_lookup", "SELECT doc_id, text FROM documents WHERE doc_id = 108")
def point_lookup(spark, sf):
    return documents(spark, sf, "doc_id", "text").where(F.col("doc_id") == 108)


@query(
    "document_variables",
    """SELECT d.doc_id, d.source AS field, g.n_group, 'train' AS split FROM documents d
    JOIN (SELECT source, count(*) AS n_group FROM documents GROUP BY source) g ON g.source = d.source""",
)
def document_variables(spark, sf):
    """Columns attached to documents: a copy, a group value and a constant."""
    docs = documents(spark, sf, "doc_id", "source")
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_group"))
    return docs.join(sizes, "source").select(
        "doc_id", F.col("source").alias("field"), "n_group", F.lit("train").alias("split")
    )


@query("select_drop_columns", "SELECT doc_id, lang, n_chars FROM documents")
def select_drop_columns(spark, sf):
    return table(spark, sf, "documents").drop("text", "source")


@query(
    "key_join_split",
    "SELECT source || '_' || doc_id AS post_id, source AS grp, doc_id::VARCHAR AS id FROM documents",
)
def key_join_split(spark, sf):
    post_id = F.concat_ws("_", "source", F.col("doc_id").cast("string"))
    keyed = documents(spark, sf, "doc_id", "source").select(post_id.alias("post_id"))
    parts = F.split("post_id", "_")
    return keyed.select("post_id", parts[0].alias("grp"), parts[1].alias("id"))


# --- joins ------------------------------------------------------------------


@query(
    "left_label_join",
    "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def left_label_join(spark, sf):
    docs, labels = documents(spark, sf, "doc_id", "lang"), table(spark, sf, "labels")
    return docs.join(labels.select("doc_id", "quality"), "doc_id", "left")


@query(
    "left_join_other_key",
    "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def left_join_other_key(spark, sf):
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "c_nationkey", "n_name"
    )


@query("semi_join", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id")
    return documents(spark, sf, "doc_id", "lang").join(labels, "doc_id", "left_semi")


@query("anti_join", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id")
    return documents(spark, sf, "doc_id", "lang").join(labels, "doc_id", "left_anti")


@query(
    "bind_label",
    f"""WITH {CORPUS_SQL} SELECT doc_id, quality AS label, tokens, sentences, ttr FROM corpus JOIN labels USING (doc_id)""",
)
def bind_label(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return labels.join(corpus(spark, sf), "doc_id").select(
        "doc_id", "label", "tokens", "sentences", "ttr"
    )


# --- orderings ----------------------------------------------------------------


@query("sort_terms", f"WITH {DTM_SQL} SELECT term, total FROM terms ORDER BY total DESC, term")
def sort_terms(spark, sf):
    return term_totals(spark, sf).orderBy(F.desc("total"), "term")


@query("top_terms", f"WITH {DTM_SQL} SELECT term, total FROM terms ORDER BY total DESC, term LIMIT 30")
def top_terms(spark, sf):
    return term_totals(spark, sf).orderBy(F.desc("total"), "term").limit(30)


@query("last_terms", f"WITH {DTM_SQL} SELECT term, total FROM terms ORDER BY term DESC LIMIT 100")
def last_terms(spark, sf):
    return term_totals(spark, sf).orderBy(F.desc("term")).limit(100)


@query(
    "rank_positions",
    f"""WITH {DTM_SQL} SELECT term, position FROM (SELECT term, row_number() OVER (ORDER BY total DESC, term) AS position FROM terms)
    WHERE term IN ('der', 'les', 'que', 'ment')""",
)
def rank_positions(spark, sf):
    return R.positions_in_ranking(term_totals(spark, sf), "term", "total", ["der", "les", "que", "ment"])


@query(
    "global_top_with_ties",
    f"""WITH {DTM_SQL} SELECT term, total FROM terms QUALIFY rank() OVER (ORDER BY total DESC) <= 15""",
)
def global_top_with_ties(spark, sf):
    """Top 15 with ties: the 15th value comes from a bounded top-k, then a filter."""
    totals = term_totals(spark, sf)
    last = totals.orderBy(F.desc("total")).limit(15).agg(F.min("total")).scalar()
    return totals.where(F.col("total") >= last)


@query(
    "display_order",
    f"""WITH {DTM_SQL}, g AS (SELECT source, term, round(sum(tf / doc_len) * log10(any_value(n.n) / any_value(doc_freq)), 6) AS weight
      FROM sized JOIN terms USING (term), n GROUP BY source, term),
    t AS (SELECT * FROM g QUALIFY rank() OVER (PARTITION BY source ORDER BY weight DESC) <= 10)
    SELECT source, term, dense_rank() OVER (PARTITION BY source ORDER BY weight)::INTEGER AS place FROM t""",
)
def display_order(spark, sf):
    """Place of a label among the (few) kept ones of its group, by weight."""
    w = Window.partitionBy("source").orderBy("weight")
    return top_terms_per_group(spark, sf).select(
        "source", "term", F.dense_rank().over(w).alias("place")
    )


# --- sets -----------------------------------------------------------------------


@query(
    "append_rows",
    """SELECT doc_id AS id, text, 'documents' AS origin FROM documents
    UNION ALL SELECT item_id, text, 'benchmark' FROM benchmark""",
)
def append_rows(spark, sf):
    docs = documents(spark, sf, "doc_id", "text").select(
        F.col("doc_id").alias("id"), "text", F.lit("documents").alias("origin")
    )
    items = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"), "text", F.lit("benchmark").alias("origin")
    )
    return docs.unionByName(items)


@query("distinct_groups", "SELECT DISTINCT source, lang FROM documents")
def distinct_groups(spark, sf):
    return documents(spark, sf, "source", "lang").distinct()


@query("distinct_terms_count", f"SELECT count(DISTINCT lower(tok)) AS n_terms FROM ({_ALL})")
def distinct_terms_count(spark, sf):
    toks = F.array_distinct(X.lowered(X.tokens(F.col("text"))))
    words = documents(spark, sf, "text").select(F.explode_outer(toks).alias("term"))
    return words.where(F.col("term").isNotNull()).distinct().agg(
        F.count(F.lit(1)).alias("n_terms")
    )


@query(
    "distinct_terms_per_group",
    f"SELECT source, count(DISTINCT lower(tok)) AS n_terms FROM ({_ALL}) GROUP BY source",
)
def distinct_terms_per_group(spark, sf):
    """Made distinct on (group, term) first, then counted: no group is one task."""
    toks = F.array_distinct(X.lowered(X.tokens(F.col("text"))))
    words = documents(spark, sf, "source", "text").select(
        "source", F.explode_outer(toks).alias("term")
    )
    return (
        words.where(F.col("term").isNotNull())
        .distinct()
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n_terms"))
    )


@query(
    "distinct_rows_count",
    "SELECT count(*) AS n_rows FROM (SELECT DISTINCT lang, source, n_chars FROM documents)",
)
def distinct_rows_count(spark, sf):
    rows = table(spark, sf, "documents").select("lang", "source", "n_chars")
    return rows.distinct().agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "stats_wide_to_long",
    f"""WITH {CORPUS_SQL}, w AS (SELECT doc_id, types, tokens, sentences FROM corpus)
    SELECT doc_id, feature, value FROM (UNPIVOT w ON types, tokens, sentences INTO NAME feature VALUE value)""",
)
def stats_wide_to_long(spark, sf):
    wide = corpus(spark, sf).select("doc_id", "types", "tokens", "sentences")
    return wide.unpivot("doc_id", ["types", "tokens", "sentences"], "feature", "value")


@query(
    "word_vector_lines",
    """SELECT 'w' || vec_id AS term, d - 1 AS dim, x::DOUBLE AS value FROM
    (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings)""",
)
def word_vector_lines(spark, sf):
    """Lines 'word v1 v2 ...' parsed to (term, vec)."""
    lines = table(spark, sf, "embeddings").select(
        F.concat_ws(
            " ",
            F.concat(F.lit("w"), F.col("vec_id").cast("string")),
            F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), " "),
        ).alias("value")
    )
    return parse_vector_lines(lines).select(
        "term", F.posexplode("vec").alias("dim", "value")
    ).withColumn("dim", F.col("dim").cast("bigint"))
