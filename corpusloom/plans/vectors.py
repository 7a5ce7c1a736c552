"""Document vectors: word-vector features, similarity, neighbours, cluster statistics."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from corpusloom.functions import text as X
from corpusloom.functions.words import ENGLISH_STOPWORDS
from corpusloom.operators import (
    cluster_eval as CE,
    dtm as D,
    embed as E,
    similarity as SIM,
    tokens as T,
)
from corpusloom.operators.joins import SHORT_ROWS, small
from corpusloom.operators.lineage import cut
from corpusloom.operators.order_stats import cumulative
from corpusloom.operators.rwmd import nearest_documents
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import WORDS_SQL, documents, q, table, words_in

DIMS = 64

EMB_SQL = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
PEARSON_SQL = """e AS (SELECT vec_id, label, list_transform(v, lambda x: x - list_avg(v)) AS v
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings))"""


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def top_sql(vectors_sql: str, measure: str, k: int = 10) -> str:
    return f"""WITH {vectors_sql},
    p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_dot_product(a.v, b.v) AS xy,
          list_dot_product(a.v, a.v) AS xx, list_dot_product(b.v, b.v) AS yy FROM e a JOIN e b ON a.vec_id <> b.vec_id),
    s AS (SELECT i, j, round({measure}, 9) AS s FROM p)
    SELECT i, j, s, row_number() OVER (PARTITION BY i ORDER BY s DESC, j)::INTEGER AS rank FROM s
    QUALIFY rank <= {k}"""


def _top(spark, sf, measure, k=10):
    return SIM.neighbours(vectors(spark, sf), k, measure)


@query("sim_cosine", top_sql(EMB_SQL, "xy / sqrt(xx * yy)"))
def sim_cosine(spark, sf):
    return _top(spark, sf, "cosine")


@query("sim_pearson", top_sql(PEARSON_SQL, "xy / sqrt(xx * yy)"))
def sim_pearson(spark, sf):
    return _top(spark, sf, "pearson")


@query("sim_ejaccard", top_sql(EMB_SQL, "xy / (xx + yy - xy)"))
def sim_ejaccard(spark, sf):
    return _top(spark, sf, "ejaccard")


@query(
    "dist_topk",
    f"""WITH t AS ({top_sql(EMB_SQL, "xy / sqrt(xx * yy)", 5)}) SELECT i, j, round(1 - s, 9) AS d, rank FROM t
    UNION ALL SELECT vec_id, vec_id, 0.0, 0 FROM embeddings""",
)
def dist_topk(spark, sf):
    """Distances 1 - s to the nearest five; the diagonal is 0."""
    near = _top(spark, sf, "cosine", 5).select("i", "j", F.round(1 - F.col("s"), 9).alias("d"), "rank")
    self_rows = vectors(spark, sf).select(
        F.col("id").alias("i"), F.col("id").alias("j"), F.lit(0.0).alias("d"), F.lit(0).alias("rank")
    )
    return near.unionByName(self_rows)


@query(
    "cosine_to_group_mean",
    f"""WITH {EMB_SQL}, m AS (SELECT label, d, avg(x) AS x FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM e) GROUP BY label, d),
    c AS (SELECT label, list(x ORDER BY d) AS c FROM m GROUP BY label)
    SELECT vec_id, round(list_dot_product(v, c) / sqrt(list_dot_product(v, v) * list_dot_product(c, c)), 6) AS s FROM e JOIN c USING (label)""",
)
def cosine_to_group_mean(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label", X.doubles(F.col("embedding")).alias("v"))
    means = rows.groupBy("label").agg(*[F.avg(F.col("v")[d]).alias(f"_{d}") for d in range(DIMS)])
    means = means.select("label", F.array(*[f"_{d}" for d in range(DIMS)]).alias("c"))
    return rows.join(means, "label").select("vec_id", F.round(X.cosine(F.col("v"), F.col("c")), 6).alias("s"))


# --- cluster statistics from vectors -----------------------------------------

CLUSTERS_SQL = f"""{EMB_SQL}, c AS (SELECT vec_id, label % 4 AS cluster, v FROM e),
pairs AS (SELECT a.vec_id AS i, b.vec_id AS j, a.cluster AS ci, b.cluster AS cj,
  1 - list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) AS d
  FROM c a JOIN c b ON a.vec_id <> b.vec_id),
sizes AS (SELECT cluster, count(*) AS size FROM c GROUP BY cluster)"""


def clustered(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        (F.col("label") % 4).alias("cluster"),
        X.doubles(F.col("embedding")).alias("vec"),
    )


@query(
    "cluster_internal_stats",
    f"""WITH {CLUSTERS_SQL},
    w AS (SELECT ci, avg(d) AS mean_d, sum(d * d) / 2 AS s2, max(d) AS hi FROM pairs WHERE ci = cj GROUP BY ci)
    SELECT round((SELECT avg(d) FROM pairs WHERE ci <> cj), 6) AS average_between,
    round((SELECT sum(mean_d * size) / sum(size) FROM w JOIN sizes ON ci = cluster), 6) AS average_within,
    round((SELECT max(hi) FROM w), 6) AS max_diameter,
    round((SELECT min(d) FROM pairs WHERE ci <> cj), 6) AS min_separation,
    round((SELECT sum(s2 / size) FROM w JOIN sizes ON ci = cluster), 6) AS within_cluster_ss""",
)
def cluster_internal_stats(spark, sf):
    rows = clustered(spark, sf)
    sums = CE.cosine_distance_stats(CE.unit_vectors(rows, "vec"), DIMS)
    ends = SIM.extreme_distances(rows.withColumnRenamed("doc_id", "id"))
    both = sums.withColumn("_e", ends.select(F.struct("*")).scalar()).select("*", "_e.*").drop("_e")
    return both.select(*[F.round(c, 6).alias(c) for c in both.columns])


@query(
    "cluster_silhouette",
    f"""WITH {CLUSTERS_SQL}, m AS (SELECT i, ci, cj, avg(d) AS d FROM pairs GROUP BY i, ci, cj),
    ab AS (SELECT i, ci, max(CASE WHEN ci = cj THEN d END) AS a, min(CASE WHEN ci <> cj THEN d END) AS b FROM m GROUP BY i, ci)
    SELECT ci AS cluster, count(*) AS size, round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS avg_width FROM ab GROUP BY ci""",
)
def cluster_silhouette(spark, sf):
    rows = CE.unit_vectors(clustered(spark, sf), "vec")
    return CE.cosine_silhouettes(rows, DIMS).withColumn("avg_width", F.round("avg_width", 6))


# --- features from word vectors ------------------------------------------------

_STOP = words_in(ENGLISH_STOPWORDS)
WV_SQL = f"""{WORDS_SQL},
emb AS (SELECT doc_id, regexp_replace(lower(tok), {q(X.POSSESSIVE)}, '\\1') AS term FROM word
  WHERE lower(tok) NOT IN ({_STOP}) AND length(lower(tok)) >= 3),
edtm AS (SELECT doc_id, term, count(*) AS tf FROM emb GROUP BY ALL),
tot AS (SELECT term, sum(tf) AS total FROM edtm GROUP BY term),
wv AS (SELECT term, embedding::DOUBLE[] AS v FROM (SELECT term, row_number() OVER (ORDER BY total DESC, term) AS r FROM tot)
  JOIN embeddings ON vec_id = r - 1),
red AS (SELECT doc_id, term, tf, v, sum(tf) OVER (PARTITION BY doc_id) AS kept, count(*) OVER (PARTITION BY term) AS df FROM edtm JOIN wv USING (term)),
nv AS (SELECT count(*) AS nv FROM wv), nd AS (SELECT count(*) AS nd FROM documents)"""


def embed_dtm(spark, sf):
    docs = T.colocate(documents(spark, sf, "doc_id", "text"))
    return D.document_terms(T.embed_tokens(docs)).select("doc_id", "term", "tf")


def word_vectors(spark, sf):
    """The r-th most frequent term (ties by term) gets the vector with id r - 1."""
    toks = T.embed_tokens(documents(spark, sf, "doc_id", "text")).select("toks")
    totals = T.explode_tokens(toks, out="term").groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    totals = cut(totals.withColumn("value", -F.col("total")))
    emb = table(spark, sf, "embeddings").select("vec_id", X.doubles(F.col("embedding")).alias("vec"))
    last = emb.agg(F.max("vec_id") + 1).scalar()
    levels = cumulative(cut(totals.groupBy("value").agg(F.count(F.lit(1)).alias("n"))))
    near = totals.join(levels.where(F.col("cum") - F.col("n") < last), "value")
    place = F.row_number().over(Window.partitionBy("value").orderBy("term"))
    ranked = near.select("term", (F.col("cum") - F.col("n") + place - 1).alias("vec_id"))
    return ranked.join(emb, "vec_id").select("term", "vec")


def _vocabulary(spark, sf):
    """Triples and vectors over the common vocabulary, and its size. Where the words are few enough to
    be broadcast, triples stay with their document."""
    vec = cut(word_vectors(spark, sf))
    return D.keep_terms(embed_dtm(spark, sf), small(vec.select("term"), SHORT_ROWS)), vec, D.row_count(vec)


def _long(features, digits=6):
    return features.select("doc_id", F.posexplode("features").alias("dim", "value")).withColumn(
        "value", F.round("value", digits)
    )


@query(
    "vocab_coverage",
    f"""WITH {WV_SQL} SELECT (SELECT count(*) FROM tot) AS n_terms, (SELECT count(*) FROM tot JOIN wv USING (term)) AS n_known,
    round((SELECT count(*) FROM tot JOIN wv USING (term)) / (SELECT count(*) FROM tot), 6) AS coverage""",
)
def vocab_coverage(spark, sf):
    out = E.coverage(embed_dtm(spark, sf), word_vectors(spark, sf))
    return out.withColumn("coverage", F.round("coverage", 6))


def _mean_sql(weight: str) -> str:
    return f"""WITH {WV_SQL}, x AS (SELECT doc_id, {weight} AS w, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM red, nd)
    SELECT doc_id, dim::INTEGER AS dim, round(sum(w * x) / any_value(nv), 6) AS value FROM x, nv GROUP BY doc_id, dim"""


@query("wordvec_tf_mean", _mean_sql("tf"))
def wordvec_tf_mean(spark, sf):
    counts, vec, n = _vocabulary(spark, sf)
    return _long(E.mean_features(counts, vec, DIMS, n))


@query("wordvec_tfidf_mean", _mean_sql("tf / kept * log10(nd / df)"))
def wordvec_tfidf_mean(spark, sf):
    """Weights of the reduced table: shares of the kept words, IDF over all documents."""
    counts, vec, n = _vocabulary(spark, sf)
    stats = D.term_stats(counts)
    weighted = D.project(counts, stats, D.row_count(table(spark, sf, "documents")))
    return _long(E.mean_features(weighted.select("doc_id", "term", "w"), vec, DIMS, n, "w"))


@query(
    "wordvec_minmax",
    f"""WITH {WV_SQL}, x AS (SELECT doc_id, tf * unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM red),
    m AS (SELECT doc_id, dim, min(x) AS lo, max(x) AS hi, count(*) AS c FROM x GROUP BY doc_id, dim)
    SELECT doc_id, dim::INTEGER AS dim, round(CASE WHEN c < nv THEN least(lo, 0) ELSE lo END, 6) AS value FROM m, nv
    UNION ALL SELECT doc_id, (dim + {DIMS})::INTEGER, round(CASE WHEN c < nv THEN greatest(hi, 0) ELSE hi END, 6) FROM m, nv""",
)
def wordvec_minmax(spark, sf):
    counts, vec, n = _vocabulary(spark, sf)
    return _long(E.minmax_features(counts, vec, DIMS, n))


@query(
    "rwmd",
    f"""WITH {WV_SQL}, u AS (SELECT term, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM wv),
    cost AS (SELECT a.term AS t1, b.term AS t2, 1 - list_dot_product(a.v, b.v) AS c FROM u a, u b),
    cheap AS (SELECT t1 AS term, red.doc_id AS j, min(c) AS c FROM cost JOIN red ON red.term = t2 GROUP BY ALL),
    one AS (SELECT red.doc_id AS i, cheap.j, sum(tf / kept * c) AS d FROM red JOIN cheap USING (term) GROUP BY ALL),
    two AS (SELECT a.i, a.j, round(greatest(a.d, b.d), 9) AS d FROM one a JOIN one b ON a.i = b.j AND a.j = b.i WHERE a.i <> a.j)
    SELECT i, j, d + 0.0 AS d, row_number() OVER (PARTITION BY i ORDER BY two.d, j)::INTEGER AS rank FROM two QUALIFY rank <= 5""",
)
def rwmd(spark, sf):
    """The five nearest documents of every document."""
    counts, vec, _ = _vocabulary(spark, sf)
    return nearest_documents(counts, vec, 5)
