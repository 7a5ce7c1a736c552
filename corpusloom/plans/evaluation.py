"""Splits, predictions and their evaluation, clusters against categories, topic tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import (
    cluster_eval as CE,
    dtm as D,
    knn as K,
    metrics as M,
    relational as R,
    similarity as SIM,
    topics_tables as TT,
)
from corpusloom.operators.split import random_split, stratified_folds, stratified_split
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import CLEAN_SQL, DTM_SQL, dtm, table
from corpusloom.plans.vectors import EMB_SQL, clustered, vectors

# --- splits ------------------------------------------------------------------

_EMB_SPLIT = """split AS (SELECT vec_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id))
  <= ceil(count(*) OVER (PARTITION BY label) * 0.8) THEN 'train' ELSE 'test' END AS split FROM embeddings)"""


def labelled(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label")


@query(
    "split_stratified",
    """SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id))
    <= ceil(count(*) OVER (PARTITION BY lang) * 0.8) THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def split_stratified(spark, sf):
    return stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id")


@query(
    "split_random",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id))
    <= round_even(count(*) OVER () * 0.75, 0) THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def split_random(spark, sf):
    return random_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    "split_subset",
    f"WITH {_EMB_SPLIT} SELECT vec_id, label FROM split WHERE split = 'train'",
)
def split_subset(spark, sf):
    parts = stratified_split(labelled(spark, sf), "label", "vec_id")
    return parts.where(F.col("split") == "train").drop("split")


@query(
    "folds_stratified",
    """SELECT doc_id, lang, ((row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id)) - 1) % 5)::INTEGER AS fold FROM documents""",
)
def folds_stratified(spark, sf):
    return stratified_folds(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id")


# --- predictions -----------------------------------------------------------------

_PRED = f"""{EMB_SQL},
near AS (SELECT a.vec_id AS i, a.label AS reference, b.label AS prediction FROM e a JOIN e b ON a.vec_id <> b.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.v, b.v)
   / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 9) DESC, b.vec_id) = 1)"""


def predictions(spark, sf):
    """The label of the nearest other vector as the prediction."""
    near = SIM.neighbours(vectors(spark, sf), 1).select("i", "j")
    labels = labelled(spark, sf)
    return (
        near.join(labels.select(F.col("vec_id").alias("j"), F.col("label").alias("prediction")), "j")
        .join(labels.select(F.col("vec_id").alias("i"), F.col("label").alias("reference")), "i")
        .select("i", "reference", "prediction")
    )


@query("confusion", f"WITH {_PRED} SELECT prediction, reference, count(*) AS n FROM near GROUP BY ALL")
def confusion(spark, sf):
    return M.confusion(predictions(spark, sf))


def measures_sql(source: str, positive: str, by: str = "") -> str:
    """Precision, recall, F1, accuracy, kappa of a table (prediction, reference)."""
    comma, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    on = f"USING ({by})" if by else "ON true"
    return f"""cells AS (SELECT {comma}prediction, reference, count(*) AS n FROM {source} GROUP BY ALL),
    base AS (SELECT {comma}sum(n) AS total, sum(CASE WHEN prediction = '{positive}' AND reference = '{positive}' THEN n ELSE 0 END) AS tp,
      sum(CASE WHEN prediction = '{positive}' THEN n ELSE 0 END) AS pp, sum(CASE WHEN reference = '{positive}' THEN n ELSE 0 END) AS rp,
      sum(CASE WHEN prediction = reference THEN n ELSE 0 END) AS ok FROM cells {group}),
    pm AS (SELECT {comma}prediction AS c, sum(n) AS np FROM cells GROUP BY ALL), rm AS (SELECT {comma}reference AS c, sum(n) AS nr FROM cells GROUP BY ALL),
    chance AS (SELECT {comma}sum(np * nr) AS chance FROM pm JOIN rm USING ({comma}c) {group})
    SELECT {comma}round(tp / nullif(pp, 0), 6) AS precision, round(tp / nullif(rp, 0), 6) AS recall, round(2 * tp / nullif(pp + rp, 0), 6) AS f1,
    round(ok / total, 6) AS accuracy, round((ok / total - chance / (total * total)) / nullif(1 - chance / (total * total), 0), 6) AS kappa
    FROM base JOIN chance {on}"""


def rounded(df, *skip):
    return df.select(*[c if c in skip else F.round(c, 6).alias(c) for c in df.columns])


def _parity(c):
    return F.when(F.col(c) % 2 == 0, "even").otherwise("odd").alias(c)


@query(
    "eval_measures",
    f"""WITH {_PRED}, two AS (SELECT CASE WHEN prediction % 2 = 0 THEN 'even' ELSE 'odd' END AS prediction,
    CASE WHEN reference % 2 = 0 THEN 'even' ELSE 'odd' END AS reference FROM near), {measures_sql("two", "even")}""",
)
def eval_measures(spark, sf):
    two = predictions(spark, sf).select(_parity("prediction"), _parity("reference"))
    return rounded(M.eval_measures(two, "even"))


_KS = list(range(5, 36, 2))
_VOTES = """neigh AS (SELECT a.vec_id AS i, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(1 - round(list_dot_product(a.v, b.v)
   / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 9), 9), b.vec_id) AS r
  FROM {queries} a JOIN {train} b ON a.vec_id <> b.vec_id),
votes AS (SELECT i, k, label, count(*) AS c FROM neigh JOIN (SELECT unnest(range(5, 36, 2)) AS k) ks ON r <= k GROUP BY ALL),
pred AS (SELECT i, k, label AS prediction FROM votes QUALIFY row_number() OVER (PARTITION BY i, k ORDER BY c DESC, label) = 1)"""
_TT = f"""{EMB_SQL}, {_EMB_SPLIT},
tr AS (SELECT e.* FROM e JOIN split USING (vec_id) WHERE split = 'train'),
te AS (SELECT e.* FROM e JOIN split USING (vec_id) WHERE split = 'test')"""


def _parts(spark, sf):
    parts = stratified_split(labelled(spark, sf), "label", "vec_id").withColumnRenamed("vec_id", "id")
    both = vectors(spark, sf).join(parts, "id")
    return both.where(F.col("split") == "train"), both.where(F.col("split") == "test")


def _edges(near):
    return near.select("i", "j", F.round(1 - F.col("s"), 9).alias("d"))


@query(
    "knn_train_grid",
    f"""WITH {_TT}, {_VOTES.format(queries="tr", train="tr")},
    scored AS (SELECT k, CASE WHEN prediction % 2 = 0 THEN 'even' ELSE 'odd' END AS prediction,
      CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS reference FROM pred JOIN tr ON tr.vec_id = i),
    {measures_sql("scored", "even", "k")}""",
)
def knn_train_grid(spark, sf):
    """Measures for every k of the grid from one neighbour table."""
    train, _ = _parts(spark, sf)
    edges = _edges(SIM.neighbours(train.select("id", "vec"), max(_KS)))
    labels = train.select(F.col("id").alias("j"), "label")
    votes = K.vote(K.nearest(edges, max(_KS)), labels, _KS)
    scored = votes.join(labels.withColumnRenamed("j", "i"), "i").select(
        "k", _parity("prediction"), F.when(F.col("label") % 2 == 0, "even").otherwise("odd").alias("reference")
    )
    return rounded(M.eval_measures(scored, "even", by=["k"]), "k").withColumn("k", F.col("k").cast("bigint"))


@query(
    "knn_test",
    f"""WITH {_TT}, {_VOTES.format(queries="te", train="tr")}
    SELECT i, prediction, te.label AS reference FROM pred JOIN te ON te.vec_id = i WHERE k = 23""",
)
def knn_test(spark, sf):
    train, test = _parts(spark, sf)
    near = SIM.neighbours(train.select("id", "vec"), 23, queries=test.select("id", "vec"))
    labels = train.select(F.col("id").alias("j"), "label")
    votes = K.vote(K.nearest(_edges(near), 23), labels, [23])
    truth = test.select(F.col("id").alias("i"), F.col("label").alias("reference"))
    return votes.join(truth, "i").select("i", "prediction", "reference")


@query(
    "best_tuning_row",
    """WITH r AS (SELECT event_type AS model, (user_id % 20)::BIGINT AS param, round(avg(value), 6) AS metric, count(*) AS n
      FROM events GROUP BY ALL)
    SELECT model, param, metric, n FROM r QUALIFY row_number() OVER (PARTITION BY model ORDER BY metric DESC, param) = 1""",
)
def best_tuning_row(spark, sf):
    """The row of the best parameter value of each model."""
    results = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("model"), (F.col("user_id") % 20).alias("param"))
        .agg(F.round(F.avg("value"), 6).alias("metric"), F.count(F.lit(1)).alias("n"))
    )
    return R.best_row(results, ["model"], "metric", "param")


def _shift(df, model, n_features):
    return df.withColumn("model", F.lit(model)).withColumn("n_features", F.lit(n_features))


@query(
    "model_comparison",
    f"""WITH {_TT}, {_VOTES.format(queries="te", train="tr")},
    acc AS (SELECT k, avg(CASE WHEN prediction = te.label THEN 1.0 ELSE 0.0 END) AS a FROM pred JOIN te ON te.vec_id = i GROUP BY k)
    SELECT 'knn_' || k AS model, 64 AS n_features, round(a, 6) AS accuracy FROM acc WHERE k IN (5, 23)
    UNION ALL SELECT 'majority', 0, round(max(n) / sum(n), 6) FROM (SELECT label, count(*) AS n FROM te GROUP BY label)""",
)
def model_comparison(spark, sf):
    """Stacked table of models with their accuracy and feature count."""
    train, test = _parts(spark, sf)
    near = SIM.neighbours(train.select("id", "vec"), 23, queries=test.select("id", "vec"))
    labels = train.select(F.col("id").alias("j"), "label")
    votes = K.vote(K.nearest(_edges(near), 23), labels, [5, 23])
    truth = test.select(F.col("id").alias("i"), "label")
    hit = F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0)
    knn = votes.join(truth, "i").groupBy("k").agg(F.round(F.avg(hit), 6).alias("accuracy"))
    knn = knn.select(F.concat(F.lit("knn_"), F.col("k").cast("string")).alias("model"), F.lit(64).alias("n_features"), "accuracy")
    base = test.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(
        F.round(F.max("n") / F.sum("n"), 6).alias("accuracy")
    )
    return knn.unionByName(_shift(base, "majority", 0).select("model", "n_features", "accuracy"))


@query(
    "train_test_measures",
    f"""WITH {_TT}, {_VOTES.format(queries="e", train="tr")},
    scored AS (SELECT split, CASE WHEN prediction % 2 = 0 THEN 'even' ELSE 'odd' END AS prediction,
      CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS reference FROM pred JOIN split ON split.vec_id = i WHERE k = 23),
    {measures_sql("scored", "even", "split")}""",
)
def train_test_measures(spark, sf):
    """Train and test rows side by side; a training post never votes for itself."""
    train, test = _parts(spark, sf)
    labels = train.select(F.col("id").alias("j"), "label")
    own = SIM.neighbours(train.select("id", "vec"), 23)
    new = SIM.neighbours(train.select("id", "vec"), 23, queries=test.select("id", "vec"))
    votes = K.vote(K.nearest(_edges(own.unionByName(new)), 23), labels, [23])
    truth = train.unionByName(test).select(F.col("id").alias("i"), "split", "label")
    scored = votes.join(truth, "i").select(
        "split", _parity("prediction"), F.when(F.col("label") % 2 == 0, "even").otherwise("odd").alias("reference")
    )
    return rounded(M.eval_measures(scored, "even", by=["split"]), "split")


# --- clusters against categories ------------------------------------------------

_CELLS = """cells AS (SELECT c.cluster, g.category, count(e.vec_id) AS n FROM (SELECT DISTINCT label % 4 AS cluster FROM embeddings) c
  CROSS JOIN (SELECT DISTINCT label AS category FROM embeddings) g
  LEFT JOIN embeddings e ON e.label % 4 = c.cluster AND e.label = g.category GROUP BY ALL),
shares AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS p FROM cells)"""


def cells(spark, sf):
    rows = table(spark, sf, "embeddings").select((F.col("label") % 4).alias("cluster"), F.col("label").alias("category"))
    return CE.contingency(rows)


@query("cluster_contingency", f"WITH {_CELLS} SELECT cluster, category, n FROM cells")
def cluster_contingency(spark, sf):
    return cells(spark, sf)


@query("cluster_row_props", f"WITH {_CELLS} SELECT cluster, category, round(p, 2) AS share FROM shares")
def cluster_row_props(spark, sf):
    return CE.row_shares(cells(spark, sf)).select("cluster", "category", F.round("share", 2).alias("share"))


@query("cluster_purity", f"WITH {_CELLS} SELECT cluster, round(max(n) / sum(n), 6) AS purity FROM cells GROUP BY cluster")
def cluster_purity(spark, sf):
    return CE.purity(cells(spark, sf)).withColumn("purity", F.round("purity", 6))


_ENTROPY = f"""{_CELLS}, ent AS (SELECT cluster, sum(n) AS size, -sum(CASE WHEN n > 0 THEN p * log10(p) ELSE 0 END) / log10(count(*)) AS entropy
 FROM shares GROUP BY cluster)"""


@query("cluster_entropy", f"WITH {_ENTROPY} SELECT cluster, size::BIGINT AS size, round(entropy, 6) AS entropy FROM ent")
def cluster_entropy(spark, sf):
    return CE.entropy(cells(spark, sf)).withColumn("entropy", F.round("entropy", 6))


@query("cluster_entropy_avg", f"WITH {_ENTROPY} SELECT round(sum(size * entropy) / sum(size), 6) AS avg_entropy FROM ent")
def cluster_entropy_avg(spark, sf):
    return rounded(CE.mean_entropy(cells(spark, sf)))


@query(
    "cluster_relabel",
    """WITH x AS (SELECT label, min(vec_id) AS exemplar FROM embeddings GROUP BY label)
    SELECT vec_id, exemplar, dense_rank() OVER (ORDER BY exemplar)::INTEGER AS cluster FROM embeddings JOIN x USING (label)""",
)
def cluster_relabel(spark, sf):
    """Exemplar ids replaced by 1..n."""
    rows = labelled(spark, sf)
    exemplars = rows.groupBy("label").agg(F.min("vec_id").alias("exemplar"))
    return CE.relabel(rows.join(exemplars, "label").select("vec_id", "exemplar"), "exemplar")


@query(
    "exemplar_lookup",
    """SELECT x.exemplar, e.label, n FROM (SELECT label AS cluster, min(vec_id) AS exemplar, count(*) AS n FROM embeddings GROUP BY label) x
    JOIN embeddings e ON e.vec_id = x.exemplar""",
)
def exemplar_lookup(spark, sf):
    rows = labelled(spark, sf)
    exemplars = rows.groupBy(F.col("label").alias("cluster")).agg(
        F.min("vec_id").alias("exemplar"), F.count(F.lit(1)).alias("n")
    )
    return exemplars.join(rows, F.col("exemplar") == F.col("vec_id")).select("exemplar", "label", "n")


@query(
    "cluster_comparison",
    f"""WITH a AS (SELECT 'by_4' AS solution, label % 4 AS cluster, label AS category FROM embeddings
      UNION ALL SELECT 'by_3', label % 3, label FROM embeddings),
    c AS (SELECT solution, cluster, category, count(*) AS n FROM a GROUP BY ALL),
    p AS (SELECT solution, cluster, max(n) / sum(n) AS purity FROM c GROUP BY ALL)
    SELECT cluster, round(max(CASE WHEN solution = 'by_3' THEN purity END), 6) AS by_3,
    round(max(CASE WHEN solution = 'by_4' THEN purity END), 6) AS by_4 FROM p GROUP BY cluster""",
)
def cluster_comparison(spark, sf):
    """Purity of two solutions side by side."""
    rows = labelled(spark, sf)
    each = [
        CE.purity(
            CE.contingency(rows.select((F.col("label") % m).alias("cluster"), F.col("label").alias("category")))
        ).withColumn("solution", F.lit(f"by_{m}"))
        for m in (3, 4)
    ]
    both = each[0].unionByName(each[1])
    return both.groupBy("cluster").pivot("solution", ["by_3", "by_4"]).agg(F.round(F.max("purity"), 6))


# --- topic tables ------------------------------------------------------------------

_TOPICS = f"""{CLEAN_SQL}, c AS (SELECT lang AS topic, tok AS term, count(*) AS n FROM clean GROUP BY ALL),
tt AS (SELECT topic, term, n / sum(n) OVER (PARTITION BY topic) AS p FROM c)"""


def topic_terms(spark, sf):
    """Topic = language, p = share of a term among the tokens of the language."""
    counts = dtm(spark, sf, keep=["lang"]).groupBy(F.col("lang").alias("topic"), "term").agg(F.sum("tf").alias("n"))
    totals = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    return counts.join(totals, "topic").select("topic", "term", (F.col("n") / F.col("total")).alias("p"))


@query("topic_top_terms_table", f"WITH {_TOPICS} SELECT topic, term, p, rank() OVER (PARTITION BY topic ORDER BY p DESC)::INTEGER AS rank FROM tt QUALIFY rank <= 15")
def topic_top_terms_table(spark, sf):
    return TT.top_terms(topic_terms(spark, sf), 15)


_DOC_TOPICS = """dn AS (SELECT user_id AS doc_id, event_type AS topic, count(*) AS n FROM events GROUP BY ALL),
dt AS (SELECT doc_id, topic, n / sum(n) OVER (PARTITION BY doc_id) AS p FROM dn)"""
_EVENTS = ["click", "error", "purchase", "signup", "view"]


def doc_topics(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.col("user_id").alias("doc_id"), F.col("event_type").alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("doc_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "doc_id").select("doc_id", "topic", (F.col("n") / F.col("total")).alias("p"))


@query(
    "topic_unpivot",
    f"""WITH {_DOC_TOPICS}, d AS (SELECT DISTINCT doc_id FROM dt), t AS (SELECT DISTINCT topic FROM dt)
    SELECT d.doc_id, t.topic, coalesce(dt.p, 0) AS p FROM d CROSS JOIN t LEFT JOIN dt ON dt.doc_id = d.doc_id AND dt.topic = t.topic""",
)
def topic_unpivot(spark, sf):
    """Wide posteriors (one column per topic) to long."""
    wide = doc_topics(spark, sf).groupBy("doc_id").pivot("topic", _EVENTS).agg(F.max("p")).na.fill(0.0)
    return TT.to_long(wide, ["doc_id"], _EVENTS, "topic", "p")


@query(
    "topic_dominant_counts",
    f"""WITH {_DOC_TOPICS}, m AS (SELECT doc_id, topic FROM dt QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, topic) = 1)
    SELECT doc_id % 4 AS grp, topic AS main_topic, count(*) AS n FROM m GROUP BY ALL""",
)
def topic_dominant_counts(spark, sf):
    main = TT.dominant_topic(doc_topics(spark, sf))
    return main.groupBy((F.col("doc_id") % 4).alias("grp"), F.col("topic").alias("main_topic")).agg(F.count(F.lit(1)).alias("n"))


_PAIRS = f"""{_TOPICS}, ids AS (SELECT DISTINCT topic FROM tt), voc AS (SELECT DISTINCT term FROM tt),
full_tt AS (SELECT topic, term, coalesce(p, 0) AS p FROM ids CROSS JOIN voc LEFT JOIN tt USING (topic, term)),
pq AS (SELECT a.topic AS a, b.topic AS b, a.p AS p, b.p AS q, (a.p + b.p) / 2 AS m FROM full_tt a JOIN full_tt b ON a.term = b.term AND a.topic < b.topic)"""


@query(
    "topic_metric_cosine",
    f"""WITH {_PAIRS}, s AS (SELECT a, b, sum(p * q) / sqrt(sum(p * p) * sum(q * q)) AS cosine FROM pq GROUP BY a, b)
    SELECT round(avg(cosine), 6) AS mean_cosine FROM s""",
)
def topic_metric_cosine(spark, sf):
    return TT.topic_pairs(topic_terms(spark, sf)).agg(F.round(F.avg("cosine"), 6).alias("mean_cosine"))


@query(
    "topic_metric_js",
    f"""WITH {_PAIRS}, s AS (SELECT a, b, sum(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) / 2 AS js FROM pq GROUP BY a, b)
    SELECT a, b, round(js, 6) AS js FROM s""",
)
def topic_metric_js(spark, sf):
    return TT.topic_pairs(topic_terms(spark, sf)).select("a", "b", F.round("js", 6).alias("js"))


def trace(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("k"), F.col("event_id").alias("iteration"), (-F.col("value")).alias("loglik")
    )


@query("burnin_drop", "SELECT event_type AS k, event_id AS iteration, -value AS loglik FROM events WHERE event_id > 100")
def burnin_drop(spark, sf):
    return TT.after_burn_in(trace(spark, sf), 100)


@query(
    "harmonic_mean_loglik",
    """WITH t AS (SELECT event_type AS k, -value AS v FROM events WHERE event_id > 100), m AS (SELECT k, min(v) AS lo FROM t GROUP BY k)
    SELECT k, round(lo - ln(avg(exp(lo - v))), 6) AS harmonic_mean FROM t JOIN m USING (k) GROUP BY k, lo""",
)
def harmonic_mean_loglik(spark, sf):
    return rounded(TT.harmonic_mean(burnin_drop(spark, sf)), "k")
