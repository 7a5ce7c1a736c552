"""Queries whose result is a fitted model; checked by rows and by properties in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.stem import stem_table
from corpusloom.functions.words import TOPIC_STOPWORDS
from corpusloom.operators import classify as C, clusters as AP, dtm as D, gibbs as GIBBS, lsa, tokens as T, topics as LDA, trees as TREE
from corpusloom.operators.joins import salted_lookup
from corpusloom.operators.lineage import cut
from corpusloom.operators.similarity import distinct_rows, neighbours, vector_content
from corpusloom.operators.metrics import eval_measures
from corpusloom.operators.split import random_split, stratified_split
from corpusloom.operators.topics_tables import after_burn_in, harmonic_mean, top_terms as topic_top_terms
from corpusloom.plans.catalog import query
from corpusloom.plans.tables import documents, n_docs, table
from corpusloom.plans.textclass import feature_rows, labelled_documents, word_vector_means
from corpusloom.plans.vectors import top_sql, vectors

FACTORS = 300
GROUPS = 4  # topics and clusters asked for: the groups of the task


def _stemmed(docs, keep=()):
    """Counts per stem: distinct terms are stemmed once, then joined back."""
    counts = cut(D.document_terms(T.topic_tokens(T.colocate(docs)), keep=keep))
    stems = stem_table(D.term_stats(counts))
    joined = salted_lookup(counts, stems.select("term", "stem", "doc_freq"), "term", "doc_freq", F.col("doc_id"))
    return joined.groupBy("doc_id", *keep, "doc_len", F.col("stem").alias("term")).agg(F.sum("tf").alias("tf"))


@query("stemmed_dtm")
def stemmed_dtm(spark, sf):
    return _stemmed(documents(spark, sf, "doc_id", "text")).select("doc_id", "term", "tf")


def _weights(spark, sf):
    """Train and test TF-IDF over the training terms above the 0.75 quantile."""
    docs = random_split(documents(spark, sf, "doc_id", "text"), "doc_id")
    counts = cut(D.document_terms(T.classify_tokens(T.colocate(docs)), keep=["split"]))
    train = counts.where(F.col("split") == "train")
    test = counts.where(F.col("split") == "test")
    n = D.row_count(docs.where(F.col("split") == "train"))
    chosen = cut(D.terms_above(D.tfidf_totals(train, n), "weight", 0.75))
    full = D.project(train, chosen, n, denominator="full")
    return full.select("doc_id", "term", "w"), D.project(test, chosen, n).select("doc_id", "term", "w")


def _long(df):
    return df.select("doc_id", F.posexplode("features").alias("dim", "value"))


@query("lsa_features")
def lsa_features(spark, sf):
    train, _ = _weights(spark, sf)
    return _long(lsa.fit(train, FACTORS).documents)


@query("lsa_foldin")
def lsa_foldin(spark, sf):
    """Test documents in the space of the training documents."""
    train, test = _weights(spark, sf)
    return _long(lsa.fit(train, FACTORS).fold_in(test))


# --- topics --------------------------------------------------------------------


def topic_input(spark, sf):
    """Vectors of train and test documents over the selected stems, and the vocabulary."""
    docs = random_split(documents(spark, sf, "doc_id", "text"), "doc_id")
    counts = cut(_stemmed(docs, keep=["split"]))
    train = counts.where(F.col("split") == "train")
    n = D.row_count(docs.where(F.col("split") == "train"))
    frequent = D.tfidf_totals(train, n).where(F.col("doc_freq") >= 2)
    chosen = D.terms_from(cut(frequent), "weight", 0.75)
    chosen = cut(chosen.where(~F.col("term").isin(TOPIC_STOPWORDS)))
    train, test = D.keep_terms(train, chosen), D.keep_terms(test_rows(counts), chosen)
    vocabulary = lsa.vocabulary_index(train)
    return (
        cut(lsa.document_vectors(train, vocabulary, "tf")),
        cut(lsa.document_vectors(test, vocabulary, "tf")),
        vocabulary,
    )


def test_rows(counts):
    return counts.where(F.col("split") == "test")


_FIT = dict(k=4, max_iter=20)  # best of the five starts
TOPICS = range(3, 21)


@query("lda_topics")
def lda_topics(spark, sf):
    """Topic shares of the training documents."""
    train, _, _ = topic_input(spark, sf)
    return LDA.doc_topics(LDA.fit_topics(train, **_FIT), train)


@query("lda_top_terms")
def lda_top_terms(spark, sf):
    train, _, vocabulary = topic_input(spark, sf)
    return LDA.top_terms(LDA.fit_topics(train, **_FIT), vocabulary)


@query("lda_new_docs")
def lda_new_docs(spark, sf):
    """Topic shares of documents the model has not seen; those without a known term are out."""
    train, test, _ = topic_input(spark, sf)
    return LDA.doc_topics(LDA.fit_topics(train, **_FIT), test)


@query("lda_perplexity_by_k")
def lda_perplexity_by_k(spark, sf):
    train, test, _ = topic_input(spark, sf)
    return LDA.perplexity_by_k(train, test, TOPICS, max_iter=10)


@query("lda_metric_table")
def lda_metric_table(spark, sf):
    train, _, vocabulary = topic_input(spark, sf)
    return LDA.metrics_by_k(train, vocabulary, TOPICS, max_iter=10)


# --- topics by Gibbs sampling ------------------------------------------------------


def topic_counts(spark, sf):
    """(doc_id, term, tf) of train and test documents over the selected stems."""
    docs = random_split(documents(spark, sf, "doc_id", "text"), "doc_id")
    counts = cut(_stemmed(docs, keep=["split"]))
    train = counts.where(F.col("split") == "train")
    n = D.row_count(docs.where(F.col("split") == "train"))
    frequent = D.tfidf_totals(train, n).where(F.col("doc_freq") >= 2)
    chosen = D.terms_from(cut(frequent), "weight", 0.75)
    chosen = cut(chosen.where(~F.col("term").isin(TOPIC_STOPWORDS)))
    kept = [D.keep_terms(part, chosen).select("doc_id", "term", "tf") for part in (train, test_rows(counts))]
    return cut(kept[0]), cut(kept[1])


def sampled(spark, sf, ks, seeds=GIBBS.SEEDS, **options):
    """A chain of 2,000 rounds for each number of topics and start, and the test documents. Blocks
    exchange their counts every 100 rounds, as often as the likelihood is kept."""
    train, test = topic_counts(spark, sf)
    return GIBBS.fit(train, ks, seeds, together=GIBBS.KEEP, **options), test


@query("gibbs_topics")
def gibbs_topics(spark, sf):
    """Topic shares of the training documents: four topics, the best of five starts."""
    model, _ = sampled(spark, sf, [GROUPS])
    return model.best().doc_topics().select("doc_id", "topic", "p")


@query("gibbs_top_terms")
def gibbs_top_terms(spark, sf):
    model, _ = sampled(spark, sf, [GROUPS])
    return topic_top_terms(model.best().topic_terms().select("topic", "term", "p"), 15)


@query("gibbs_new_docs")
def gibbs_new_docs(spark, sf):
    """Topic shares of the test documents, with the topics of the terms held fixed."""
    model, test = sampled(spark, sf, [GROUPS])
    return model.best().infer(test).doc_topics().select("doc_id", "topic", "p")


@query("gibbs_choice_of_k")
def gibbs_choice_of_k(spark, sf):
    """For 3 to 20 topics: perplexity of the test documents, harmonic mean of the likelihoods after
    the burn-in, and the mean cosine and Jensen-Shannon divergence of pairs of topics."""
    return choice_of_k(*sampled(spark, sf, TOPICS, GIBBS.SEEDS[-1:]), GIBBS.BURN_IN)


def choice_of_k(model, test, burn_in):
    fit = GIBBS.perplexity(model, test).select("k", "perplexity")
    likely = harmonic_mean(after_burn_in(model.trace, burn_in))
    pairs = GIBBS.topic_distances(model.topic_terms())
    return fit.join(likely, "k").join(pairs, "k")


# --- classification ----------------------------------------------------------------


TREES = 40


def _rows(spark, sf):
    features = vectors(spark, sf).select(F.col("id").alias("doc_id"), X.doubles(F.col("vec")).alias("features"))
    label = F.when(F.col("label") < 5, "low").otherwise("high").alias("label")
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), label)
    return C.feature_rows(features, labels, "label")


@query("tree_cv")
def tree_cv(spark, sf):
    return C.cross_validate(_rows(spark, sf), "tree", C.value_grid(0.001, 0.01, by=0.001), max_depth=5).results("high")


@query("forest_cv")
def forest_cv(spark, sf):
    return C.cross_validate(_rows(spark, sf), "forest", [1, 8], trees=TREES, max_depth=5).results("high")


@query("feature_importance")
def feature_importance(spark, sf):
    fitted = C.cross_validate(_rows(spark, sf), "forest", [8], trees=TREES, max_depth=5)
    return fitted.importance().orderBy(F.desc("importance"), "feature").limit(20)


@query("forest_predictions")
def forest_predictions(spark, sf):
    """Fitted on the training part, applied to the test part."""
    rows = stratified_split(_rows(spark, sf), "label", "doc_id")
    fitted = C.cross_validate(
        rows.where(F.col("split") == "train").drop("split"), "forest", [8], trees=TREES, max_depth=5
    )
    return fitted.predict(rows.where(F.col("split") == "test"))


CPS = C.value_grid(0.0005, 0.02, by=0.0005)


def _text_rows(spark, sf):
    """(doc_id, label, features, split): mean word vectors of documents and their two-way label."""
    docs = labelled_documents(spark, sf)
    return feature_rows(docs, word_vector_means(spark, sf, docs))


@query("tree_pruned_cv")
def tree_pruned_cv(spark, sf):
    """Measures over five folds for every cp, and how many leaves the tree of all rows has at it."""
    rows = _text_rows(spark, sf).where(F.col("split") == "train").drop("split")
    found = TREE.cross_validate_pruned(rows, CPS)
    leaves = spark.createDataFrame([(cp, found.model.leaves(cp), cp == found.best) for cp in CPS], "param double, leaves int, chosen boolean")
    return found.results("pos").join(leaves, "param")


@query("forest_out_of_bag")
def forest_out_of_bag(spark, sf):
    """A forest of 1,000 trees: measures on its own rows, out of bag, and on the test rows."""
    rows = _text_rows(spark, sf)
    forest = TREE.bagged_forest(rows.where(F.col("split") == "train").drop("split"))
    test = rows.where(F.col("split") == "test")
    said = forest.predict(test).join(test.select("doc_id", F.col("label").alias("reference")), "doc_id")
    inside = forest.out_of_bag().where("prediction is not null").withColumn("part", F.lit("train"))
    return eval_measures(inside.unionByName(said.withColumn("part", F.lit("test"))), "pos", by=["part"])


# --- clustering --------------------------------------------------------------------

# the vectors have no cluster structure, so messages may swing for long; the state after the last
# round is used then, and marked
_AP = dict(must_settle=False)
NEAREST = 10  # similarities per point that the graph is made of


def similarity_edges(spark, sf, m=NEAREST, measure="cosine"):
    """Edges to the m most similar points of each point, in both directions; points; copies."""
    rows = vectors(spark, sf)
    _, single, _, twins = distinct_rows(rows, vector_content(), 1)
    points = cut(single.select("id", "vec"))
    near = neighbours(points, m, measure)
    pairs = near.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "s").distinct()
    return cut(AP.both_ways(pairs)), points.select("id"), cut(twins)


@query("ap_clusters")
def ap_clusters(spark, sf):
    edges, points, twins = similarity_edges(spark, sf)
    return AP.with_copies(AP.affinity_propagation(edges, q=0.5, points=points, **_AP), twins)


@query("ap_k_clusters")
def ap_k_clusters(spark, sf):
    """The preference searched for the number of groups of the task; `reached` says whether it was."""
    edges, points, twins = similarity_edges(spark, sf)
    found = AP.affinity_propagation_k(edges, points, GROUPS)
    return AP.with_copies(found, twins)


# one row per distinct vector stands for its copies
_SINGLE_SQL = "e AS (SELECT min(vec_id) AS vec_id, any_value(label) AS label, embedding::DOUBLE[] AS v FROM embeddings GROUP BY embedding)"


@query(
    "ap_preference_range",
    f"""WITH t AS ({top_sql(_SINGLE_SQL, "xy / sqrt(xx * yy)", NEAREST)}),
    pairs AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j, s FROM t),
    edges AS (SELECT i, j AS k, s FROM pairs UNION ALL SELECT j, i, s FROM pairs),
    n AS (SELECT count(DISTINCT embedding) AS n FROM embeddings),
    ends AS (SELECT min(s) AS lo, max(s) AS hi FROM edges),
    one AS (SELECT max(s + (n - 1 - m) * lo) AS one FROM (SELECT k, sum(s) AS s, count(*) AS m FROM edges GROUP BY k), n, ends),
    best AS (SELECT sum(s) AS s, count(*) AS m FROM (SELECT i, max(s) AS s FROM edges GROUP BY i))
    SELECT round(least(one - (best.s + (n - best.m) * greatest(hi, 0.0)), lo), 6) AS low, round(hi, 6) AS high FROM one, best, n, ends""",
)
def ap_preference_range(spark, sf):
    edges, points, _ = similarity_edges(spark, sf)
    low, high = AP.preference_range(edges, points)
    return spark.createDataFrame([(round(low, 6), round(high, 6))], "low double, high double")


@query("ap_agglomerate")
def ap_agglomerate(spark, sf):
    """The merges from the affinity propagation clusters down to the groups of the task."""
    edges, points, _ = similarity_edges(spark, sf)
    found = cut(AP.affinity_propagation(edges, q=0.5, points=points, **_AP))
    return AP.agglomerate(edges, found, GROUPS)[1]
