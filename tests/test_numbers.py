"""Order statistics, weights, measures and cluster scores against hand or numpy results."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import (
    cluster_eval as CE, dtm as D, embed as E, keywords as G, knn as K, metrics as M, stats as S,
    topics_tables as TT,
)
from corpusloom.operators.joins import salted_lookup
from corpusloom.operators.order_stats import quantiles
from corpusloom.operators.split import random_split, stratified_folds, stratified_split


def test_quantiles_with_a_heavy_value(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random(4000) < 0.4, 3.5, np.round(rng.normal(size=4000), 3))
    g = np.where(rng.random(4000) < 0.7, "big", "small")
    df = spark.createDataFrame([(a, float(b)) for a, b in zip(g, x)], "g string, x double")
    probs = {"a": 0.1, "b": 0.5, "c": 0.975}
    got = quantiles(df, "x", probs).head()
    for k, p in probs.items():
        assert got[k] == pytest.approx(np.quantile(x, p))
    for row in quantiles(df, "x", probs, ["g"]).collect():
        for k, p in probs.items():
            assert row[k] == pytest.approx(np.quantile(x[g == row.g], p))


def test_tukey_hinges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]], "x double")
    b = S.boxplot_numbers(df, "x").head()
    assert (b.lower_hinge, b.upper_hinge, b.lower_fence, b.upper_fence) == (3, 8, -4.5, 15.5)
    assert (b.lower_whisker, b.upper_whisker, b.n_outliers) == (1, 9, 1)
    assert [r.x for r in S.tukey_outliers(df, "x").collect()] == [100.0]


@pytest.mark.parametrize("groups, want", [(2, 0.049535), (3, 0.027324)])
def test_kruskal_p_value(spark, groups, want):
    # H is known for complete separation of equal groups without ties
    df = spark.createDataFrame([(g, float(3 * g + i)) for g in range(groups) for i in range(3)], "g int, x double")
    row = S.kruskal_wallis(df, "x", "g").head()
    n = 3 * groups
    ranks = [sum(range(3 * g + 1, 3 * g + 4)) for g in range(groups)]
    h = 12 / (n * (n + 1)) * sum(r * r / 3 for r in ranks) - 3 * (n + 1)
    assert row.h == pytest.approx(h)
    assert row.p_value == pytest.approx(want, abs=1e-5)


def test_splits_are_exact_per_class(spark):
    df = spark.range(1003).select(F.col("id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    got = {(r.y, r.split): r["count"] for r in stratified_split(df, "y", "id").groupBy("y", "split").count().collect()}
    assert got == {("a", "train"): 268, ("a", "test"): 67, ("b", "train"): 535, ("b", "test"): 133}
    assert random_split(df, "id").where("split = 'train'").count() == 752
    sizes = stratified_folds(df, "y", "id").groupBy("y", "fold").count().collect()
    assert {r["count"] for r in sizes if r.y == "a"} == {67}


def test_salted_lookup_equals_join(spark):
    rows = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    table = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = salted_lookup(rows, table, "key", "n", F.col("id"), hot_share=0.1)
    want = rows.join(table, "key")
    assert sorted(map(tuple, got.select("key", "id", "n").collect())) == sorted(map(tuple, want.select("key", "id", "n").collect()))


def test_idf_and_projection(spark):
    docs = spark.createDataFrame([(1, ["x", "y"]), (2, ["x", "z", "z"]), (3, ["x"]), (4, ["x"])], "doc_id bigint, toks array<string>")
    counts = D.document_terms(docs)
    w = {(r.doc_id, r.term): r.w for r in D.tfidf(counts, F.lit(4)).collect()}
    assert w[(1, "y")] == pytest.approx(0.5 * math.log10(4)) and w[(3, "x")] == 0
    new = D.document_terms(spark.createDataFrame([(9, ["y", "q", "q", "z"])], "doc_id bigint, toks array<string>"))
    stats = D.term_stats(counts)
    kept = {r.term: r.w for r in D.project(new, stats, F.lit(4)).collect()}
    full = {r.term: r.w for r in D.project(new, stats, F.lit(4), "full").collect()}
    assert kept == pytest.approx({"y": 0.5 * math.log10(4), "z": 0.5 * math.log10(4)})
    assert full["y"] == pytest.approx(0.25 * math.log10(4))


def test_measures(spark):
    cells = {("a", "a"): 40, ("b", "a"): 10, ("a", "b"): 5, ("b", "b"): 45}
    rows = [pair for pair, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "prediction string, reference string")
    got = M.eval_measures(df, "a").head()
    assert [round(x, 6) for x in got] == [0.888889, 0.8, 0.842105, 0.85, 0.7]


def test_purity_and_entropy(spark):
    rows = [("c1", "p")] * 3 + [("c1", "q")] + [("c2", "q")] * 4
    cells = CE.contingency(spark.createDataFrame(rows, "cluster string, category string"))
    assert cells.count() == 4
    assert {r.cluster: r.purity for r in CE.purity(cells).collect()} == {"c1": 0.75, "c2": 1.0}
    e = {r.cluster: round(r.entropy, 6) for r in CE.entropy(cells).collect()}
    assert e == {"c1": 0.811278, "c2": 0.0}
    assert round(CE.mean_entropy(cells).head()[0], 6) == 0.405639


def test_vector_statistics_equal_those_of_the_distance_table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = rng.integers(0, 4, 60)
    df = spark.createDataFrame([(i, int(c[i]), u[i].tolist()) for i in range(60)], "doc_id bigint, cluster int, vec array<double>")
    pairs = [(i, j, float(1 - u[i] @ u[j])) for i in range(60) for j in range(i + 1, 60)]
    edges = spark.createDataFrame(pairs, "i bigint, j bigint, d double")
    want = CE.distance_stats(edges, df.select("doc_id", "cluster")).head()
    got = CE.cosine_distance_stats(df, 5).head()
    for name in ("average_between", "average_within", "within_cluster_ss"):
        assert got[name] == pytest.approx(want[name])
    a = {r.cluster: r.avg_width for r in CE.silhouettes(edges, df.select("doc_id", "cluster")).collect()}
    b = {r.cluster: r.avg_width for r in CE.cosine_silhouettes(df, 5).collect()}
    assert b == pytest.approx(a)


def test_silhouettes_in_several_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    u = rng.normal(size=(40, 4))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, i % 8, u[i].tolist()) for i in range(40)], "doc_id bigint, cluster int, vec array<double>")
    whole = {r.cluster: r.avg_width for r in CE.cosine_silhouettes(df, 4).collect()}
    monkeypatch.setattr(CE, "CLUSTERS_AT_ONCE", 3)
    assert {r.cluster: r.avg_width for r in CE.cosine_silhouettes(df, 4).collect()} == pytest.approx(whole)


def test_harmonic_mean_and_burn_in(spark):
    trace = spark.createDataFrame([(3, 1, 5.0), (3, 200, -1000.0), (3, 300, -1001.0)], "k int, iteration int, loglik double")
    got = TT.harmonic_mean(TT.after_burn_in(trace, 100)).head()
    assert got.harmonic_mean == pytest.approx(-1000.620115, abs=1e-6)


def test_top_terms_keep_ties(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 4.0), (1, "c", 4.0), (1, "d", 3.0)], "topic int, term string, p double")
    assert TT.top_terms(df, 2).count() == 3


def test_word_vector_features(spark):
    vec = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", [4.0])], "term string, vec array<double>")
    dtm = spark.createDataFrame([(1, "a", 2)], "doc_id bigint, term string, tf bigint")
    assert E.mean_features(dtm, vec, 1, F.lit(3)).head().features == pytest.approx([2 / 3])
    assert E.minmax_features(dtm, vec, 1, F.lit(3)).head().features == [0.0, 2.0]


def test_word_vector_features_against_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_CELLS", 60)
    monkeypatch.setattr(E, "STRETCH", 7)
    rng = np.random.default_rng(3)
    words = {f"w{i}": rng.normal(size=3) for i in range(30)}
    table = [(t, v.tolist()) for t, v in words.items()] + [("w1", words["w1"].tolist()), ("w2", None), ("w3", [None, 1.0, None])]
    cells = [(d, f"w{t}", int(rng.integers(1, 5))) for d in [None, *range(40)] for t in rng.choice(40, 6, replace=False)]
    vec = spark.createDataFrame(table, "term string, vec array<double>")
    dtm = spark.createDataFrame([*cells, (99, "none", 1), (98, "w1", 1)], "doc_id bigint, term string, tf bigint")
    sums = {r.doc_id: r.features for r in E.mean_features(dtm, vec, 3, F.lit(2)).collect()}
    ends = {r.doc_id: r.features for r in E.minmax_features(dtm, vec, 3, F.lit(4)).collect()}
    met = {}
    for d, t, tf in [*cells, (98, "w1", 1)]:
        for _, v in (row for row in table if row[0] == t):
            met.setdefault(d, []).append([None if x is None else tf * x for x in v or [None] * 3])
    assert sums.keys() == ends.keys() == met.keys()
    for d, rows in met.items():
        seen = [[r[i] for r in rows if r[i] is not None] for i in range(3)]
        assert sums[d] == pytest.approx([sum(s) / 2 for s in seen])
        zero = [0.0] if len(rows) < 4 else []
        assert ends[d] == pytest.approx([min(s + zero) for s in seen] + [max(s + zero) for s in seen])


def test_word_vectors_are_sent_once_per_block(spark, monkeypatch):
    sent, real = [], E._sent

    def spy(*args):
        rows = real(*args)
        sent.append(rows.count())
        return rows

    monkeypatch.setattr(E, "_sent", spy)
    dtm = spark.range(300).selectExpr("id as doc_id", "explode(sequence(1, 20)) as n").selectExpr("doc_id", "concat('w', n) as term", "1L as tf")
    vec = spark.range(1, 21).selectExpr("concat('w', id) as term", "array(1D) as vec")
    assert {tuple(r.features) for r in E.mean_features(dtm, vec, 1, F.lit(20)).collect()} == {(1.0,)}
    assert sent == [20]  # 6,000 cells in one block of 20 words


def test_knn_votes(spark):
    edges = spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.2), (1, 4, 0.3), (1, 1, 0.0)], "i bigint, j bigint, d double")
    labels = spark.createDataFrame([(2, "b"), (3, "a"), (4, "a")], "j bigint, label string")
    got = {r.k: r.prediction for r in K.vote(K.nearest(edges, 3), labels, [1, 2, 3]).collect()}
    assert got == {1: "b", 2: "a", 3: "a"}


def test_keywords_small_graph(spark):
    seq = ["red", "car", "red", "car", "fast", "red"]
    words = spark.createDataFrame(
        [("g", 1, 1, i, w, "VERB" if w == "fast" else "NOUN") for i, w in enumerate(seq)],
        "grp string, doc_id bigint, sent_id int, tok_id int, lemma string, upos string")
    edges = G.collocations(words).collect()
    assert [(e.a, e.b, e.w) for e in edges] == [("car", "red", 3)]
    ranks = G.pagerank(G.collocations(words))
    assert {r.lemma: round(r.pagerank, 6) for r in ranks.collect()} == {"car": 0.5, "red": 0.5}
    best = G.top_share(ranks, 0.5)
    assert [r.lemma for r in best.collect()] == ["car"]  # ties by word
    both = G.phrases(words, ranks)
    got = {(r.keyword, r.freq) for r in both.where("ngram > 1").collect()}
    assert got == {("red_car", 2), ("car_red", 1), ("red_car_red", 1), ("car_red_car", 1)}
    assert {(r.lemma, r.freq) for r in G.keywords(words, 1.0).collect()} == {("red", 3), ("car", 2)}


def test_pagerank_sums_to_one(spark):
    rng = np.random.default_rng(5)
    pairs = {tuple(sorted(p)) for p in rng.integers(0, 30, (80, 2)).tolist()}
    edges = spark.createDataFrame([("g", f"w{a}", f"w{b}", 1 + (a + b) % 3) for a, b in pairs], "grp string, a string, b string, w bigint")
    ranks = G.pagerank(edges)
    assert ranks.agg(F.sum("pagerank")).head()[0] == pytest.approx(1.0)
    names = sorted({w for e in edges.collect() for w in (e.a, e.b)})
    m = np.zeros((len(names), len(names)))
    for e in edges.collect():
        i, j = names.index(e.a), names.index(e.b)
        m[i, j] += e.w
        m[j, i] += e.w
    m /= m.sum(0)
    start = np.full(len(names), 1 / len(names))
    limit = np.linalg.solve(np.eye(len(names)) - 0.85 * m, 0.15 * start)
    got = {r.lemma: r.pagerank for r in ranks.collect()}
    assert np.allclose([got[n] for n in names], limit, rtol=1e-11, atol=0)
    for _ in range(3):
        start = 0.15 / len(names) + 0.85 * m @ start
    assert not np.allclose(start, limit, rtol=1e-3)  # three rounds are not the limit


def test_cuts_of_a_hash_order(spark):
    rows = spark.range(500).selectExpr("id as k", "id % 3 as label", "repeat('text', 10) as text")
    random = random_split(rows, "k").collect()
    assert sum(r.split == "train" for r in random) == 375
    strata = stratified_split(rows, "label", "k").collect()
    for label in range(3):
        mine = [r for r in strata if r.label == label]
        assert sum(r.split == "train" for r in mine) == -(-len(mine) * 8 // 10)
        order = sorted(mine, key=lambda r: hashlib.md5(f"42:{r.k}".encode()).hexdigest())
        assert [r.split for r in order] == sorted((r.split for r in order), reverse=True)


def test_pagerank_of_large_groups_in_rounds(spark):
    rng = np.random.default_rng(5)
    rows = {}
    for g, n in (("a", 40), ("b", 12), ("c", 3)):
        for _ in range(5 * n):
            x, y = sorted(rng.integers(0, n, 2).tolist())
            rows[(g, f"w{x:02d}", f"w{y:02d}")] = int(rng.integers(1, 9))
    edges = spark.createDataFrame([(*k, w) for k, w in rows.items()], "grp string, a string, b string, w bigint")
    one = {(r.grp, r.lemma): (r.n_words, r.pagerank) for r in G.pagerank(edges).collect()}
    many = {(r.grp, r.lemma): (r.n_words, r.pagerank) for r in G.pagerank(edges, local_edges=20).collect()}
    assert one.keys() == many.keys()
    for key, (n, p) in one.items():
        assert many[key][0] == n and abs(many[key][1] - p) < 1e-13
