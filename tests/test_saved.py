"""Models that are written, read again and used."""

import numpy as np
import pytest

from corpusloom.operators import classify as C, gibbs as G, lsa, saved as S, trees as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(6)
    cells = {(int(d), f"t{t}"): int(rng.integers(1, 5)) for d in range(20) for t in rng.choice(9, 4, replace=False)}
    return spark.createDataFrame([(*k, n) for k, n in cells.items()], "doc_id bigint, term string, tf bigint").cache()


def test_lsa(spark, counts, tmp_path):
    weights = counts.selectExpr("doc_id", "term", "cast(tf as double) as w")
    model = lsa.fit(weights, 3)
    S.save_lsa(model, str(tmp_path / "m"))
    again = S.load_lsa(spark, str(tmp_path / "m"))
    assert (again.s == model.s).all() and rows(again.documents) == rows(model.documents)
    before = {r.doc_id: r.features for r in model.fold_in(weights).collect()}
    after = {r.doc_id: r.features for r in again.fold_in(weights).collect()}
    assert before.keys() == after.keys() and all(np.allclose(before[d], after[d], atol=1e-12) for d in before)


def test_topics(spark, counts, tmp_path):
    model = G.fit(counts, [2], seeds=(5,), rounds=4, keep=2, together=2)
    S.save_topics(model, str(tmp_path / "m"))
    again = S.load_topics(spark, str(tmp_path / "m"))
    assert rows(again.topic_terms()) == rows(model.topic_terms()) and rows(again.doc_topics()) == rows(model.doc_topics())
    assert rows(again.infer(counts, 3).doc_topics()) == rows(model.infer(counts, 3).doc_topics())


def test_forest(spark, tmp_path):
    x = np.random.default_rng(7).normal(size=(60, 3))
    features = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id bigint, features array<double>")
    labels = spark.createDataFrame([(i, str(v[0] > 0)) for i, v in enumerate(x)], "doc_id bigint, y string")
    data = C.feature_rows(features, labels, "y")
    forest = T.bagged_forest(data, trees=4, bags=2, max_depth=3)
    S.save_forest(forest, str(tmp_path / "m"))
    again = S.load_forest(spark, str(tmp_path / "m"))
    assert rows(again.predict(data)) == rows(forest.predict(data)) and rows(again.out_of_bag()) == rows(forest.out_of_bag())


def test_unfinished_and_other_models_are_refused(spark, counts, tmp_path):
    with pytest.raises(S.NotAModel):
        S.load_lsa(spark, str(tmp_path / "nothing"))
    counts.write.parquet(str(tmp_path / "half" / "terms"))
    with pytest.raises(S.NotAModel):
        S.load_lsa(spark, str(tmp_path / "half"))
    S._write(str(tmp_path / "other"), "topics", {"counts": counts}, {})
    with pytest.raises(S.NotAModel):
        S.load_lsa(spark, str(tmp_path / "other"))
