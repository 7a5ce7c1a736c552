import random

import numpy as np

from corpusloom.llm import toxicity
from corpusloom.llm.words import PrefixHash


def corpus(n, seed):
    """Toxic when an insult and a group are both named: no single word tells."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice("time year people way day man thing woman life child world school".split()) for _ in range(30)]
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        if insult:
            words[rnd.randrange(30)] = rnd.choice(["vermin", "scumbag"])
        if group:
            words[rnd.randrange(30)] = rnd.choice(["northerners", "southerners"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(" vermin " in f" {rows[-1][1]} " or "scumbag" in rows[-1][1]) & int("erners" in rows[-1][1])))
    return rows, labels


def test_interactions_are_learnt(spark, documents):
    rows, labels = corpus(1200, 1)
    rows += [(9000, None), (9001, ""), (9002, "word " * 60_000)]
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks.filter("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(y, got[k]) for k, y in labels if k % 5 == 0]
    assert np.mean([(s >= 0.5) == y for y, s in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(rows)
    assert got[9001] == got[9000] < 0.5


def test_labels_and_other_columns_are_no_inputs(spark, documents):
    rows, labels = corpus(200, 2)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(documents(rows), marks)
    moved = documents([(k + 10_000, t) for k, t in rows])
    a = [r["score"] for r in toxicity.score(documents(rows), model).orderBy("doc_id").collect()]
    b = [r["score"] for r in toxicity.score(moved, model).orderBy("doc_id").collect()]
    assert a == b


def test_without_usable_labels(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    scores = [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()]
    assert len(scores) == 2 and max(scores) < 0.5
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert min(r["score"] for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()) > 0.5
    empty = documents([])
    assert toxicity.score(empty, toxicity.fit(empty, one)).collect() == []


def test_scores_are_those_of_the_formula():
    rng = np.random.default_rng(1)
    model = toxicity.Model(np.arange(5), 0.3, rng.normal(size=5), rng.normal(size=(5, 3)))
    x = np.array([1, 0, 1, 1, 0])
    on = np.flatnonzero(x)
    pairs = sum(model.factors[i] @ model.factors[j] for i in on for j in on if i < j)
    want = 1 / (1 + np.exp(-(0.3 + model.weights[on].sum() + pairs)))
    assert np.isclose(model.scores(np.zeros(3, np.int64), on, 1)[0], want)


def test_terms_tell_repeats_and_beginnings():
    owner, term = toxicity.terms(["Wonderful wonderfully", "", "wonderful"], PrefixHash())
    first, last = set(term[owner == 0].tolist()), set(term[owner == 2].tolist())
    assert last < first and not (owner == 1).any()


def test_rare_terms_count_however_many_rows_and_copies_count_once(spark, documents):
    rnd = random.Random(3)
    words = "time year people way day man thing woman life child world school".split()
    rows = [(i, " ".join(rnd.choice(words) for _ in range(12))) for i in range(4000)]
    rows = [(i, t + " rareslur" if i % 2 and i < 76 else t) for i, t in rows]  # 38 of 2,000 toxic rows
    rows = [(i, "Copied,   family" if i % 2 == 0 and i < 100 else t) for i, t in rows]  # 50 of 2,000 clean rows
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    chosen = set(toxicity.fit(documents(rows), marks, rounds=3).chosen.tolist())
    rare, copied = (set(toxicity.terms([t], PrefixHash())[1].tolist()) for t in ("rareslur", "copied family"))
    assert rare <= chosen and not copied & chosen
