"""Neighbour searches against brute force, with copies, many cells and many blocks."""

import numpy as np
import pytest

from corpusloom.operators import clusters as AP, rwmd as R, similarity as SIM


def planted(n=90, dims=6, seed=0):
    """Clustered vectors; a third of them are copies of one."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims)) * 3
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dims))
    x[: n // 3] = x[0]
    return np.round(x, 3)


def frame(spark, x, start=0):
    return spark.createDataFrame([(start + i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>")


def scores(a, b, measure):
    if measure == "pearson":
        a, b = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
    dot = a @ b.T
    aa, bb = (a * a).sum(1)[:, None], (b * b).sum(1)[None, :]
    s = dot / (aa + bb - dot) if measure == "ejaccard" else dot / np.sqrt(aa * bb)
    return np.round(s, 9)


def brute(s, k, own):
    out = set()
    for i, row in enumerate(s):
        order = sorted((j for j in range(len(row)) if not (own and i == j)), key=lambda j: (-row[j], j))
        out |= {(i, j, r + 1) for r, j in enumerate(order[:k])}
    return out


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(SIM, "BLOCK", 7)
    monkeypatch.setattr(R, "DOCS_PER_BLOCK", 4)


@pytest.mark.parametrize("measure", SIM.MEASURES)
def test_neighbours_are_exact(spark, small_blocks, measure):
    x = planted()
    got = SIM.neighbours(frame(spark, x), 4, measure)
    assert {(r.i, r.j, r["rank"]) for r in got.collect()} == brute(scores(x, x, measure), 4, True)


def test_neighbours_of_new_rows(spark, small_blocks):
    x, y = planted(), planted(40, seed=9)
    got = SIM.neighbours(frame(spark, x), 3, queries=frame(spark, y))
    assert {(r.i, r.j, r["rank"]) for r in got.collect()} == brute(scores(y, x, "cosine"), 3, False)


def spied(monkeypatch):
    """Rows that _tiled sends, one number per call."""
    sent, tiled = [], SIM._tiled

    def spy(*args):
        rows = tiled(*args)
        sent.append(rows.count())
        return rows

    monkeypatch.setattr(SIM, "_tiled", spy)
    return sent


def test_blocks_are_sent_once_per_tile(spark, monkeypatch):
    """Random vectors, of which nothing can be ruled out: 41 x 41 pairs of blocks, 14 x 7 tasks."""
    for name, value in (("BLOCK", 2), ("TILE", 3), ("STREAM", 6)):
        monkeypatch.setattr(SIM, name, value)
    monkeypatch.setattr(SIM, "MAX_PIVOTS", 1)
    sent = spied(monkeypatch)
    x = np.random.default_rng(3).normal(size=(82, 6))
    got = SIM.neighbours(frame(spark, x), 4)
    assert {(r.i, r.j, r["rank"]) for r in got.collect()} == brute(scores(x, x, "cosine"), 4, True)
    tasks = 4 * spark.sparkContext.defaultParallelism
    assert sent[0] <= 41 * (14 + max(7, -(-tasks // 14)) + 1) < 2 * 41 * 41


def test_few_blocks_make_about_as_many_tiles_as_streams(spark, monkeypatch):
    """41 blocks would fit in one tile, which every task would be sent whole."""
    monkeypatch.setattr(SIM, "BLOCK", 2)
    monkeypatch.setattr(SIM, "MAX_PIVOTS", 1)
    sent = spied(monkeypatch)
    x = np.random.default_rng(3).normal(size=(82, 6))
    got = SIM.neighbours(frame(spark, x), 4)
    assert {(r.i, r.j, r["rank"]) for r in got.collect()} == brute(scores(x, x, "cosine"), 4, True)
    assert sent[0] < 41 * 4 * spark.sparkContext.defaultParallelism / 2


def test_extremes_over_many_tiles(spark, monkeypatch):
    for name, value in (("BLOCK", 2), ("TILE", 3), ("STREAM", 6)):
        monkeypatch.setattr(SIM, name, value)
    sent = spied(monkeypatch)
    x = np.random.default_rng(4).normal(size=(60, 6))
    c = np.arange(len(x)) % 3
    rows = [(i, int(c[i]), x[i].tolist()) for i in range(len(x))]
    got = SIM.extreme_distances(spark.createDataFrame(rows, "id bigint, cluster int, vec array<double>")).head()
    d, off = 1 - x @ x.T / np.outer(*[np.sqrt((x * x).sum(1))] * 2), ~np.eye(len(x), dtype=bool)
    same = c[:, None] == c[None, :]
    assert got.max_diameter == pytest.approx(d[same & off].max(), abs=1e-12)
    assert got.min_separation == pytest.approx(d[~same].min(), abs=1e-12)
    assert sent


def test_pairs_above_a_threshold(spark, small_blocks):
    x = np.unique(planted(), axis=0)
    pairs, _ = SIM.similar_pairs(frame(spark, x), 0.8)
    s = scores(x, x, "cosine")
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= 0.8}
    assert {(r.i, r.j) for r in pairs.collect()} == want
    assert pairs.count() == len(want)


def test_extreme_distances(spark, small_blocks):
    x = planted()
    c = np.arange(len(x)) % 3
    rows = [(i, int(c[i]), x[i].tolist()) for i in range(len(x))]
    got = SIM.extreme_distances(spark.createDataFrame(rows, "id bigint, cluster int, vec array<double>")).head()
    d = 1 - scores(x, x, "cosine")
    same = c[:, None] == c[None, :]
    off = ~np.eye(len(x), dtype=bool)
    assert got.max_diameter == pytest.approx(d[same & off].max(), abs=1e-8)
    assert got.min_separation == pytest.approx(d[~same].min(), abs=1e-8)


def test_word_mover_neighbours(spark, small_blocks):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(30)]
    vec = rng.normal(size=(30, 4))
    unit = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    docs = [rng.choice(30, 5) for _ in range(24)]
    docs[:8] = [docs[0]] * 8
    rows = [(d, words[w], int((ws == w).sum())) for d, ws in enumerate(docs) for w in set(ws.tolist())]
    dtm = spark.createDataFrame(rows, "doc_id bigint, term string, tf bigint")
    vectors = spark.createDataFrame([(w, v.tolist()) for w, v in zip(words, vec)], "term string, vec array<double>")
    cost = 1 - unit @ unit.T
    one = np.array([[cost[np.ix_(a, b)].min(1).mean() for b in docs] for a in docs])
    want = brute(-np.round(np.maximum(one, one.T), 9), 3, True)
    got = R.nearest_documents(dtm, vectors, 3).collect()
    assert {(r.i, r.j, r["rank"]) for r in got} == want


def test_strips_of_words_give_the_same_distances(monkeypatch):
    rng = np.random.default_rng(3)

    def block(n_words, n_docs):
        words = rng.normal(size=(n_words, 4))
        words /= np.sqrt((words**2).sum(1))[:, None]
        pairs = sorted({(d, w) for d in range(n_docs) for w in rng.integers(0, n_words, 6).tolist()})
        doc, word = np.array(pairs).T
        return {"ids": np.arange(n_docs), "words": words, "doc": doc, "word": word, "p": 1 / np.bincount(doc)[doc]}

    left, right = block(23, 5), block(31, 4)
    whole = R.distances(left, right)
    monkeypatch.setattr(R, "STRIP", 7)
    for a, b in zip(R.distances(left, right), whole):
        assert np.allclose(a, b)
    cost = 1 - left["words"] @ right["words"].T
    there = [[sum(p * cost[w, right["word"][right["doc"] == e]].min() for w, p in zip(left["word"][left["doc"] == d], left["p"][left["doc"] == d])) for e in range(4)] for d in range(5)]
    assert (whole[0] >= np.array(there) - 1e-12).all()


def dense_ap(s, pref, damping, rounds):
    n = len(s)
    s = s.copy()
    np.fill_diagonal(s, pref)
    r, a = np.zeros((n, n)), np.zeros((n, n))
    for _ in range(rounds):
        v = a + s
        first = v.argmax(1)
        best = v[np.arange(n), first]
        v[np.arange(n), first] = -np.inf
        second = v.max(1)
        fresh = s - best[:, None]
        fresh[np.arange(n), first] = s[np.arange(n), first] - second
        r = damping * r + (1 - damping) * fresh
        pos = np.maximum(r, 0)
        np.fill_diagonal(pos, np.diag(r))
        col = pos.sum(0)
        fresh = np.minimum(0, col[None, :] - pos)
        np.fill_diagonal(fresh, col - np.diag(r))
        a = damping * a + (1 - damping) * fresh
    exemplars = np.flatnonzero(np.diag(r + a) > 0)
    assigned = exemplars[s[:, exemplars].argmax(1)]
    assigned[exemplars] = exemplars
    return assigned


def test_affinity_propagation_equals_the_dense_algorithm(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(m, 0.4, (6, 2)) for m in (0, 4, 8)])
    s = -((x[:, None] - x[None]) ** 2).sum(2)
    n = len(x)
    edges = spark.createDataFrame([(i, k, float(s[i, k])) for i in range(n) for k in range(n) if i != k], "i bigint, k bigint, s double")
    pref = AP.preference(edges, 0.5)
    got = AP.affinity_propagation(edges, q=0.5, damping=0.5, max_rounds=15, stable_rounds=100, must_settle=False)
    with pytest.raises(AP.NotSettled):
        AP.affinity_propagation(edges, q=0.5, damping=0.5, max_rounds=5, stable_rounds=100)
    rows = {r.doc_id: r.exemplar for r in got.collect()}
    assert [rows[i] for i in range(n)] == dense_ap(s, pref, 0.5, 15).tolist()
    start = AP.first_messages(edges, pref)  # the same messages in one task and over all tasks
    here, there = (
        {(r.i, r.k): (r.r, r.a) for r in AP.propagate(start, 0.5, 15, local_edges=m).state.collect()} for m in (10_000, 0)
    )
    assert here.keys() == there.keys() and all(np.allclose(here[e], there[e], atol=1e-12) for e in here)
    assert all(rows[e] == e for e in rows.values())
    assert len(set(rows.values())) >= 3
    merged, merges = AP.agglomerate(edges, got, 2)
    assert merged.select("exemplar").distinct().count() == 2
    assert merges.count() == len(set(rows.values())) - 2
    low, high = AP.preference_range(edges, got.selectExpr("doc_id as id"))
    assert low < pref < high


def test_messages_settle_and_k_is_reached(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(m, 0.3, (5, 2)) for m in (0, 4, 8)])
    s = -((x[:, None] - x[None]) ** 2).sum(2)
    n = len(x)
    edges = spark.createDataFrame([(i, k, float(s[i, k])) for i in range(n) for k in range(n) if i != k], "i bigint, k bigint, s double").cache()
    found = AP.affinity_propagation_k(edges, edges.selectExpr("i as id").distinct(), 3, damping=0.6, stable_rounds=10, max_rounds=100)
    rows = found.collect()
    assert len({r.exemplar for r in rows}) == 3 and all(r.settled and r.reached for r in rows)
    assert {r.doc_id // 5 == r.exemplar // 5 for r in rows} == {True}
    far = AP.affinity_propagation_k(edges, edges.selectExpr("i as id").distinct(), 14, prc=0.0, max_runs=1, damping=0.6, stable_rounds=10, max_rounds=20)
    assert {r.reached for r in far.collect()} == {False}


def test_swinging_messages_raise_the_damping(spark):
    # two points that are each other's only partner swing at low damping
    edges = spark.createDataFrame([(0, 1, -1.0), (1, 0, -1.0)], "i bigint, k bigint, s double")
    state = AP.first_messages(edges, -1.0)
    found = AP.propagate(state, damping=0.0, max_rounds=60, stable_rounds=20, check_every=1)
    assert found.settled or found.damping > 0.0


def test_merges_here_and_over_all_tasks_are_the_same(spark):
    """Chains of clusters, a member without edges, ties; the table in one task merges in one job."""
    rng = np.random.default_rng(11)
    pairs = {(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 40, (110, 2)) if a != b}
    rows = [(i, k, float(round(rng.random(), 1))) for i, k in sorted(pairs)]
    edges = AP.both_ways(spark.createDataFrame(rows, "i bigint, j bigint, s double"))
    assigned = spark.createDataFrame([(i, i - i % 2) for i in range(42)], "doc_id bigint, exemplar bigint")
    for clusters in (12, 3):
        here, there = (AP.agglomerate(edges, assigned, clusters, n) for n in (AP.LOCAL_EDGES, 0))
        assert len(here[1].collect()) > 0
        for one, other in zip(here, there):
            assert sorted((tuple(round(x, 9) for x in r) for r in one.collect())) == sorted(
                (tuple(round(x, 9) for x in r) for r in other.collect())
            )
        assert here[1].columns == there[1].columns


def test_steps_in_one_task_start_no_jobs(spark):
    """A chain of 12 points, each nearest to the next, takes many steps."""
    edges = AP.both_ways(spark.createDataFrame([(i, i + 1, float(i)) for i in range(11)], "i bigint, j bigint, s double"))
    assigned = spark.createDataFrame([(i, i) for i in range(12)], "doc_id bigint, exemplar bigint")
    group = "merges-in-one-task"
    spark.sparkContext.setJobGroup(group, group)
    try:
        _, merges = AP.agglomerate(edges, assigned, 1)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert merges.agg({"step": "max"}).head()[0] >= 8 and jobs < 40
