import numpy as np
import pytest

from corpusloom.llm import cap_filters


def brute(rows, threshold=0.95):
    def usable(i, v):
        return i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    fine = [k for k, r in enumerate(rows) if usable(*r)]
    links, label = [0] * len(rows), list(range(len(rows)))
    for n in {len(rows[k][1]) for k in fine}:
        ks = [k for k in fine if len(rows[k][1]) == n]
        x = np.array([rows[k][1] for k in ks])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near)):
            links[ks[a]] += 1
        seen = set()
        for start in range(len(ks)):
            stack = [start]
            while stack:
                u = stack.pop()
                if u not in seen:
                    seen.add(u)
                    label[ks[u]] = ks[start]
                    stack += np.flatnonzero(near[u]).tolist()
    least = {}
    for k in fine:
        least[label[k]] = min(least.get(label[k], rows[k][0]), rows[k][0])
    out = [(i, links[k], least[label[k]] if k in set(fine) else i) for k, (i, v) in enumerate(rows)]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, size int, filter string")
    return sorted((tuple(r) for r in cap_filters.linked_vectors(frame).collect()), key=str)


def table():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 64)) / 8
    rows = []
    for k in range(500):
        start = base[rng.integers(30)] if rng.random() < 0.5 else rng.normal(size=64) / 8
        rows.append((5000 - k, (start + rng.normal(size=64) / 8 * rng.choice([0.02, 0.1, 0.2, 0.25, 0.3])).tolist()))
    rows += [(9000 + k, (base[0] + rng.normal(size=64) / 8 * 0.2).tolist()) for k in range(250)]  # a large group
    same = rows[3][1]
    rows += [(10_000 + k, same) for k in range(60)] + [(10_100, [3 * x for x in same]), (20, same), (20, same)]
    rows += [(1, None), (2, [0.0] * 64), (3, [float("nan")] * 64), (4, [None] * 64), (6, []), (None, same)]
    rows += [(7, [1.0, 2.0]), (8, [1.0, 2.1]), (7, [-1.0, 1.0]), (9, [1e300] * 64), (10, [1e300] * 64), (11, [1e-310] * 64)]
    return rows + [(12, [3.0]), (13, [2.0]), (14, [-2.0])]


@pytest.mark.parametrize("block,small", [(1024, 48), (60, 4)])
def test_against_brute_force(spark, monkeypatch, block, small):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    monkeypatch.setattr(cap_filters, "SMALL", small)
    rows = table()
    assert run(spark, rows) == brute(rows)


def test_few_and_no_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]
    assert run(spark, [(5, [1.0, 2.0])]) == [(5, 0, 5, True)]


@pytest.mark.parametrize("vectors,most", [(10_000, 0.002), (3_000_000, 0.002)])
def test_recall_of_pairs_just_at_the_threshold(vectors, most):
    rng = np.random.default_rng(8)
    x = cap_filters._units(rng.normal(size=(1500, 64)))
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * cap_filters._units(away)
    code = cap_filters.ProductCode(64, vectors, 0.95)
    met = np.zeros(len(x), bool)
    apart = 0
    for t in range(code.tables):
        (i, f), (j, g) = code.decode(x, t), code.decode(y, t)
        met[np.intersect1d(f * len(x) + i, g * len(x) + j) % len(x)] = True
        apart += len(i)
    assert 1 - met.mean() <= most
    assert 1.2 < apart / len(x) / code.tables < 3.5  # filters of a table that a vector is in
    i, f = code.decode(x, 0)
    turn, parts = code._table(0)
    word = f // code.base ** np.arange(code.parts - 1, -1, -1)[:, None] % code.base
    direction = np.concatenate([p[w] for p, w in zip(parts, word)], axis=1)
    assert (np.einsum("ij,ij->i", (x @ turn)[i], direction) >= code.bound - 1e-9).all()
