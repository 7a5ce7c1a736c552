import hashlib
import math
import random

import numpy as np
import pytest

from corpusloom.llm import centroids


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cells = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cells))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for n in range(len(cells)):
            mine = [v for (_, v), c in zip(kept, found) if c == n]
            if mine:
                cells[n] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    whole = sum(d for _, _, d in last)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cells]
    per = [sum(d for _, n, d in last if n == c) for c in range(len(cells))]
    return sorted(((i, n, d, per[n], whole, digest[n]) for i, n, d in last), key=str)


def table(n, dims=6, seed=4):
    rnd = random.Random(seed)
    centers = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [c + rnd.gauss(0, 0.3) for c in rnd.choice(centers)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(40)]  # copies
    rows += [(n + 50 + i, [0.25 * (i % 2)] * dims) for i in range(8)]  # ties
    rows += [(5, rows[8][1]), (None, rows[9][1]), (-7, None), (-8, [1.0]), (-9, [float("nan")] * dims), (-10, [None] * dims), (-11, [])]
    return rows


def run(spark, rows, k=5, rounds=4, dims=6):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, v string")
    got = centroids.cluster_report(centroids.whole_vectors(frame, dims=dims), k=k, rounds=rounds)
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rows = table(300)
    assert run(spark, rows) == brute(rows, 5, 4, 6)


def test_few_equal_and_no_vectors(spark):
    assert run(spark, []) == []
    for rows in ([(3, [1.0] * 6)], [(i, [0.5] * 6) for i in range(9)]):
        assert run(spark, rows) == brute(rows, 5, 4, 6)


def test_large_components(spark):
    rows = [(i, [float(i) * 2.0**15, 1.0]) for i in range(30)]
    assert run(spark, rows, dims=2) == brute(rows, 5, 4, 2)
    far = run(spark, [(i, [1e300 * (-1) ** i, 1.0]) for i in range(4)], k=1, rounds=0, dims=2)
    assert {r[2] for r in far} == {0, None} and {r[4] for r in far} == {None}


@pytest.mark.parametrize("spread", [0, 3, 10_000])
def test_search_finds_the_nearest_and_computes_few(spread):
    rng = np.random.default_rng(spread)
    cells = rng.integers(-1000, 1000, (200, 16)) + rng.integers(-spread, spread + 1, (200, 1))
    x = cells[rng.integers(0, 200, 500)] + rng.integers(-20, 20, (500, 16))
    number, best, computed = centroids.Centroids(cells.tolist()).nearest(x)
    every = ((x[:, None] - cells[None]) ** 2).sum(axis=2)
    assert (every.argmin(axis=1) == number).all() and (every.min(axis=1) == best).all()
    assert computed < 0.2 * every.size
