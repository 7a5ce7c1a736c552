import math
import random

import pytest

from corpusloom.llm import topk


def brute(rows, k=10):
    fine = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(1024 * x) for x in v]
        fine[key] = min(fine.get(key, w), w)
    out = []
    for q, a in fine.items():
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), key) for key, b in fine.items() if key != q)
            out += [(q, i + 1, key, -s) for i, (s, key) in enumerate(scores[:k])]
    return sorted(out)


def table(n, seed):
    rnd = random.Random(seed)
    centers = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rnd.gauss(0, 0.2) for c in rnd.choice(centers)]) for i in range(n)]
    same = rows[7][1]
    rows += [(n + i, same) for i in range(200)]
    rows += [(10_000, None), (10_100, [1.0, None] + [0.0] * 6), (10_200, [float("nan")] * 8), (10_300, [float("inf")] * 8)]
    rows += [(None, same), (10_400, [1e12] * 8), (10_500, [0.5, 0.5]), (10_600, same), (10_600, same)]
    return rows


def run(spark, rows):
    vectors = topk.scaled(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, v int"))
    got = topk.top_inner_products(vectors, vectors.filter("vec_id % 100 = 0"))
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


@pytest.mark.parametrize("shard,block,leaf", [(16384, 2048, 128), (150, 4, 8)])
def test_against_brute_force(spark, monkeypatch, shard, block, leaf):
    for name, value in (("SHARD_ROWS", shard), ("BLOCK_ROWS", block), ("LEAF_ROWS", leaf)):
        monkeypatch.setattr(topk, name, value)
    rows = [r for r in table(900, 2) if r[0] != 10_400]
    assert run(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(100 * i, [float(2**12 * i), -1.0]) for i in range(1, 40)]
    assert run(spark, rows) == brute(rows)


def test_few_and_no_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0])]) == []
    assert run(spark, [(100, [1.0]), (101, [-2.0])]) == [(100, 1, 101, -2048 * 1024)]
