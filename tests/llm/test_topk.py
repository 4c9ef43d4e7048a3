import math

import numpy as np
from pyspark.sql import functions as F

from cartloom.llm import topk
from tests.llm.shared import rows


def frame(spark, data):
    made = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    return made.withColumns({c: F.lit(1) for c in ("d", "v", "rank", "score", "query_block")})


def brute_force(data, k, query):
    usable = {}
    for vec_id, e, _ in data:
        if e and all(x is not None and math.isfinite(x) for x in e):
            usable[vec_id] = [math.floor(1024 * float(np.float32(x))) for x in e]
    out = []
    for q, v in usable.items():
        if query(q):
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in usable.items() if c != q and len(w) == len(v))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(best[:k], 1)]
    return sorted(out, key=repr)


def test_against_brute_force_with_unusable_vectors_and_ties(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(0, 0.2, 24).tolist(), 0) for i in range(300)]
    data += [(300 + i, data[7][1], 0) for i in range(40)]  # ties
    data += [(400, None, 0), (401, [], 0), (402, [None] * 24, 0), (403, [float("nan")] * 24, 0), (404, [float("inf")] * 24, 0)]
    data += [(500, [1.0, 2.0], 0), (501, [0.5, 0.25], 0)]
    found = topk.top_k(topk.whole_numbers(frame(spark, data)), F.col("vec_id") % 50 == 0, 10)
    assert rows(found) == brute_force(data, 10, lambda q: q % 50 == 0)


def test_large_components_stay_exact(spark):
    data = [(i, [float(2**18 + i), 3.0 * 2**18], 0) for i in range(30)]
    found = topk.top_k(topk.whole_numbers(frame(spark, data)), F.col("vec_id") == 0, 3)
    assert rows(found) == brute_force(data, 3, lambda q: q == 0)


def test_repeated_and_few_rows(spark):
    data = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0)]
    found = topk.top_k(topk.whole_numbers(frame(spark, data)), F.col("vec_id") == 0)
    assert rows(found) == [(0, 1, 1, 1 << 20), (0, 2, 1, 1 << 20)]


def test_rows_without_an_id_take_no_part_and_large_ids_stay_exact(spark):
    large = 2**53 + 1
    data = [(None, [9.0, 9.0], 0), (None, None, 0), (large, [1.0, 0.0], 0), (large + 1, [1.0, 1.0], 0), (7, [2.0, 0.0], 0)]
    found = topk.top_k(topk.whole_numbers(frame(spark, data)), F.lit(True))
    kept = [r for r in data if r[0] is not None]
    assert rows(found) == brute_force(kept, 10, lambda q: True)


def test_empty_table(spark):
    assert topk.top_k(topk.whole_numbers(frame(spark, [])), F.col("vec_id") == 0).count() == 0


def test_bounds_prune_nothing_that_belongs():
    rng = np.random.default_rng(2)
    v = rng.integers(-500, 500, (64, 2000)).astype(float)
    v[:, :1000] = np.floor(v[:, :1000] * np.linspace(1, 0.01, 64)[:, None])
    ids = np.arange(2000)
    squares = np.array([(v[b : b + topk.BLOCK_DIMENSIONS] ** 2).sum(axis=0) for b in range(0, 64, topk.BLOCK_DIMENSIONS)])
    rest = np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])
    for q in range(0, 2000, 333):
        found, scores = topk.best_in_cell(ids, v, q, v[:, q].copy(), 10, rest)
        all_scores = v[:, q] @ v
        expected = sorted((-s, i) for i, s in enumerate(all_scores) if i != q)[:10]
        assert list(zip(found, scores)) == [(i, -s) for s, i in expected]
