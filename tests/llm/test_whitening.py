import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.llm import QUERIES, whitening
from cartloom.llm.shared import prepared
from tests.llm.shared import SF_DIR


def frame(spark, data):
    made = prepared(spark).createDataFrame(data, "vec_id long, embedding array<float>")
    return made.withColumns({c: F.lit(1) for c in ("x", "v", "d", "n", "block", "position", "whitened")})


def exact(embeddings):
    """x, n x - S in Python integers, eigenvalues and vectors by the dense way."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e] for e in embeddings]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    whole = [[n * c - s for c, s in zip(row, sums)] for row in x]
    c = np.array([[w / n for w in row] for row in whole])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    return whole, c, values[::-1], vectors[:, ::-1]


def check(spark, data, used, components=whitening.COMPONENTS, gap=1e-6):
    found = whitening.whiten(frame(spark, data), components).collect()
    whole, c, values, vectors = exact([e for _, e in used])
    k = min(components, int((values > 1e-12 * max(values.sum(), 1e-300)).sum()))
    expected = {}
    for (vec_id, _), w in zip(used, whole):
        expected.setdefault(vec_id, set()).add(sum(a * a for a in w))
    assert {(r["vec_id"], int(r["deviation"])) for r in found} == {(i, d) for i, all_ in expected.items() for d in all_}
    assert len(found) == len(used)
    assert {r["n"] for r in found} == {len(used)}
    assert {len(r["whitened"]) for r in found} == {k} == {len(r["explained"]) for r in found}
    if k:
        assert max(r["identity_error"] for r in found) < 1e-9
        assert np.allclose(found[0]["explained"], values[:k] / values.sum(), rtol=1e-12)
        y = c @ vectors[:, :k] / np.sqrt(values[:k])
        ours = np.array([r["whitened"] for r in sorted(found, key=lambda r: r["vec_id"])])
        apart = np.array([min(abs(values[i] - v) for j, v in enumerate(values) if j != i) > gap * values[0] if len(values) > 1 else True for i in range(k)])
        assert np.abs(np.abs(ours) - np.abs(y))[:, apart].max(initial=0) < 1e-6
    return found


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(0, 0.2, 40) * np.linspace(3, 0.5, 40)).tolist()) for i in range(400)]
    check(spark, data, data)
    check(spark, data, data, components=5)


def test_more_dimensions_than_the_search_space(spark):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(150, 150)))[0]
    data = [(i, ((rng.normal(size=150) * 0.97 ** np.arange(150)) @ turn * 4).tolist()) for i in range(300)]
    check(spark, data, data)


def test_unusable_rows_other_dimensions_repeats(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(0, 1, 3).tolist()) for i in range(50)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan")] * 3), (104, [float("inf")] * 3), (105, [1.0] * 5)]
    check(spark, good + odd, good)
    found = whitening.whiten(frame(spark, good + good[:5] + [(None, [1.0, 2.0, 3.0])])).collect()
    assert len(found) == 56 and sum(r["vec_id"] is None for r in found) == 1
    assert {r["n"] for r in found} == {56}


def test_equal_vectors_one_vector_and_none(spark):
    for data in ([(i, [1.0, -2.0]) for i in range(4)], [(1, [0.5, 0.25])]):
        found = check(spark, data, data)
        assert all(r["whitened"] == [] and r["deviation"] == 0 for r in found)
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0


def test_few_directions_and_equal_eigenvalues(spark):
    rng = np.random.default_rng(6)
    plane = rng.normal(size=(2, 20))
    check(spark, flat := [(i, (np.round(rng.normal(size=2) * 4) @ np.round(plane * 8)).tolist()) for i in range(60)], flat)
    corners = [(2 * i + s, [(8.0 if s else -8.0) if j == i else 0.0 for j in range(24)]) for i in range(24) for s in (0, 1)]
    found = check(spark, corners, corners)
    y = np.array([r["whitened"] for r in found])
    assert np.allclose(y.T @ y / len(y), np.eye(24), atol=1e-9)


def test_large_entries_stay_exact(spark):
    data = [(i, [float(2**30 + i * 2**20), float((-1) ** i * 2**28)]) for i in range(9)]
    check(spark, data, data)


def test_inner_solver_reduces_the_projected_equation():
    rng = np.random.default_rng(7)
    v = np.diag(np.linspace(5, 1, 30))
    known = np.linalg.qr(rng.normal(size=(30, 2)))[0]
    residual = whitening.outside(rng.normal(size=(30, 2)), known)
    t = whitening.corrections(lambda u: v @ u, np.array([8.0, 7.0]), known, residual)
    left = whitening.outside(v @ t - t * [8.0, 7.0], known) + residual
    assert np.linalg.norm(left) < 0.05 * np.linalg.norm(residual)
    assert np.abs(known.T @ t).max() < 1e-12


def test_query(spark):
    found = QUERIES["op11_whitening"](spark, SF_DIR)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(found.dtypes)["deviation"] == dict(found.dtypes)["n"] == "bigint"
    rows = found.collect()
    assert {r["component"] for r in rows} == set(range(1, 33))
    embeddings = sorted(tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect())
    whole, *_ = exact([e for _, e in embeddings])
    assert {r["vec_id"]: r["deviation"] for r in rows} == {i: sum(a * a for a in w) for (i, _), w in zip(embeddings, whole)}
    assert rows[0]["identity_error"] < 1e-12


@pytest.mark.parametrize("n, entry", [(10**9, 10**6), (10**4, 50)])
def test_deviations_beyond_64_bits_stay_exact(n, entry):
    c, whole = whitening.centred(np.array([[entry, -entry]]), n, [3, 5])
    assert [int(w) for w in whole[0]] == [n * entry - 3, -n * entry - 5]
    assert sum(int(w) ** 2 for w in whole[0]) == int((whole * whole).sum(axis=1)[0])
