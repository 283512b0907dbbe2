import math
from fractions import Fraction

import numpy as np
import pytest

from cohortloom.llm import whitening as W
from conftest import SMALL


def brute(rows, scale=64, offset=1_000_000):
    """rows: (id, vector); exact sums, V from fractions, numpy's symmetric solver."""
    kept = [(i, [math.floor(scale * c) + offset for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dim)]
    y = np.array([[n * x[d] - sums[d] for d in range(dim)] for x in fit], object)
    scatter = y.T @ y
    v = np.array([[float(Fraction(int(scatter[i, j]), n**3)) for j in range(dim)] for i in range(dim)])
    return kept, n, sums, v


def check(got, rows):
    kept, n, sums, v = brute(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, int((values > 1e-9 * values[0]).sum()))
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    ids = sorted((repr(i), sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept)
    for c, found in by.items():
        assert sorted((repr(r.vec_id), r.deviation) for r in found) == ids
        assert {r.n for r in found} == {n}
        assert all(abs(r.explained - values[c - 1] / np.trace(v)) <= 1e-9 * r.explained for r in found)
        assert all(r.identity_error <= 1e-4 for r in found) and len({r.identity_error for r in found}) == 1
        want = sorted((repr(i), float(((np.array(x) - np.array([s / n for s in sums])) @ vectors[:, c - 1]) / np.sqrt(values[c - 1]))) for i, x in kept)
        either = [sorted((repr(r.vec_id), sign * r.whitened) for r in found) for sign in (1, -1)]
        assert min(max(abs(a - b) for (_, a), (_, b) in zip(want, have)) for have in either) < 1e-6


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(W.op11_whitening(spark, SMALL).collect(), rows)


def run(spark, tmp_path, rows, kind="float"):
    path = str(tmp_path)
    spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, Deviation int, row string, x string").write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    return W.op11_whitening(spark, path)


def test_edges(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(0, [9, 3, 1], 3)]) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(60)]  # a vector that holds most rows counts once
    rows += [(None, rows[1][1]), (7, rows[2][1]), (7, rows[2][1]), (200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 0.0, 0.0])]
    got = run(spark, tmp_path, [(*r, 5, "r", "x") for r in rows], "double")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.501, 0.5])]])
def test_no_spread_gives_no_rows(spark, tmp_path, rows):
    assert run(spark, tmp_path, [(*r, 5, "r", "x") for r in rows]).collect() == []


def test_lower_rank_and_refusals(spark, tmp_path):
    rows = [(i, [float(a), float(b), float(a + b), 3.0]) for i, (a, b) in enumerate([(0, 1), (2, 5), (4, 1), (3, 3), (9, 0)])]
    got = run(spark, tmp_path, [(*r, 5, "r", "x") for r in rows])
    assert {r.component for r in got.collect()} == {1, 2}
    with pytest.raises(ValueError, match="entries"):
        run(spark, tmp_path, [(1, [1.0], 5, "r", "x"), (2, [1.0, 2.0], 5, "r", "x")])
    with pytest.raises(Exception, match="steps"):
        run(spark, tmp_path, [(1, [1e30], 5, "r", "x"), (2, [2.0], 5, "r", "x")]).collect()


def test_whiten_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, [0.1, 0.9], "a", "z"), (2, [0.7, 0.2], "b", "z"), (3, [0.4, -0.3], "c", "z")], "id int, v array<double>, n string, Whitened string")
    model = W.fit(W.fit_list(df, "v"))
    got = W.whiten(df, model, "v")
    assert got.columns == ["id", "v", "n", "deviation", "whitened"]
    w = np.array([r.whitened for r in got.collect()])
    assert np.abs(w.T @ w / 3 - np.eye(2)).max() < 1e-12


@pytest.mark.parametrize("dim,cond", [(5, 1), (33, 1e4), (64, 1e10)])
def test_decomposition_keeps_small_eigenvalues(dim, cond):
    rng = np.random.default_rng(dim)
    q = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    want = np.geomspace(cond, 1, dim)
    c = (q * want) @ q.T
    values, vectors = W.decompose((c + c.T) / 2)
    assert np.allclose(values, want, rtol=1e-15 * cond * 50 + 1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(dim)).max() < 1e-12
    assert np.abs((vectors * values) @ vectors.T - c).max() <= 1e-12 * cond


def test_pivoted_cholesky_takes_the_largest_first():
    c = np.array([[1.0, 0.5, 0.2], [0.5, 9.0, 1.0], [0.2, 1.0, 4.0]])
    low, order = W.pivoted_cholesky(c)
    assert order[0] == 1 and order[1] == 2
    assert np.allclose(low @ low.T, c[np.ix_(order, order)]) and np.allclose(low, np.tril(low))
