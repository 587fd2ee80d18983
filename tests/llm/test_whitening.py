import math

import numpy as np
import pytest

from trendspark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=8):
    """``vec_id -> (deviation, whitened)`` in exact and dense arithmetic, and the shares of the trace."""
    good = [(i, x) for i, x in rows if x and all(v is not None and math.isfinite(v) for v in x)]
    x = [[math.floor(1024 * float(np.float32(v))) + 100000 for v in r] for _, r in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = [[n * a - s for a, s in zip(r, sums)] for r in x]
    y = np.array(centred, float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    return ([i for i, _ in good], [sum(a * a for a in r) for r in centred], y @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum())


def compare(spark, rows, components=8):
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).selectExpr("*", "1 as n", "'x' as entries", "2 as dim", "3 as at")
    got = W.whitening_digests(df, components).toPandas()
    ids, deviation, white, shares = brute(rows, components)
    assert len(got) == len(ids) * len(shares) and (got.n == len(ids)).all()
    assert (got.identity_error <= 1e-9).all() and got.identity_error.nunique() == 1
    assert sorted(got.component.unique()) == list(range(1, len(shares) + 1))
    found = {i: dict(zip(g.component, g.whitened)) for i, g in got.groupby("vec_id")}
    signs = np.sign(sum(np.array([found[i][c + 1] for c in range(len(shares))]) * w for i, w in zip(ids, white)))
    for i, d, w in zip(ids, deviation, white):
        assert set(got[got.vec_id == i].deviation) == {d}
        assert np.allclose([found[i][c + 1] * signs[c] for c in range(len(shares))], w, atol=1e-9)
    assert np.allclose(got.groupby("component").explained.first(), shares, rtol=1e-10)


def cloud(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * np.linspace(1, 2, dim) + 5
    x[:, 0] *= 9
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]


def test_equals_a_dense_solver(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, []), (902, [None] + [1.0] * 39), (903, [nan] * 40), (904, [inf] * 40), (905, [1.0, 2.0]), (906, [3e38] * 40)]
    rows = cloud(300, 40)
    df = spark.createDataFrame([(i, x, 0) for i, x in rows + odd], SCHEMA)
    assert set(r.vec_id for r in W.whitening_digests(df).select("vec_id").distinct().collect()) == set(range(300))
    compare(spark, rows + [(902, [None] + [1.0] * 39), (903, [nan] * 40)])


def test_few_dimensions_and_missing_rank(spark):
    compare(spark, cloud(60, 3))
    flat = [(i, [float(i), 2.0 * i, 7.0, 0.5, *[1.0] * 40]) for i in range(50)]
    compare(spark, flat)


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)]):
        assert W.whitening_digests(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)).count() == 0


def test_null_ids_repeated_rows_and_ties(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])]
    out = W.whitening_digests(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)).collect()
    assert len(out) == 10 and sum(r.vec_id is None for r in out) == 4 and {r.n for r in out} == {5}


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(2**40 * (i % 2)), float(i)]) for i in range(8)]
    out = W.whitening_digests(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)).collect()
    assert {r.deviation for r in out} == {None}


def test_whitened_vectors_have_unit_covariance(spark):
    df = spark.createDataFrame([(i, x, 0) for i, x in cloud(400, 36, 3)], SCHEMA)
    w = np.array([r.whitened for r in W.whitened(df, 4).collect()])
    assert w.shape == (400, 4) and np.allclose(np.cov(w.T, bias=True), np.eye(4), atol=1e-9)


@pytest.mark.parametrize("gap", [0.0, 1e-6])
def test_equal_eigenvalues_are_certified(spark, gap):
    axes = np.eye(48) * (1 + gap * np.arange(48)[:, None])
    rows = [(i, x.tolist(), 0) for i, x in enumerate(np.concatenate([axes, -axes]) * 50)]
    entries = W.whole_entries(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    model = W.fit(entries, 48, components=4)
    assert len(model.values) == 4 and W.identity_error(entries, model) < 1e-9
