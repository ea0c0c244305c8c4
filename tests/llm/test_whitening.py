"""Refined eigenvectors against a Jacobi solver in extended precision; the query against the plain fit."""

import numpy as np
import pytest

from tallywise.llm import queries, whitening

LONG = np.longdouble


def jacobi(matrix):
    """Falling eigenvalues and vectors by cyclic rotations in extended precision."""
    a, d = matrix.astype(LONG), len(matrix)
    v = np.eye(d, dtype=LONG)
    for _ in range(60):
        for p in range(d):
            for q in range(p + 1, d):
                if abs(a[p, q]) < LONG(2) ** -80 * np.abs(a).max():
                    continue
                t = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1 if t >= 0 else -1) / (abs(t) + np.sqrt(1 + t * t))
                c = 1 / np.sqrt(1 + t * t)
                turn = np.array([[c, t * c], [-t * c, c]], LONG)
                a[:, [p, q]] = a[:, [p, q]] @ turn
                a[[p, q]] = turn.T @ a[[p, q]]
                v[:, [p, q]] = v[:, [p, q]] @ turn
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], v[:, order]


def with_spectrum(values, seed=3):
    q = jacobi((lambda m: m + m.T)(np.random.default_rng(seed).normal(size=(len(values),) * 2)))[1]
    out = (q * np.array(values, LONG)) @ q.T
    return (out + out.T) / 2


@pytest.mark.parametrize("values", [
    [10 ** -k for k in range(10)],
    [3, 2 + 1e-9, 2, 2 - 1e-9, 1, 1e-3, 1e-6, 1e-6 + 1e-13],
    [5 + 1e-12 * k for k in range(8)] + [1, 0.5],
    list(np.random.default_rng(1).uniform(1, 2, 40))])
def test_eigenvectors_to_double_precision(values):
    a = with_spectrum(values)
    want_value, want = jacobi(a)
    value, got = whitening.refined_eigenvectors(a)
    assert np.abs(value - want_value).max() <= 1e-17 * len(values) * want_value.max()
    gap = np.abs(np.subtract.outer(want_value, want_value)) + np.eye(len(values)) * 9
    turned = np.abs(1 - np.abs((want * got).sum(0)))
    slack = 1e-16 + (1e-17 * len(values) * want_value.max() / gap.min(0)) ** 2
    assert (turned <= slack).all()
    assert np.abs(a @ got - got * value).max() <= 1e-17 * len(values) * want_value.max()
    assert np.abs(got.T @ got - np.eye(len(values))).max() < 1e-17 * len(values)


def test_equal_eigenvalues():
    a = with_spectrum([4, 2, 2, 2, 1])
    value, got = whitening.refined_eigenvectors(a)
    assert np.abs(a @ got - got * value).max() < 1e-17 and np.abs(got.T @ got - np.eye(5)).max() < 1e-17
    value, got = whitening.refined_eigenvectors(np.zeros((3, 3)))
    assert not value.any() and (got == np.eye(3)).all()


def test_product_is_exact_to_extended_precision():
    rng = np.random.default_rng(5)
    a, b = (rng.normal(size=(20, 20)).astype(LONG) + rng.normal(size=(20, 20)) * LONG(2) ** -40 for _ in "ab")
    assert np.abs(whitening.product(a, b) - a @ b).max() < 1e-17


def plain(vectors, components=32):
    """(whitened, deviations, explained) of a list of usable vectors by one eigendecomposition."""
    x = np.floor(np.array(vectors, float) * 64).astype(object) + 1_000_000
    n, s = len(x), x.sum(0)
    deviation = [sum(int(n * v - t) ** 2 for v, t in zip(row, s)) for row in x]
    off = (n * x - s).astype(float) / n
    value, vec = np.linalg.eigh(off.T @ off / n)
    value, vec = value[::-1], vec[:, ::-1]
    return off @ vec[:, :components] / np.sqrt(value[:components]), deviation, value / value.sum()


def test_query_equals_the_plain_fit(spark, folder):
    table = queries.table(spark, folder, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()
            if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    want, deviation, explained = plain([v for _, v in rows])
    got = queries.op11_refined_whitening(spark, folder).collect()
    assert len(got) == len(rows) * min(32, len(rows[0][1]))
    at = {d: k for k, (d, _) in enumerate(rows)}
    found = np.zeros_like(want)
    for r in got:
        found[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(rows) and r.deviation == deviation[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and 0 <= r.identity_error < 1e-9
    sign = np.sign((found * want).sum(0))
    assert np.abs(found * sign - want).max() < 1e-6
    cov = found.T @ found / len(rows) - np.outer(found.mean(0), found.mean(0))
    assert abs(np.abs(cov - np.eye(len(cov))).max() - got[0].identity_error) < 1e-9


def run(spark, rows, kind="vec_id long, embedding array<float>, whitening string"):
    df = spark.createDataFrame([(*r, "mine") for r in rows], kind)
    return whitening.by_component(whitening.with_whitened(df, whitening.fit(df))).collect()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, [nan, 1.0]), (92, [inf, 1.0]), (93, [None, 1.0]), (94, [])]
    good = [(1, [0.5, 0.25]), (2, [-0.5, 0.125]), (3, [0.25, 0.75]), (3, [0.25, 0.75]), (None, [1.0, -1.0])]
    other = [(50, [1.0, 2.0, 3.0]), (51, [1.0, 2.5, 3.0])]
    got = run(spark, bad + good + other)
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == sorted(
        [(str(d), c, 5) for d, _ in good for c in (1, 2)] + [("50", 1, 2), ("51", 1, 2)])
    want, deviation, _ = plain([v for _, v in good])
    for r in got:
        if r.vec_id == 3:
            assert r.deviation == deviation[2] and abs(abs(r.whitened) - abs(want[2][r.component - 1])) < 1e-9
    assert {round(r.whitened, 9) for r in got if r.vec_id in (50, 51)} == {1.0, -1.0}
    assert run(spark, []) == [] and run(spark, bad) == []
    assert run(spark, [(1, [1.0, 2.0])]) == [] and run(spark, [(1, [1.0, 2.0])] * 5) == []


def test_wide_ranges_and_long_vectors(spark):
    rows = [(k, [1e30 * (-1) ** k, float(k), 1e9 * k]) for k in range(6)]
    got = run(spark, rows, "vec_id long, embedding array<double>, whitening string")
    assert {r.deviation for r in got} == {None} and max(r.identity_error for r in got) < 1e-6
    rng = np.random.default_rng(2)
    got = run(spark, [(k, [float(c) for c in v]) for k, v in enumerate(rng.normal(size=(300, 200)))])
    assert len(got) == 300 * 32 and max(r.identity_error for r in got) < 1e-9
