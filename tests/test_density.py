"""Density clusters, neighbours and joins of wide vectors against brute force, and the pairs they compare."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_neighbours import brute_clusters, distances, frame, points
from tallywise.operators import clustering as cl
from tallywise.operators import density, pivots
from tallywise.operators import similarity as sim


def clumps(d, n, seed=2, centres=12, width=0.08):
    """`centres` clumps of points, a fifth as many points alone, a tenth of one clump copies of a point."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    x = middle[rng.integers(0, centres, n)] + rng.normal(0, width, (n, d))
    x[: n // 10] = x[0]
    return np.concatenate([x, 2 * rng.normal(size=(n // 5, d))])


@pytest.mark.parametrize("x, eps", [(points(2), 0.3), (points(8, 300), 1.2), (clumps(5, 400), 0.25),
                                    (clumps(12, 400), 0.35), (clumps(64, 300), 0.9)])
def test_dbscan_at_any_width(spark, x, eps, monkeypatch):
    monkeypatch.setattr(density, "BLOCK_ROWS", 40)
    got = density.dbscan(frame(spark, x), "id", eps).toPandas().sort_values("id")
    label, core = brute_clusters(x, eps, 5)
    assert (got["cluster_id"].to_numpy() == label).all() and (got["is_core"].to_numpy() == core).all()
    assert len(set(label)) >= 2


def test_twelve_clusters_stay_twelve(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(np.eye(12), 6, 0) + rng.normal(0, 0.02, (72, 12))
    got = cl.density_clusters(frame(spark, x), 12, 0.5, 5).toPandas()
    assert got["cluster_id"].nunique() == 12 and got["is_core"].all()


def test_one_dense_spot_is_one_cluster(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 0.01, (1500, 6)), rng.normal(0, 5, (100, 6))])
    got = density.dbscan(frame(spark, x), "id", 0.3).toPandas().set_index("id")
    assert (got["cluster_id"][:1500] == 0).all() and got["is_core"][:1500].all()


def test_dbscan_of_few_rows(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    assert density.dbscan(none, "id", 1.0).count() == 0
    rows = frame(spark, np.zeros((3, 5)))
    assert {tuple(r) for r in density.dbscan(rows, "id", 1.0, 4).collect()} == {(i, -1, False) for i in range(3)}
    assert {tuple(r) for r in density.dbscan(rows, "id", 1.0, 3).collect()} == {(i, 0, True) for i in range(3)}


def test_compared_methods_use_every_dimension(spark):
    rng = np.random.default_rng(5)
    x = np.repeat(np.eye(8), 20, 0) + rng.normal(0, 0.02, (160, 8))
    labels, _, _ = cl.compare_methods(frame(spark, x), 8, 8, eps=0.5, restarts=2)
    got = labels.where("cluster_method = 'dbscan'").toPandas().sort_values("id")
    assert (got["cluster_id"].to_numpy() == brute_clusters(x, 0.5, 5)[0]).all()


@pytest.mark.parametrize("metric", [sim.COSINE, sim.EUCLIDEAN])
def test_knn_of_clumps(spark, metric):
    x = clumps(10, 300)
    x[5] = x[17] = 0.0
    if metric == sim.COSINE:
        size = np.linalg.norm(x, axis=1, keepdims=True)
        unit = np.divide(x, size, out=np.zeros_like(x), where=size > 0)
        dist = np.round(1 - unit @ unit.T, 12)
    else:
        dist = distances(x)
    np.fill_diagonal(dist, np.inf)
    df = frame(spark, x)
    got = sim.knn(df, df, 6, metric, block_rows=30).toPandas().sort_values(["query_id", "rank"])
    assert len(got) == 6 * len(x)
    want = np.sort(dist, axis=1)[:, :6]
    np.testing.assert_allclose(got["distance"].to_numpy().reshape(-1, 6), want, atol=1e-9)
    zero = got[got["query_id"] == 5]["similar_id"].tolist()
    assert metric != sim.COSINE or zero == [0, 1, 2, 3, 4, 6]


def test_more_neighbours_than_rows(spark):
    df = frame(spark, points(4, 30)[:5])
    assert sim.knn(df, df, 10).groupBy("query_id").count().where("count = 4").count() == 5
    assert sim.knn(df.where("false"), df, 3).count() == 0


def compared(monkeypatch, run):
    """Pairs of rows that `run` compares, counted where blocks meet."""
    counts = []
    plain = pivots.in_blocks

    def counting(left, right, compare, kind, key, *more):
        sides = [df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((left, "a"), (right, "b"))]
        counts.append(sides[0].join(sides[1], key).agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0)
        return plain(left, right, compare, kind, key, *more)
    monkeypatch.setattr(sim, "in_blocks", counting)
    run()
    return sum(counts)


def test_neighbours_of_all_compare_few_pairs(spark, monkeypatch):
    x = clumps(10, 6000, centres=60)
    rng = np.random.default_rng(1)
    x = x[rng.permutation(len(x))]
    few, all_ = (compared(monkeypatch, lambda: sim.knn(df, df, 5, sim.EUCLIDEAN).count())
                 for df in (frame(spark, x[:3600]), frame(spark, x)))
    assert all_ < 3 * few and all_ < 0.15 * len(x) ** 2


def test_wide_join_compares_few_pairs(spark, monkeypatch):
    from tallywise.plans.model_inputs import embedded
    df = embedded(spark, "/root/testdata/sf0.1").select("id", "vec")
    n = df.count()
    pairs = compared(monkeypatch, lambda: sim.similarity_join(df, 0.9, 64).count())
    assert pairs < 0.05 * n * n / 2


def test_wide_join_equals_brute_force(spark):
    x = clumps(20, 300, width=0.2)
    rows = sim.similarity_join(frame(spark, x), 0.9, 20).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    total = sum(r.n_a * r.n_b if r.id_a != r.id_b else r.n_a * (r.n_a - 1) // 2 for r in rows.itertuples())
    assert total == int((np.triu(unit @ unit.T, 1) >= 0.9).sum()) and len(rows) > 500


def test_forest_spans_and_has_no_cycle():
    rng = np.random.default_rng(7)
    for n, m in ((1, 0), (5, 3), (60, 200), (400, 300)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        kept = pivots.forest(n, a, b)
        whole, part = (pd.Series(density._labels(n, a[k], b[k]) if len(k) else range(n)).nunique()
                       for k in (np.arange(m), kept))
        assert whole == part == n - len(kept)
