"""Grid operators against brute force, with copies and crowded spots."""

import numpy as np
import pandas as pd
import pytest

from tallywise.operators import neighbours as nb
from tallywise.operators import similarity as sim


def points(d, n=500, seed=1):
    rng = np.random.default_rng(seed)
    third = n // 3  # a third of the rows in one spot, half of them copies of one point
    x = np.concatenate([rng.normal(0, 1, (n - third, d)), np.repeat([[3.0] * d], third // 2, 0),
                        rng.normal(3, 0.02, (third - third // 2, d))])
    rng.shuffle(x)
    return x


def frame(spark, x):
    pdf = pd.DataFrame({"id": np.arange(len(x)), "vec": list(map(list, x))})
    return spark.createDataFrame(pdf, "id long, vec array<double>").repartition(5)


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def brute_clusters(x, eps, need):
    near = distances(x) <= eps
    core, label = near.sum(1) >= need, np.full(len(x), -1)
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            label[i], todo = i, [i]
            while todo:
                for m in np.flatnonzero(near[todo.pop()] & core & (label < 0)):
                    label[m] = i
                    todo.append(m)
    out = label.copy()
    for i in np.flatnonzero(~core):
        around = label[near[i] & core]
        out[i] = around.min() if len(around) else -1
    return out, core


@pytest.mark.parametrize("d,eps", [(2, 0.3), (2, 0.05), (3, 0.5), (4, 0.8)])
def test_dbscan(spark, d, eps):
    x = points(d, 300 if d == 4 else 500)
    got = nb.dbscan(frame(spark, x), "id", eps, d, 5).toPandas().sort_values("id")
    label, core = brute_clusters(x, eps, 5)
    assert (got["cluster_id"].to_numpy() == label).all() and (got["is_core"].to_numpy() == core).all()


def test_dbscan_does_not_depend_on_partitions(spark):
    df = frame(spark, points(2, 200))
    runs = [sorted(map(tuple, nb.dbscan(df.repartition(n), "id", 0.3, 2).collect())) for n in (1, 11)]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("d,radius", [(2, 0.4), (3, 0.7)])
def test_density_score(spark, d, radius):
    x = points(d)
    got = nb.density_score(frame(spark, x), "id", radius, d, 5).toPandas().sort_values("id")
    fifth = np.sort(distances(x) + np.diag(np.full(len(x), np.inf)), axis=1)[:, 4]
    want = np.where(fifth <= radius, fifth, np.nan)
    np.testing.assert_allclose(got["core_distance"].astype(float), want, atol=1e-9)
    assert (got["is_sparse"].to_numpy() == np.isnan(want)).all()


@pytest.mark.parametrize("slice_rows", [20_000, 30])
def test_eps_pairs(spark, slice_rows):
    x = points(3, 300)
    got = nb.eps_pairs(frame(spark, x), "id", 0.2, [0, 2], slice_rows=slice_rows).collect()
    want = {(i, j) for i, j in np.argwhere(distances(x) <= 0.2) if i < j}
    assert len(got) == len(want) and {(r["id_a"], r["id_b"]) for r in got} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id as u", "id + 1 as v")
    nodes = spark.range(302).selectExpr("id as node")
    roots = {r["node"]: r["root"] for r in nb.connected_components(edges, nodes).collect()}
    assert all(roots[i] == 0 for i in range(301)) and roots[301] == 301


@pytest.mark.parametrize("metric", [sim.COSINE, sim.EUCLIDEAN])
def test_knn(spark, metric):
    x = points(6, 240)
    if metric == sim.COSINE:
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        dist = np.round(1 - unit @ unit.T, 12)
    else:
        dist = np.round(distances(x), 12)
    np.fill_diagonal(dist, np.inf)
    df = frame(spark, x)
    queries = df.where("id < 40")
    got = sim.knn(df, queries, 7, metric, block_rows=50).toPandas()
    got = got.sort_values(["query_id", "rank"])
    assert len(got) == 40 * 7
    want = np.sort(dist[:40], axis=1)[:, :7]
    np.testing.assert_allclose(got["distance"].to_numpy().reshape(40, 7), want, atol=1e-9)
    assert (got["query_id"] != got["similar_id"]).all()


def test_knn_without_queries(spark):
    df = frame(spark, points(3, 60))
    assert sim.knn(df, df.where("false"), 3).count() == 0


def test_lsh_finds_most_neighbours_and_all_copies(spark):
    x = points(8, 300)
    df = frame(spark, x)
    exact = {(r["query_id"], r["similar_id"]) for r in sim.knn(df, df, 5).collect()}
    hits = sim.knn_lsh(df, 8, 5, tables=8, bits=3)
    found = {(r["query_id"], r["similar_id"]) for r in hits.collect()}
    assert len(exact & found) / len(exact) > 0.7


def test_similarity_join_expands_to_all_pairs(spark):
    x = np.abs(points(3, 240)) + 0.1
    rows = sim.similarity_join(frame(spark, x), 0.98, 3).collect()
    total = sum(r["n_a"] * r["n_b"] if r["id_a"] != r["id_b"] else r["n_a"] * (r["n_a"] - 1) // 2
                for r in rows)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert total == int((np.triu(unit @ unit.T, 1) >= 0.98).sum())


def test_similarity_band_borders(spark):
    hits = spark.createDataFrame([(0.6,), (0.8,), (0.4,), (0.81,), (0.2,)], "similarity_score double")
    b = sim.similarity_bands(hits).first()
    assert (b["very_high"], b["high"], b["medium"], b["low"], b["pattern_low"]) == (1, 2, 2, 1, 1)
