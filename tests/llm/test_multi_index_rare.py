"""Visits where the sampled queries have few links or none, and where the most visits are not enough."""

import numpy as np

from tallywise.llm import multi_index as M
from test_multi_index import brute


def frame(spark, vectors, name="vec_id"):
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<double>, copies long")


def test_no_links_among_the_queries(spark):
    """Made-up partners at the threshold set the visits; those they find are nearly all."""
    rng = np.random.default_rng(5)
    vectors = M.unit_vectors(rng.normal(size=(3000, 64)))
    index = M.fit_index(frame(spark, vectors, "site"), len(vectors), M.THRESHOLD)
    noise = rng.normal(size=vectors.shape)
    noise -= (noise * vectors).sum(axis=1, keepdims=True) * vectors
    partners = 0.92 * vectors + np.sqrt(1 - 0.92**2) * M.unit_vectors(noise)
    a, b = index.cells(vectors, index.visits), index.cells(partners, index.visits)
    met = (a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)
    assert index.visits > M.LEAST_VISITS and met.mean() >= 0.95


def test_most_visits_not_enough(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAST_VISITS", 1)
    monkeypatch.setattr(M, "MOST_VISITS", 1)
    monkeypatch.setattr(M, "CELL_BLOCK", 64)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 16))
    vectors = np.concatenate([base, base + rng.normal(size=base.shape) * 0.3])
    got = {r.vec_id: (r.n_links, r.component_id) for r in M.near_duplicates(
        frame(spark, vectors).select("vec_id", "embedding")).collect()}
    assert got == brute(list(range(len(vectors))), vectors)
