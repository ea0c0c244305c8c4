"""Hierarchical density clusters against brute force over all pairs."""

import numpy as np
import pandas as pd
import pytest

from test_density import clumps
from test_neighbours import distances, frame
from tallywise.operators import hierarchy as hi


def brute(x, mcs, need):
    """Labels by cutting the whole graph of mutual reachability at every distance, from the top down."""
    n = len(x)
    d = np.round(distances(x), 12)
    core = np.sort(d + np.diag(np.full(n, np.inf)), axis=1)[:, need - 1]
    w = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    np.fill_diagonal(w, 0)

    def parts(rows, below):
        """Connected parts of `rows` under edges shorter than `below`; also single points."""
        left, out = set(rows), []
        while left:
            todo, part = [left.pop()], []
            while todo:
                k = todo.pop()
                part.append(k)
                near = [m for m in left if w[k, m] < below]
                left -= set(near)
                todo += near
            out.append(sorted(part))
        return out

    def grow(rows, birth):
        """(stability, worth, chosen sets) of the cluster `rows` that is born at density `birth`."""
        stability, now = 0.0, rows
        while True:
            # The longest edge that holds `now` together: below it the part falls apart.
            tree = longest(now)
            density = 1 / max(tree, hi.LEAST)
            split = parts(now, tree)
            big = [p for p in split if len(p) >= mcs]
            if len(big) == 1:
                stability += (len(now) - len(big[0])) * (density - birth)
                now = big[0]
                continue
            stability += len(now) * (density - birth)
            kids = [grow(p, density) for p in big]
            worth = sum(k[0] for k in kids)
            chosen = [c for k in kids for c in k[1]]
            return (stability, [rows]) if stability >= worth or not kids else (worth, chosen)

    def longest(rows):
        inside, top = {rows[0]}, 0.0
        dist = {k: w[rows[0], k] for k in rows[1:]}
        while dist:
            k = min(dist, key=dist.get)
            top = max(top, dist.pop(k))
            for m in dist:
                dist[m] = min(dist[m], w[k, m])
        return top

    label = np.full(n, -1)
    now = list(range(n))
    while len(now) >= mcs:
        top = longest(now)
        big = [p for p in parts(now, top) if len(p) >= mcs]
        if len(big) == 1:
            now = big[0]
            continue
        for p in big:
            for cluster in grow(p, 1 / max(top, hi.LEAST))[1]:
                label[cluster] = min(cluster)
        break
    return label


def plane(n=160, seed=3):
    """Rounded points: many equal distances and copies."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.5, (n // 4, 2)) for c in ((0, 0), (4, 0), (0, 5))] + [rng.uniform(-3, 8, (n // 4, 2))])
    return np.round(x, 1)


@pytest.mark.parametrize("x, mcs, need, bundle", [
    (plane(), 10, 5, 40), (plane(seed=4), 5, 3, 10**6), (clumps(8, 150, centres=5, width=0.15), 8, 5, 10**6)])
def test_equals_brute_force(spark, monkeypatch, x, mcs, need, bundle):
    monkeypatch.setattr(hi, "BUNDLE_EDGES", bundle)
    monkeypatch.setattr(hi, "LISTED", 1)
    want = brute(x, mcs, need)
    got = hi.hdbscan(frame(spark, x), "id", mcs, need).toPandas().sort_values("id")["cluster_id"].to_numpy()
    assert len(set(want)) > 2 and (got == want).all()


def test_spanning_tree_is_as_light_as_any(spark):
    x = clumps(6, 200, centres=4)
    s = frame(spark, np.unique(x, axis=0)).selectExpr("id as site", "vec", "1L as weight")
    edges, rows = hi.spanning_tree(s, 5)
    points = np.array([r["vec"] for r in s.orderBy("site").collect()])
    d = distances(points)
    core = np.sort(d + np.diag(np.full(len(d), np.inf)), axis=1)[:, 4]
    w = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    dist, total, left = w[0].copy(), 0.0, set(range(1, len(d)))
    while left:
        k = min(left, key=lambda m: dist[m])
        total += dist[k]
        left.remove(k)
        dist = np.minimum(dist, w[k])
    found = edges.toPandas()
    assert len(found) == len(d) - 1 and abs(found["w"].sum() - total) < 1e-8


def test_few_rows(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    assert hi.hdbscan(none, "id").count() == 0
    assert {tuple(r) for r in hi.hdbscan(frame(spark, np.eye(4)), "id", 2, 5).collect()} == {(k, -1) for k in range(4)}
    same = frame(spark, np.zeros((30, 3)))
    assert {r["cluster_id"] for r in hi.hdbscan(same, "id").collect()} == {-1}
    two = frame(spark, np.repeat([[0.0, 0.0], [5.0, 5.0]], 12, 0))
    got = pd.DataFrame(hi.hdbscan(two, "id").collect(), columns=["id", "c"])
    assert (got.sort_values("id")["c"] == [0] * 12 + [12] * 12).all()
