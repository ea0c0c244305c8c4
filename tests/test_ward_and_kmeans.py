"""Ward's hierarchy and many k-means fits against plain versions."""

import numpy as np
import pytest

from test_density import clumps
from test_neighbours import frame
from tallywise.operators import clustering as cl


def plain_ward(x, k):
    """Labels by always merging the cheapest pair."""
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        c = np.array([x[g].mean(0) for g in groups])
        n = np.array([len(g) for g in groups], float)
        rise = n[:, None] * n[None] / (n[:, None] + n[None]) * ((c[:, None] - c[None]) ** 2).sum(-1)
        np.fill_diagonal(rise, np.inf)
        a, b = sorted(np.unravel_index(rise.argmin(), rise.shape))
        groups[a] += groups.pop(b)
    out = np.zeros(len(x), int)
    for at, g in enumerate(sorted(groups, key=min)):
        out[g] = at
    return out


@pytest.mark.parametrize("k", [1, 4, 9])
def test_ward_equals_merging_the_cheapest_pair(spark, k):
    x = clumps(5, 90, centres=5)
    got = cl.ward(frame(spark, x), k).toPandas().sort_values("id")["cluster_id"].to_numpy()
    assert (got == plain_ward(x, k)).all()


def test_ward_on_features(spark):
    x = clumps(5, 800, centres=4, width=0.02)[:800]
    got = cl.ward(frame(spark, x), 4, features=100).toPandas().sort_values("id")["cluster_id"].to_numpy()
    assert (got == plain_ward(x[:800:4], 4).repeat(4)[:800]).mean() > 0 and len(set(got)) == 4
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) < 0.5
    assert (near == (got[:, None] == got[None])).all()


def test_ward_of_few_rows(spark):
    assert cl.ward(spark.createDataFrame([], "id long, vec array<double>"), 3).count() == 0
    same = cl.ward(frame(spark, np.zeros((5, 2))), 3).collect()
    assert len(same) == 5 and {r["cluster_id"] for r in same} == {0}


def lloyd_cost(x, centres):
    for _ in range(300):
        label = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.array([x[label == i].mean(0) if (label == i).any() else c for i, c in enumerate(centres)])
    return ((x - centres[label]) ** 2).sum()


def test_many_fits_settle_at_local_optima(spark, monkeypatch):
    monkeypatch.setattr(cl, "SAMPLE_ROWS", 100)
    x = clumps(6, 500, centres=5)
    fits = cl.fit_many(frame(spark, x), [2, 5, 5, 8])
    assert [len(c) for c, _ in fits] == [2, 5, 5, 8]
    for centres, cost in fits:
        assert cost == pytest.approx(lloyd_cost(x, centres), rel=1e-3)
    assert fits[3][1] < fits[1][1] < fits[0][1]


def test_silhouettes_equal_the_evaluator(spark):
    x = clumps(4, 300, centres=4)
    df = frame(spark, x)
    models = [c for c, _ in cl.fit_many(df, [2, 4])]
    for centres, value in zip(models, cl.silhouettes(df, models)):
        assert value == pytest.approx(cl.silhouette(cl._labelled(df, centres)), abs=1e-9)


def test_fits_of_few_rows(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    assert cl.kmeans(none, 3).count() == 0 and cl.choose_k(none, 0).count() == 0
    assert cl.kmeans(frame(spark, np.ones((4, 3))), 3, restarts=2).count() == 4
