"""The one-class boundary against a small dual solved by brute force."""

import numpy as np
import pytest

from test_density import clumps
from test_neighbours import frame
from tallywise.operators import one_class as oc


def dual(k, nu):
    """Weights of the one-class dual by projected gradient onto the capped simplex."""
    n = len(k)
    cap, a = 1 / (nu * n), np.full(n, 1 / n)
    step = 1 / np.linalg.eigvalsh(k).max()
    for _ in range(20_000):
        want = a - step * (k @ a)
        low, high = want.min() - cap, want.max()
        for _ in range(60):
            mid = (low + high) / 2
            if np.clip(want - mid, 0, cap).sum() > 1:
                low = mid
            else:
                high = mid
        a = np.clip(want - high, 0, cap)
    return a


def test_equals_the_dual(spark, nu=0.2):
    x = clumps(4, 100, centres=3, width=0.4)
    x = x + np.random.default_rng(5).normal(0, 1e-3, x.shape)  # no copies, so that no scores tie
    df = frame(spark, x)
    gamma = 1 / (x.shape[1] * x.var())
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    a = dual(k, nu)
    features, normal = oc.fit(df, nu, landmarks=len(x))  # every row a landmark: the kernel itself
    assert normal @ normal == pytest.approx(a @ k @ a, rel=5e-3)
    got = oc.one_class_boundary(df, nu, landmarks=len(x)).toPandas().sort_values("id")
    assert abs(got["is_anomaly"].mean() - nu) <= 0.01
    want = k @ a
    assert np.corrcoef(got["anomaly_score"], want)[0, 1] > 0.999
    # Many rows lie on the boundary itself; the others are on the same side of both.
    apart = np.abs(want - np.quantile(want, nu)) > 0.05 * want.std()
    flagged = want < np.quantile(want, nu)
    assert apart.mean() > 0.5 and (flagged == got["is_anomaly"].to_numpy())[apart].all()


def test_few_landmarks_keep_the_share_and_find_what_is_far(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(600, 5)), rng.normal(8, 0.1, (20, 5))])
    got = oc.one_class_boundary(frame(spark, x), 0.1, landmarks=60).toPandas().sort_values("id")
    assert abs(got["is_anomaly"].mean() - 0.1) <= 0.01


def test_odd_rows(spark):
    assert oc.one_class_boundary(spark.createDataFrame([], "id long, vec array<double>")).count() == 0
    same = oc.one_class_boundary(frame(spark, np.ones((6, 3)))).collect()
    assert len(same) == 6 and not any(r["is_anomaly"] for r in same)
