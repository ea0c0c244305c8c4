"""Neighbour-based mutual information against all pairs, with blocks cut small."""

import math

import numpy as np
import pandas as pd
import pytest

from tallywise.operators import transforms as t


def digamma(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(v, y, k=3):
    keep = np.array([(y == c).sum() > 1 for c in y])
    v, y = v[keep], y[keep]
    total = 0.0
    for i in range(len(v)):
        own = np.abs(np.delete(v[y == y[i]], np.flatnonzero(np.flatnonzero(y == y[i]) == i)) - v[i])
        near = min(k, len(own))
        r = np.sort(own)[near - 1]
        m = (np.abs(v - v[i]) < r).sum() if r else (v == v[i]).sum()
        total += digamma(near) - digamma(len(own) + 1) - digamma(m)
    return max(0.0, digamma(len(v)) + total / len(v))


@pytest.mark.parametrize("block", [7, 10_000])
def test_equals_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 200)
    y[:5] = [7, 8, 8, 9, 9]  # a class of one row and two of two
    x = {"told": y + rng.normal(0, 0.3, 200), "free": rng.normal(size=200), "tied": rng.integers(0, 4, 200) / 4.0,
         "same": np.ones(200)}
    df = spark.createDataFrame(pd.DataFrame({**x, "y": y}))
    got = {r["feature"]: r["mi"] for r in t.neighbour_information(df, "y", list(x), block_rows=block).collect()}
    assert got == {c: pytest.approx(brute(v, y), abs=1e-9) for c, v in x.items()}
    assert got["told"] > 0.4 > got["free"]


def test_odd_rows(spark):
    kind = "a double, y string"
    none = spark.createDataFrame([], kind)
    assert t.neighbour_information(none, "y", ["a"]).count() == 0
    alone = spark.createDataFrame([(1.0, "p"), (2.0, "q"), (None, "p"), (3.0, None)], kind)
    assert t.neighbour_information(alone, "y", ["a"]).count() == 0


def test_digamma(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 10, 1000)], "n long")
    for n, value in df.select("n", t.digamma(t.F.col("n"))).collect():
        assert math.isclose(value, digamma(n), abs_tol=1e-10)
