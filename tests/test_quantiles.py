"""Exact quantiles of groups and columns, for any sizes and repeated values."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallywise.functions.quantiles import LINEAR, NEAREST, column_quantiles, group_quantiles

SPECS = {"n0": (0.0, NEAREST), "n25": (0.25, NEAREST), "n75": (0.75, NEAREST), "l1": (0.01, LINEAR),
         "l50": (0.5, LINEAR), "l90": (0.9, LINEAR), "l100": (1.0, LINEAR)}


def expected(values):
    v = np.sort(np.asarray(values, dtype=float))
    return [v[int(np.floor((len(v) - 1) * q + 0.5))] if how == NEAREST else np.quantile(v, q)
            for q, how in SPECS.values()]


def check(df, values_by_group):
    rows = {r["g"]: r for r in group_quantiles(df, ["g"], "x", SPECS).collect()}
    assert set(rows) == set(values_by_group)
    for g, values in values_by_group.items():
        np.testing.assert_allclose([rows[g][n] for n in SPECS], expected(values), rtol=1e-12, atol=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0])), min_size=1,
                         max_size=40), min_size=1, max_size=4))
def test_any_groups(spark, groups):
    data = {i: g for i, g in enumerate(groups)}
    df = spark.createDataFrame([(i, float(x)) for i, g in data.items() for x in g], "g int, x double")
    check(df, data)


@pytest.mark.parametrize("parts", [1, 9])
def test_a_large_group_is_many_ranges(spark, parts):
    rng = np.random.default_rng(0)
    data = {0: np.concatenate([rng.lognormal(4, 2, 9000), np.full(4000, 7.0)]), 1: rng.normal(size=300)}
    frame = pd.concat([pd.DataFrame({"g": g, "x": v}) for g, v in data.items()])
    check(spark.createDataFrame(frame).repartition(parts), data)


@pytest.mark.parametrize("accuracy", [50, 500])
def test_columns_within_brackets(spark, accuracy):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.lognormal(4, 2, 9000), np.full(4000, 7.0)])
    got = column_quantiles(spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5), ["x"], SPECS, accuracy).first()
    np.testing.assert_allclose([got[n] for n in SPECS], expected(x), rtol=1e-12, atol=1e-12)


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 2.0), (2, None)], "g int, x double")
    got = {r["g"]: r["l50"] for r in group_quantiles(df, ["g"], "x", SPECS).collect()}
    assert got == {None: 2.0, 1: 2.0}


def test_nulls_do_not_count(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (None, 7.0)], "a double, b double")
    got = {r["feature"]: r["q"] for r in column_quantiles(df, ["a", "b"], {"q": (0.5, LINEAR)}).collect()}
    assert got == {"a": 1.5, "b": 6.0}


def test_no_task_gets_a_whole_column(spark):
    """Raw rows are never exchanged, and what is ranked in one task is a small part of the column."""
    n = 200_000
    df = spark.range(n, numPartitions=8).selectExpr("cast(hash(id) as double) as x")
    got = column_quantiles(df, ["x"], {"q": (0.37, LINEAR)}, accuracy=1000)
    want = np.quantile([r[0] for r in df.collect()], 0.37)
    assert got.first()["q"] == pytest.approx(want)
    plan = got._jdf.queryExecution().executedPlan()
    got.collect()
    rows = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))
    walk(plan)
    walk(got._jdf.queryExecution().executedPlan())
    assert rows and max(rows) <= n / 20
