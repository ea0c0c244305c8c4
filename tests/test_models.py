"""Invariants of fitted models, transforms and explanations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywise import constants as C
from tallywise.operators import anomaly as an
from tallywise.operators import clustering as cl
from tallywise.operators import transforms as tr
from tallywise.plans import analyses
from tallywise.plans.inputs import feats, ltx, users
from tallywise.session import work_path

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.2, (60, 3)) for c in ((0, 0, 0), (4, 4, 0), (0, 4, 4))])
    pdf = pd.DataFrame({"id": np.arange(180), "vec": list(map(list, x)), "truth": np.repeat([0, 1, 2], 60)})
    return spark.createDataFrame(pdf, "id long, vec array<double>, truth int").cache()


def agree(labels, blobs):
    rows = labels.join(blobs.select("id", "truth"), "id").groupBy("truth").agg(
        F.count_distinct("cluster_id").alias("n"), F.first("cluster_id").alias("c")).collect()
    return all(r["n"] == 1 for r in rows) and len({r["c"] for r in rows}) == 3


def test_clusterers_find_the_blobs(blobs):
    assert agree(cl.kmeans(blobs, 3, restarts=4), blobs)
    assert agree(cl.bisecting_kmeans(blobs, 3), blobs)
    soft = cl.gaussian_mixture(blobs, 3)
    assert soft.where("cluster_probability < 0.333 or cluster_probability > 1.0000001").count() == 0


def test_choose_k_and_compare(blobs):
    rows = cl.choose_k(blobs, 180, max_k=5, restarts=3).collect()
    assert [r["k"] for r in rows] == [2, 3, 4, 5] and [r["k"] for r in rows if r["is_best"]] == [3]
    labels, metrics, best = cl.compare_methods(blobs.select("id", "vec"), 3, 3, eps=1.0)
    assert metrics.where("error is not null").count() == 0 and best in {
        r["cluster_method"] for r in metrics.collect()}
    assert labels.groupBy("cluster_method").count().where("count != 180").count() == 0


def test_metrics_against_numpy(blobs):
    df = blobs.withColumn("cluster_id", F.col("truth"))
    pdf = df.toPandas()
    x, y = np.stack(pdf["vec"]), pdf["truth"].to_numpy()
    c = np.stack([x[y == i].mean(0) for i in range(3)])
    dist = np.linalg.norm(x - c[y], axis=1)
    between = sum((y == i).sum() * ((c[i] - x.mean(0)) ** 2).sum() for i in range(3))
    s = np.array([dist[y == i].mean() for i in range(3)])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(3) if j != i) for i in range(3)])
    m = cl.cluster_metrics(df, 3).first()
    assert m["inertia"] == pytest.approx((dist ** 2).sum())
    assert m["calinski_harabasz"] == pytest.approx(between / 2 / ((dist ** 2).sum() / 177))
    assert m["davies_bouldin"] == pytest.approx(db)


def test_noise_is_left_out_of_profiles_but_not_of_the_mean(spark):
    df = spark.createDataFrame([(1, 0, 10.0), (2, 0, 20.0), (3, -1, 90.0)], "user_id long, cluster_id int, x double")
    row = cl.cluster_profiles(df, ["x"]).collect()
    assert len(row) == 1 and row[0]["overall_mean"] == 40.0 and row[0]["cluster_mean"] == 15.0
    assert row[0]["percentage"] == pytest.approx(200 / 3)


def test_isolation_forest_flags_planted_outliers(spark, blobs):
    far = spark.createDataFrame([(900 + i, [20.0 + i, -20.0, 20.0]) for i in range(5)], "id long, vec array<double>")
    df = blobs.select("id", "vec").unionByName(far)
    out = an.isolation_forest(df, 0.1).cache()
    assert out.where("is_anomaly and id >= 900").count() == 5
    assert out.where("is_anomaly").count() <= 19
    again = an.isolation_forest(df.repartition(9), 0.1)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_forest_on_a_large_table(spark):
    df = spark.range(30_000).select("id", F.array(F.rand(1), F.rand(2)).alias("vec"))
    forest = an.fit_isolation_forest(df, trees=20, rows_per_tree=64).toPandas()
    assert forest["tree"].nunique() == 20 and len(forest) < 20 * 2 * 64 * 2


def test_rbf_score_prefers_the_crowd(spark, blobs):
    df = blobs.select("id", "vec").where("id < 60").unionByName(
        spark.createDataFrame([(900, [9.0, 9.0, 9.0])], "id long, vec array<double>"))
    out = an.rbf_boundary_score(df, 3, 0.05, size=64)
    assert out.orderBy("anomaly_score").first()["id"] == 900


def test_supervised_forest_and_its_skip(blobs):
    df = blobs.withColumn("is_anomaly", F.col("truth") == 2)
    out = an.supervised_forest(df).join(blobs, "id")
    assert out.where("is_anomaly != (truth = 2)").count() == 0
    assert an.fit_supervised(df.withColumn("is_anomaly", F.col("id") < 4)) is None


def test_shapley_values_add_up(blobs):
    vec = lambda df: df.withColumn("score", F.col("vec")[0] * 2 + F.col("vec")[1] * F.col("vec")[2])
    rows = blobs.select("id", "vec").where("id % 30 = 0")
    background = blobs.select("id", "vec").where("id = 17")  # one row, so the base value is known
    parts = an.shapley_contributions(rows, background, NAMES, vec, 6)
    total = parts.groupBy("id").agg(F.sum("contribution").alias("s"), F.count("*").alias("n"))
    base = vec(background).first()["score"]
    assert parts.where(F.abs(F.col("base") - base) > 1e-9).count() == 0
    for r in total.join(vec(rows), "id").collect():
        assert r["n"] == 3 and r["s"] == pytest.approx(r["score"] - base)


def test_scaler_and_unseen_category(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, "x"), (2, 3.0, 5.0, "y")], "user_id long, a double, k double, t string")
    out = tr.scale(df, tr.fit_scaler(df, ["a", "k"]), ["a", "k"])
    assert sorted(map(tuple, out.select("a", "k").collect())) == [(-1.0, 0.0), (1.0, 0.0)]
    labels = tr.fit_labels(df, ["t"])
    new = spark.createDataFrame([(3, "y"), (4, "zz"), (5, None)], "user_id long, t string")
    assert {r["user_id"]: r["t"] for r in tr.label_encode(new, labels, ["t"]).collect()} == {3: 1, 4: 0, 5: 0}


def test_codes_are_places_in_text_order(spark, folder):
    df = users(spark, folder)
    got = {(r["feature"], r["value"]): r["code"] for r in tr.fit_labels(df, ["city", "province"]).collect()}
    want = {(c, v): k for c in ("city", "province")
            for k, v in enumerate(sorted({r[0] for r in df.select(c).distinct().collect()}))}
    assert got == want


def test_empty_category_column_is_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "user_id long, t string")
    assert {r["t"] for r in tr.impute_mode(df, tr.fit_modes(df, ["t"]), ["t"]).collect()} == {"unknown"}


def test_flags_are_never_scaled(spark):
    df = spark.createDataFrame([(1, 2.0, True), (2, 4.0, False)], "user_id long, a double, is_new_user boolean")
    out = tr.FeatureSteps().fit(df)
    assert {r["user_id"]: r["is_new_user"] for r in out.collect()} == {1: True, 2: False}


def test_steps_apply_what_was_fitted(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "user_id long, a double")
    steps = tr.FeatureSteps()
    steps.fit(df)
    new = spark.createDataFrame([(9, None)], "user_id long, a double")
    assert steps.apply(new).first()["a"] == pytest.approx(0.0)


def test_pca_components(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 2))
    x = np.c_[base[:, 0], base[:, 0] * 2 + 10, base[:, 1] * 0.1, base[:, 0] - base[:, 1] * 0.1]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("pqrs")).assign(user_id=np.arange(200)))
    out = tr.pca_reduce(df, list("pqrs"), variance_threshold=0.95).toPandas()
    assert list(out.columns) == ["user_id", "PC1"]
    full = tr.pca_reduce(df, list("pqrs"), n_components=4).toPandas().drop(columns="user_id").to_numpy()
    cov = np.cov(full.T)
    assert np.allclose(full.mean(0), 0, atol=1e-9) and np.allclose(cov - np.diag(np.diag(cov)), 0, atol=1e-8)
    assert np.isclose(np.trace(cov), np.trace(np.cov(x.T)))


def test_anova_against_numpy(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"user_id": np.arange(90), "y": np.arange(90) % 3, "p": rng.normal(1e6, 1, 90),
                        "q": (np.arange(90) % 3) + rng.normal(0, 0.1, 90)})
    got = {r["feature"]: r["f_score"] for r in tr.anova_scores(spark.createDataFrame(pdf), "y", ["p", "q"]).collect()}
    for c in ("p", "q"):
        groups = [pdf[c][pdf["y"] == i] for i in range(3)]
        m = pdf[c].mean()
        ssb = sum(len(g) * (g.mean() - m) ** 2 for g in groups)
        ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
        assert got[c] == pytest.approx((ssb / 2) / (ssw / 87), rel=1e-6)
    best = tr.select_k_best(spark.createDataFrame(pdf), tr.anova_scores(
        spark.createDataFrame(pdf), "y", ["p", "q"]), "f_score", "y", 1)
    assert best.columns == ["user_id", "q", "y"]


def test_composed_analyses(spark, folder):
    f = feats(spark, folder)
    sim_out = analyses.similarity_analysis(f, work_path(spark, "t-sim"))
    assert sim_out["results"].count() == sim_out["hits"].count() > 0
    truth = an.ground_truth(users(spark, folder), ltx(spark, folder))
    out = analyses.anomaly_analysis(f, truth, work_path(spark, "t-an"))
    methods = {r["anomaly_method"]: r["count"] for r in out["results"].groupBy("anomaly_method").count().collect()}
    assert set(methods.values()) == {150} and {"isolation_forest", "one_class"} <= set(methods)
    assert out["importance"].count() == len(C.ANOMALY_FEATURES)
    assert out["evaluation"].first()["tp"] is not None


def test_clustering_analysis(spark, folder):
    out = analyses.clustering_analysis(feats(spark, folder), work_path(spark, "t-cl"), k=3, restarts=2)
    assert out["metrics"].where("error is null").count() == 4
    assert out["results"].groupBy("cluster_method").count().where("count = 150").count() == 4
    assert out["profiles"].count() > 0


def test_davies_bouldin_in_blocks(spark, blobs, monkeypatch):
    df = blobs.withColumn("cluster_id", (F.col("id") % 7).cast("int"))
    whole = cl.cluster_metrics(df, 3).first()["davies_bouldin"]
    monkeypatch.setattr(cl, "CENTER_BLOCK", 2)
    assert cl.cluster_metrics(df, 3).first()["davies_bouldin"] == pytest.approx(whole)
