"""Fitted models and composed analyses.

The values of a fit depend on its draws, so a query returns, for every row the model labels, what
must hold of it whatever the draws; SQL states the rows and the values that follow.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.vectors import cosine_similarity, squared_distance
from ..operators import anomaly as an
from ..operators import clustering as cl
from ..operators import hierarchy as hi
from ..operators import one_class as oc
from ..operators import similarity as sim
from ..operators import transforms as tr
from ..operators.contributions import isolation_trees, tree_contributions
from ..session import cut_lineage, work_path
from . import analyses
from . import sqltext as S
from .inputs import feats, lfeats, ltx, rounded, users
from .model_inputs import EMB, embedded, plane, plane_sql, scaled_vectors
from .registry import query
from .transform_queries import DIMS, LONG, embedding_columns

#: Cost of the embeddings around the mean of all, and around the means of the given labels.
COSTS = f"""{LONG},
means as (select label, feature, avg(v) as m from long group by label, feature),
whole as (select feature, avg(v) as m from long group by feature),
costs as (select (select sum((v - m) ^ 2) from long join means using (label, feature)) as by_label,
  (select sum((v - m) ^ 2) from long join whole using (feature)) as by_all)"""


def cost(labelled):
    """Sum of squared distances to the means of the clusters, in one row."""
    d = len(labelled.select("vec").first()[0])
    centres = cl.centroid_table(labelled, d).select("cluster_id", "center")
    return labelled.join(centres, "cluster_id").agg(F.sum(squared_distance(F.col("vec"), F.col("center"))))


def partition_rows(df, labels, k, most):
    """(id, in_range, cheap): every row has one of `k` labels and the whole costs at most `most`."""
    joined = cut_lineage(df.drop("cluster_id").join(labels.select("id", "cluster_id"), "id"))
    return joined.select("id", F.col("cluster_id").between(0, k - 1).alias("in_range"),
                         (cost(joined).scalar() <= most).alias("cheap"))


EVERY_VECTOR = "select vec_id as id, true as in_range, true as cheap from embeddings"


@query("j1_kmeans", EVERY_VECTOR)
def kmeans(spark, d):
    """At most as dear as the partition by the given labels, of which there are as many."""
    df = cut_lineage(embedded(spark, d))
    k = df.select("cluster_id").distinct().count()
    return partition_rows(df, cl.kmeans(df, k, restarts=10), k, cost(df).scalar() * 1.02)


@query("j3_choose_k", """select cast(k as int) as k, true as falls, true as is_silhouette
from (select unnest(range(2, 11)) as k)""")
def choose_k(spark, d):
    """Inertia falls with k, silhouettes lie in [-1, 1], and one k of the largest is marked."""
    df = cut_lineage(plane(spark, d))
    found = cut_lineage(cl.choose_k(df, df.count(), max_k=10, restarts=10))
    top = found.agg(F.max("silhouette"), F.count_if("is_best")).first()
    rows = sorted(found.collect(), key=lambda r: r["k"])  # a row per k
    falls = [b["inertia"] <= a["inertia"] * 1.05 for a, b in zip([rows[0], *rows], rows)]
    right = [-1 <= r["silhouette"] <= 1 and top[1] == 1 and r["is_best"] == (r["silhouette"] == top[0]) for r in rows]
    return spark.createDataFrame([(r["k"], a, b) for r, a, b in zip(rows, falls, right)],
                                 "k int, falls boolean, is_silhouette boolean")


@query("j4_bisecting_kmeans", EVERY_VECTOR)
def bisecting(spark, d):
    """Splitting lowers the cost below that of one cluster."""
    df = cut_lineage(embedded(spark, d))
    one = cost(df.withColumn("cluster_id", F.lit(0))).scalar()
    return partition_rows(df, cl.bisecting_kmeans(df, 5), 5, one * 0.999)


@query("j4_ward", EVERY_VECTOR)
def ward(spark, d):
    """At most a twentieth dearer than the partition by the given labels, of which there are as many."""
    df = cut_lineage(embedded(spark, d))
    k = df.select("cluster_id").distinct().count()
    return partition_rows(df, cl.ward(df, k), k, cost(df).scalar() * 1.05)


@query("j6_density_hierarchy")
def density_hierarchy(spark, d):
    """(id, cluster_id) of the embeddings; SQL has no condensed tree, tests compare with all pairs."""
    return hi.hdbscan(embedded(spark, d).select("id", "vec"), "id")


@query("j7_gaussian_mixture", plane_sql("select id, true as in_range, true as is_probability from plane"))
def mixture(spark, d):
    """The likeliest of k components has a probability of 1/k at least."""
    soft = cl.gaussian_mixture(cut_lineage(plane(spark, d)), 4)
    p = F.col("cluster_probability")
    return soft.select("id", F.col("cluster_id").between(0, 3).alias("in_range"),
                       ((p >= 0.25) & (p <= 1 + 1e-9)).alias("is_probability"))


@query("j8_silhouette", f"""with {LONG},
ids as (select distinct vec_id, label from long),
size as (select label, count(*) as n from ids group by label),
sums as (select label, feature, sum(v) as y, sum(v * v) as yy from long group by label, feature),
psi as (select label, sum(yy) as psi from sums group by label),
dots as (select vec_id, long.label as own, sums.label as other, sum(v * v) as xx, sum(v * y) as xy
  from long join sums using (feature) group by all),
far as (select vec_id, own, other, n, greatest(xx + psi / n - 2 * xy / n, 0) as dist
  from dots join size on size.label = other join psi on psi.label = other),
each as (select vec_id, any_value(n) filter (own = other) as n,
  max(dist * n / (n - 1)) filter (own = other and n > 1) as a, min(dist) filter (own <> other) as b
  from far group by vec_id)
select 'label' as cluster_method, round(avg(case when n = 1 then 0 when a < b then 1 - a / b
  when a > b then b / a - 1 else 0 end), 6) as silhouette from each""")
def silhouette(spark, d):
    value = cl.silhouette(embedded(spark, d))
    return rounded(spark.createDataFrame([("label", value)], "cluster_method string, silhouette double"))


@query("j9_compare_methods", """select unnest(['kmeans', 'hierarchical', 'gaussian_mixture', 'dbscan']) as cluster_method,
true as has_run, true as has_metrics""")
def compare_methods(spark, d):
    _, metrics, _ = cl.compare_methods(cut_lineage(plane(spark, d)), 2, 5, eps=0.3, restarts=10)
    return metrics.select("cluster_method", F.col("error").isNull().alias("has_run"), (
        (F.col("n_clusters") >= 1) & F.col("inertia").isNotNull()
        & (F.col("davies_bouldin").isNotNull() | (F.col("n_clusters") == 1))).alias("has_metrics"))


TOTAL_VARIANCE = f"""{LONG}, spread as (select sum(s) as total from (
  select var_samp(v) as s from long group by feature))"""


@query("j13_pca2_projection", f"""with {TOTAL_VARIANCE}
select vec_id, label, round(total, 6) as total_variance, true as is_ordered, true as adds_up
from embeddings, spread""")
def pca2(spark, d):
    """Every row is projected; the variances along the axes are the explained shares of the total."""
    df = cut_lineage(embedding_columns(spark, d))
    model, _, _ = tr.fit_pca(df, DIMS, 2)
    shares = [float(x) for x in model.explainedVariance]
    points = tr.pca_reduce(df, DIMS, 2, keys=("vec_id", "label"))
    seen = points.agg(F.var_samp("PC1").alias("a"), F.var_samp("PC2").alias("b")).first()
    total = df.agg(sum((F.var_samp(c) for c in DIMS), F.lit(0.0)).alias("t")).first()["t"]
    near = all(abs(v - s * total) <= 1e-6 * total for v, s in zip(seen, shares))
    return rounded(points.select("vec_id", "label", F.lit(total).alias("total_variance"),
                                 F.lit(seen["a"] >= seen["b"] > 0).alias("is_ordered"), F.lit(near).alias("adds_up")))


def anomaly_vectors(spark, d):
    return cut_lineage(scaled_vectors(cut_lineage(lfeats(spark, d)), C.ANOMALY_FEATURES))


@query("k1_isolation_forest", S.with_("feats", """select user_id as id, true as is_consistent, true as is_tenth,
true as finds_planted from feats"""))
def isolation_forest(spark, d):
    """Flags are negative scores, a tenth of all rows at most, and far planted rows are among them."""
    vectors = anomaly_vectors(spark, d)
    n, size = vectors.count(), len(C.ANOMALY_FEATURES)
    far = spark.range(1, max(2, n // 200)).select((-F.col("id")).alias("id"), F.array(*[
        F.lit(40.0 if k % 2 else -40.0) + F.col("id") for k in range(size)]).alias("vec"))
    out = cut_lineage(an.isolation_forest(vectors.unionByName(far)))
    flags = out.agg(F.count_if("is_anomaly").alias("n"),
                    F.count_if((F.col("id") < 0) & ~F.col("is_anomaly")).alias("missed")).first()
    return out.where("id >= 0").select(
        "id", (F.col("is_anomaly") == (F.col("anomaly_score") < 0)).alias("is_consistent"),
        F.lit(flags["n"] <= 0.1 * (n + max(1, n // 200 - 1)) + 1).alias("is_tenth"),
        F.lit(flags["missed"] == 0).alias("finds_planted"))


_D, _SIZE = 3, 32
_W, _B = an.rbf_features(_D, _SIZE)
_PLANES = "[" + ", ".join("[" + ", ".join(f"{float(x)!r}::double" for x in (*w, b)) + "]"
                          for w, b in zip(_W, _B)) + "]"


@query("k2_rbf_boundary_score", S.with_("feats", f"""
select id, round(anomaly_score, 6) as anomaly_score, anomaly_score < (select quantile_cont(anomaly_score, 0.1)
  from scored) as is_anomaly from scored""", extra=f"""pts as (select user_id as id, age / 10.0::double as a,
  avg_transaction_amount / 20.0::double as b, avg_hour_of_day / 6.0::double as c from feats),
width as (select sqrt(2.0::double / (3 * (avg((a * a + b * b + c * c) / 3) - avg((a + b + c) / 3) ^ 2))) as g from pts),
planes as (select unnest(range(1, {_SIZE} + 1)) as j, unnest({_PLANES}) as p),
z as (select id, j, cos(g * (p[1] * a + p[2] * b + p[3] * c) + p[4]) as z from pts, width, planes),
m as (select j, avg(z) as m from z group by j),
scored as (select id, round(sum(z * m) * {2.0 / _SIZE!r}::double, 9) as anomaly_score from z join m using (j) group by id)"""))
def rbf_boundary(spark, d):
    pts = feats(spark, d).select(F.col("user_id").alias("id"), F.array(
        F.col("age") / F.lit(10.0), F.col("avg_transaction_amount") / F.lit(20.0),
        F.col("avg_hour_of_day") / F.lit(6.0)).alias("vec"))
    return rounded(an.rbf_boundary_score(pts, _D, 0.1, _SIZE), 6)


@query("k2_one_class_boundary", S.with_("feats", "select count(*) as n_rows, 0.1::double as nu, true as share_is_nu from feats"))
def one_class(spark, d):
    """The share of flagged rows is nu within 1 %, unless equal rows share the border."""
    scored = cut_lineage(oc.one_class_boundary(anomaly_vectors(spark, d)))
    ties = F.count_if(F.abs(F.col("anomaly_score")) <= 1e-9) / F.count("*")
    share = F.count_if("is_anomaly") / F.count("*")
    return scored.agg(F.count("*").alias("n_rows"), F.lit(0.1).alias("nu"), (
        (share <= 0.11) & (share + ties >= 0.09)).alias("share_is_nu"))


_WIDE_W, _WIDE_B = an.rbf_features(len(C.ANOMALY_FEATURES))
_WIDE_PLANES = "[" + ", ".join("[" + ", ".join(f"{float(x)!r}::double" for x in (*w, b)) + "]"
                               for w, b in zip(_WIDE_W, _WIDE_B)) + "]"
_SCALED = ", ".join(
    f"coalesce(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), {c} - avg({c}) over ())::double"
    for c in C.ANOMALY_FEATURES)
_WIDE_DIMS = len(C.ANOMALY_FEATURES)


@query("k2_rbf_all_features", S.with_("lfeats", f"""
select id, round(s, 4) as anomaly_score from scored""", extra=f"""pts as (select user_id as id, [{_SCALED}] as v from lfeats),
width as (select sqrt(2.0::double / ({_WIDE_DIMS} * (avg(list_sum(list_transform(v, lambda x: x * x)) / {_WIDE_DIMS})
  - avg(list_sum(v) / {_WIDE_DIMS}) ^ 2))) as g from pts),
planes as (select unnest(range(1, {len(_WIDE_B)} + 1)) as j, unnest({_WIDE_PLANES}) as p),
z as (select id, j, cos(g * list_dot_product(p[1:{_WIDE_DIMS}], v) + p[{_WIDE_DIMS + 1}]) as z from pts, width, planes),
m as (select j, avg(z) as m from z group by j),
scored as (select id, sum(z * m) * {2.0 / len(_WIDE_B)!r}::double as s from z join m using (j) group by id)"""))
def rbf_all(spark, d):
    scored = an.rbf_boundary_score(anomaly_vectors(spark, d), len(C.ANOMALY_FEATURES))
    return rounded(scored.select("id", "anomaly_score"), 4)


def labelled_vectors(spark, d):
    truth = an.ground_truth(users(spark, d), ltx(spark, d)).withColumnRenamed("user_id", "id")
    return cut_lineage(anomaly_vectors(spark, d).join(truth, "id"))


@query("k5_supervised_forest", S.with_("ltx users", """
select u.user_id as id, coalesce(r > 0.1, false) as is_anomaly, true as is_probability, true as is_accurate
from users u left join (select user_id, avg(case when is_noise then 1.0::double else 0 end) as r
  from ltx group by user_id) n on n.user_id = u.user_id"""))
def supervised_forest(spark, d):
    """Its labels, and that it tells at least 95 of 100 rows right; with too few positives no row is told."""
    df = labelled_vectors(spark, d)
    out = an.supervised_forest(df)
    if out is None:
        return df.select("id", "is_anomaly", F.lit(True).alias("is_probability"), F.lit(True).alias("is_accurate"))
    both = cut_lineage(out.select("id", "anomaly_score", F.col("is_anomaly").alias("told")).join(
        df.select("id", "is_anomaly"), "id"))
    right = both.agg(F.avg((F.col("told") == F.col("is_anomaly")).cast("int"))).scalar()
    return both.select("id", "is_anomaly", F.col("anomaly_score").between(0, 1).alias("is_probability"),
                       (right >= 0.95).alias("is_accurate"))


@query("k6_explain_contributions", S.with_("feats", "select feature, (select count(*) from feats) as n_rows, "
       "0.0::double as largest_gap from (select unnest([" + ", ".join(f"'{c}'" for c in C.ANOMALY_FEATURES)
       + "]) as feature)"))
def explain(spark, d):
    """Contributions of every row, and by how much they and the base miss the row's mean depth."""
    vectors = anomaly_vectors(spark, d)
    size = an.tree_rows(vectors)
    forest = cut_lineage(an.fit_isolation_forest(vectors, rows_per_tree=size))
    parts = cut_lineage(tree_contributions(vectors, isolation_trees(forest), C.ANOMALY_FEATURES))
    expected = an.expected_depth(size)
    depth = an.forest_score(vectors, forest, size).select(
        "id", (-F.log2(-F.col("raw_score")) * F.lit(expected)).alias("depth"))
    gap = parts.groupBy("id").agg((F.sum("contribution") + F.max("base")).alias("sum")).join(depth, "id").agg(
        F.max(F.abs(F.col("sum") - F.col("depth"))))
    return parts.groupBy("feature").agg(F.count("*").alias("n_rows")).withColumn(
        "largest_gap", F.round(gap.scalar(), 9))


@query("l5_knn_lsh", f"""with {EMB}
select id as query_id, true as has_ten, true as is_exact, true as recalls from emb""")
def knn_lsh(spark, d):
    """Ten neighbours of every row at their true distances, most of them the nearest there are."""
    v = cut_lineage(embedded(spark, d).select("id", "vec"))
    hits = cut_lineage(sim.knn_lsh(v, 64, k=10))
    exact = cut_lineage(sim.knn(v, v, 10))
    a, b = (v.select(F.col("id").alias(n), F.col("vec").alias(f"v_{n}")) for n in ("query_id", "similar_id"))
    true = F.lit(1.0) - F.round(cosine_similarity(F.col("v_query_id"), F.col("v_similar_id")), 9)
    checked = hits.join(a, "query_id").join(b, "similar_id").withColumn(
        "right", F.abs(F.col("distance") - true) < 1e-6)
    found = hits.join(exact.select("query_id", "similar_id"), ["query_id", "similar_id"]).agg(F.count("*")).scalar()
    recall = found / exact.agg(F.count("*")).scalar()
    return checked.groupBy("query_id").agg((F.count("*") == 10).alias("has_ten"), F.every("right").alias("is_exact"),
                                           (F.first(recall) >= 0.9).alias("recalls"))


@query("j15_clustering_analysis", S.with_("users", """select user_id, cluster_method, true as has_distance, true as has_probability
from users, (select unnest(['kmeans', 'hierarchical', 'gaussian_mixture', 'dbscan']) as cluster_method)"""))
def clustering_analysis(spark, d):
    """Every method labels every user; distances stand beside labels, probabilities beside soft ones."""
    rows = analyses.clustering_analysis(feats(spark, d), work_path(spark, "clustering"))["results"]
    return rows.select("user_id", "cluster_method", (
        (F.col("cluster_id") == cl.NOISE) == F.col("distance_to_center").isNull()).alias("has_distance"), (
        (F.col("cluster_method") == "gaussian_mixture") == F.col("cluster_probability").isNotNull()
        ).alias("has_probability"))


@query("k12_anomaly_analysis", S.with_("users ltx", """
select user_id, anomaly_method, true as has_score, true as one_explained
from users, (select unnest(case when positives >= 5 and positives < total
    then ['isolation_forest', 'one_class', 'supervised'] else ['isolation_forest', 'one_class'] end) as anomaly_method from (
    select (select count(*) from users) as total, count(*) as positives from (
      select user_id from ltx group by user_id having avg(case when is_noise then 1.0::double else 0 end) > 0.1)))"""))
def anomaly_analysis(spark, d):
    """Every method scores every user; the chosen one, and it alone, stores the importance of every feature."""
    truth = an.ground_truth(users(spark, d), ltx(spark, d))
    rows = analyses.anomaly_analysis(lfeats(spark, d), truth, work_path(spark, "anomaly"))["results"]
    n = F.coalesce(F.size(F.from_json("feature_importance", "map<string,double>")), F.lit(0))
    stored = W.partitionBy("user_id")
    return rows.withColumn("n", n).select(
        "user_id", "anomaly_method", F.col("anomaly_score").isNotNull().alias("has_score"),
        ((F.sum("n").over(stored) == len(C.ANOMALY_FEATURES))
         & (F.max("n").over(stored) == len(C.ANOMALY_FEATURES))).alias("one_explained"))


@query("l11_similarity_analysis", S.with_("users", f"""select user_id as query_user_id, 10::bigint as n_hits, true as is_score
from users where {S.u('user_id', 'new')} < 0.1::double"""))
def similarity_analysis(spark, d):
    rows = analyses.similarity_analysis(feats(spark, d), work_path(spark, "similarity"))["results"]
    return rows.groupBy("query_user_id").agg(
        F.count("*").alias("n_hits"),
        F.every(F.col("similarity_score").between(-1 - 1e-9, 1 + 1e-9)).alias("is_score"))
