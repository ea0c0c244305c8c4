"""Clustering, anomaly and similarity queries that SQL can check."""

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import anomaly as an
from ..operators import clustering as cl
from ..operators import density
from ..operators import neighbours as nb
from ..operators import relational as rel
from ..operators import reports as rep
from ..operators import similarity as sim
from ..operators.synth import with_user_age
from . import sqltext as S
from ..session import cut_lineage
from .inputs import feats, lfeats, ltx, rounded, tx, users
from .model_inputs import EMB, FLAGGED, HITS, embedded, plane, plane_sql, scaled_vectors, with_new_flag
from .registry import query

# -- range join and density -------------------------------------------------------------------


@query("c10_eps_range_self_join", plane_sql("""
select a.id as id_a, b.id as id_b, round(sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2), 6) as distance
from plane_sites a join plane_sites b on a.id < b.id
where (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 <= 0.25"""))
def eps_range_self_join(spark, d):
    return rounded(nb.eps_pairs(nb.sites(plane(spark, d), "id"), "site", 0.5, [0, 1]))


@query("c10_eps_range_self_join_sliced", plane_sql("""
select a.id as id_a, b.id as id_b, round(sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2), 6) as distance
from plane_sites a join plane_sites b on a.id < b.id
where (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 <= 1.0"""))
def eps_range_self_join_sliced(spark, d):
    return rounded(nb.eps_pairs(nb.sites(plane(spark, d), "id"), "site", 1.0, [0, 1], slice_rows=16))


_NEAR = """near as (select a.id as a, b.id as b, b.weight from plane_sites a join plane_sites b
  on (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 <= 0.09),
cores as (select a as id from near group by a having sum(weight) >= 5),
links as (select a, b from near where a in (select id from cores) and b in (select id from cores)),
recursive_reach as (select id as a, id as b from cores union
  select r.a, l.b from recursive_reach r join links l on r.b = l.a),
roots as (select a as id, min(b) as cluster_id from recursive_reach group by a),
border as (select n.a as id, min(r.cluster_id) as cluster_id from near n join roots r on n.b = r.id
  where n.a not in (select id from cores) group by n.a),
named as (select id, cluster_id, true as is_core from roots union all select id, cluster_id, false from border)"""


@query("j5_dbscan", plane_sql("""
select p.id, coalesce(n.cluster_id, -1) as cluster_id, coalesce(n.is_core, false) as is_core
from plane p join plane_sites s using (x, y) left join named n on n.id = s.id""", extra=_NEAR))
def dbscan(spark, d):
    return nb.dbscan(plane(spark, d), "id", 0.3, 2, 5)


def _wide_sql(points: str, eps: float) -> str:
    """Density clusters of `points` (id, v) by all pairs of distinct vectors, five points within `eps` being dense."""
    return f"""{points},
sites as (select v, min(id) as id, count(*) as weight from points group by v),
near as (select a.id as a, b.id as b, b.weight from sites a join sites b on list_distance(a.v, b.v) <= {eps}::double),
cores as (select a as id from near group by a having sum(weight) >= 5),
links as (select a, b from near where a in (select id from cores) and b in (select id from cores)),
recursive_reach as (select id as a, id as b from cores union
  select r.a, l.b from recursive_reach r join links l on r.b = l.a),
roots as (select a as id, min(b) as cluster_id from recursive_reach group by a),
border as (select n.a as id, min(r.cluster_id) as cluster_id from near n join roots r on n.b = r.id
  where n.a not in (select id from cores) group by n.a),
named as (select id, cluster_id, true as is_core from roots union all select id, cluster_id, false from border)
select p.id, coalesce(n.cluster_id, -1) as cluster_id, coalesce(n.is_core, false) as is_core
from points p join sites s using (v) left join named n on n.id = s.id"""


@query("j5_dbscan_embeddings", "with recursive " + _wide_sql(
    "points as (select vec_id as id, embedding::double[] as v from embeddings)", 0.6))
def dbscan_embeddings(spark, d):
    return density.dbscan(embedded(spark, d).select("id", "vec"), "id", 0.6)


_FEATURE_ROWS = ", ".join(
    f"coalesce(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), {c} - avg({c}) over ())::double"
    for c in C.ANOMALY_FEATURES)


_WIDE_ROWS, _WIDE_LABELS = _wide_sql(f"points as (select user_id as id, [{_FEATURE_ROWS}] as v from lfeats)", 1.0).split(
    "\nselect p.id", 1)


@query("j5_dbscan_features", S.with_("lfeats", "select p.id" + _WIDE_LABELS, extra=_WIDE_ROWS))
def dbscan_features(spark, d):
    return density.dbscan(scaled_vectors(cut_lineage(lfeats(spark, d)), C.ANOMALY_FEATURES), "id", 1.0)


@query("j6_density_score", plane_sql("""
select p.id, case when k.dist <= 0.6::double then round(k.dist, 6) end as core_distance,
  coalesce(k.dist > 0.6::double, true) as is_sparse
from plane p left join (select a, dist from (select a.id as a, sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2) as dist,
    row_number() over (partition by a.id order by (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2) as rn
  from plane a join plane b on a.id <> b.id) where rn = 5) k on k.a = p.id"""))
def density_score(spark, d):
    return rounded(nb.density_score(plane(spark, d), "id", 0.6, 2, 5))


# -- clustering -------------------------------------------------------------------------------

START = [[2.0, 0.5], [4.5, 2.0], [7.0, 1.0], [5.0, 0.0]]


def _lloyd(steps: int) -> str:
    rows = ", ".join(f"({i}, {x!r}::double, {y!r}::double)" for i, (x, y) in enumerate(START))
    parts = [f"c0(i, cx, cy) as (values {rows})"]
    for s in range(steps + 1):
        parts.append(f"""a{s} as (select id, x, y, i, dd from (select p.*, c.i,
  round((x - cx) ^ 2 + (y - cy) ^ 2, 12) as dd,
  row_number() over (partition by p.id order by round((x - cx) ^ 2 + (y - cy) ^ 2, 12), c.i) as rn
  from plane p, c{s} c) where rn = 1)""")
        if s < steps:
            parts.append(f"""c{s + 1} as (select c.i, coalesce(m.cx, c.cx) as cx, coalesce(m.cy, c.cy) as cy
  from c{s} c left join (select i, avg(x) as cx, avg(y) as cy from a{s} group by i) m using (i))""")
    return ",\n".join(parts)


@query("j2_kmeans_fixed_init", plane_sql("""
select id, cast(i as int) as cluster_id, round(sqrt(dd), 6) as distance_to_center from a4""", extra=_lloyd(4)))
def kmeans_fixed_init(spark, d):
    return rounded(cl.kmeans_fixed_init(plane(spark, d), START, 4))


_LONG = EMB + """,
long as (select id, cluster_id, unnest(range(1, 65)) as i, unnest(v) as x from emb),
centers as (select cluster_id, i, avg(x) as m, count(*) as n from long group by cluster_id, i),
dists as (select id, cluster_id, sqrt(sum((x - m) ^ 2)) as dist from long join centers using (cluster_id, i)
  group by id, cluster_id)"""


@query("j8_cluster_metrics", f"""with {_LONG},
scatter as (select cluster_id, avg(dist) as s from dists group by cluster_id),
grand as (select i, avg(x) as g from long group by i),
gaps as (select a.cluster_id as ca, b.cluster_id as cb, sqrt(sum((a.m - b.m) ^ 2)) as dist
  from centers a join centers b using (i) where a.cluster_id <> b.cluster_id group by 1, 2)
select cast(count(distinct cluster_id) as int) as n_clusters, round(sum(dist ^ 2), 6) as inertia,
  round(((select sum(n * (m - g) ^ 2) from centers join grand using (i)) / (count(distinct cluster_id) - 1))
    / (sum(dist ^ 2) / (count(*) - count(distinct cluster_id))), 6) as calinski_harabasz,
  round((select avg(r) from (select ca, max((sa.s + sb.s) / dist) as r from gaps
    join scatter sa on sa.cluster_id = ca join scatter sb on sb.cluster_id = cb group by ca)), 6) as davies_bouldin
from dists""")
def cluster_metrics(spark, d):
    return rounded(cl.cluster_metrics(embedded(spark, d), 64))


@query("j12_distance_to_center", f"""with {_LONG}
select id, cluster_id, round(dist, 6) as distance_to_center from dists""")
def distance_to_center(spark, d):
    return rounded(cl.distance_to_center(embedded(spark, d), 64).select(
        "id", "cluster_id", "distance_to_center"))


PROFILED = ["total_amount", "avg_transaction_amount", "age", "avg_hour_of_day", "regularity_score"]
_PROFILES = f"""labelled as (select f.*, case when label = 9 then -1 else label end as cluster_id
  from feats f join embeddings on vec_id = user_id),
profiles as (select cluster_id, size, percentage, feature, cluster_mean, overall_mean,
  case when overall_mean <> 0 then cluster_mean / overall_mean else 1 end as difference_ratio from ({' union all '.join(
    f'''select cluster_id, count(*) as size, count(*) * 100.0::double / (select count(*) from labelled) as percentage,
      '{c}' as feature, avg({c}) as cluster_mean, (select avg({c}) from labelled) as overall_mean
      from labelled where cluster_id <> -1 group by cluster_id''' for c in PROFILED)}))"""


def profiled(spark, d):
    labels = embedded(spark, d).select(F.col("id").alias("user_id"), F.when(
        F.col("cluster_id") == 9, F.lit(-1)).otherwise(F.col("cluster_id")).alias("cluster_id"))
    return cl.cluster_profiles(feats(spark, d).join(labels, "user_id"), PROFILED)


@query("j10_cluster_profiles", S.with_("feats", """
select cluster_id, size, round(percentage, 6) as percentage, feature, round(cluster_mean, 6) as cluster_mean,
  round(overall_mean, 6) as overall_mean, round(difference_ratio, 6) as difference_ratio from profiles""",
    extra=_PROFILES))
def cluster_profiles(spark, d):
    return rounded(profiled(spark, d))


@query("j11_dominant_characteristics", S.with_("feats", """
select cluster_id, feature, round(difference_ratio, 6) as difference_ratio,
  case when difference_ratio > 1 then 'high' else 'low' end as direction
from profiles where abs(difference_ratio - 1) > 0.3""", extra=_PROFILES))
def dominant(spark, d):
    return rounded(cl.dominant_characteristics(profiled(spark, d)).select(
        "cluster_id", "feature", "difference_ratio", "direction"))


@query("j14_cluster_sizes", """
select cluster_id, count(*) as cnt, round(count(*) * 100.0::double / (select count(*) from embeddings), 6) as percentage
from (select case when label = 9 then -1 else label end as cluster_id from embeddings)
where cluster_id <> -1 group by cluster_id""")
def cluster_sizes(spark, d):
    labels = embedded(spark, d).withColumn("cluster_id", F.when(
        F.col("cluster_id") == 9, F.lit(-1)).otherwise(F.col("cluster_id")))
    return rounded(cl.cluster_sizes(labels))


# -- anomaly ----------------------------------------------------------------------------------

@query("k3_flag_by_quantile", S.with_("tx", """
select transaction_id, amount, amount < (select quantile_cont(amount, 0.1) from tx) as is_anomaly from tx"""))
def flag_by_quantile(spark, d):
    return an.flag_lowest(tx(spark, d).select("transaction_id", "amount"), "amount", 0.1)


_TRUTH = """truth as (select user_id, coalesce(ratio > 0.1::double, false) as is_anomaly from users
  left join (select user_id, sum(is_noise::int)::double / count(*) as ratio from ltx group by user_id) using (user_id))"""


@query("k4_ground_truth", S.with_("ltx", "select * from truth", extra=_TRUTH))
def ground_truth(spark, d):
    return an.ground_truth(users(spark, d), ltx(spark, d))


@query("k5b_balanced_weights", S.with_("ltx", """
select is_anomaly, count(*) as cnt, round((select count(*) from truth) / (2.0::double * count(*)), 6) as weight
from truth group by is_anomaly""", extra=_TRUTH))
def balanced_weights(spark, d):
    return rounded(an.balanced_weights(an.ground_truth(users(spark, d), ltx(spark, d)), "is_anomaly"))


RULED = f"""ruled as (select *, nullif(concat_ws(',', case when rule_location then '{C.NOISE_LABELS[0]}' end,
  case when rule_age_amount then '{C.NOISE_LABELS[1]}' end, case when rule_time then '{C.NOISE_LABELS[2]}' end,
  case when rule_amount then '{C.NOISE_LABELS[3]}' end), '') as rule_noise_type from (
  select t.*, city in ({', '.join(repr(c) for c in C.REMOTE_CITIES)}) as rule_location,
    coalesce(age, 30) < 25 and amount >= 5000000 as rule_age_amount, hour_of_day between 2 and 5 as rule_time,
    amount >= 30000000 or amount <= 800 as rule_amount
  from ltx t left join (select user_id, age from users) using (user_id)))"""


def ruled(spark, d):
    return an.rule_flags(with_user_age(ltx(spark, d), users(spark, d)))


_RULE_COLS = "rule_location, rule_age_amount, rule_time, rule_amount, rule_noise_type"


@query("k13_rule_flags", S.with_("ltx", f"select transaction_id, {_RULE_COLS} from ruled", extra=RULED))
def rule_flags(spark, d):
    return ruled(spark, d).select("transaction_id", *_RULE_COLS.split(", "))


def _confusion(pred: str, actual: str, table: str) -> str:
    return f"""select tp, fp, fn, tn, round(coalesce(tp::double / nullif(tp + fp, 0), 0), 6) as precision,
  round(coalesce(tp::double / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2.0::double * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1
from (select count(*) filter ({pred} and {actual}) as tp, count(*) filter ({pred} and not {actual}) as fp,
  count(*) filter (not {pred} and {actual}) as fn, count(*) filter (not {pred} and not {actual}) as tn from {table})"""


@query("k8_detector_evaluation", S.with_("ltx", _confusion("rule_location", "is_noise", "ruled"), extra=RULED))
def detector_evaluation(spark, d):
    return rounded(an.detector_evaluation(ruled(spark, d), "rule_location", "is_noise"))


# Three deterministic detectors on users: share of small-hour rows, of remote cities, ground truth.
_RESULTS = _TRUTH + f""",
per as (select user_id, avg(case when hour_of_day between 2 and 5 then 1.0::double else 0.0::double end) as night,
  avg(case when city in ({', '.join(repr(c) for c in C.REMOTE_CITIES)}) then 1.0::double else 0.0::double end) as remote
  from ltx group by user_id),
results as (select user_id, 'night' as anomaly_method, -night as anomaly_score, night > 0.25::double as is_anomaly from per
  union all select user_id, 'remote', -remote, remote > 0.05::double from per
  union all select user_id, 'truth', case when is_anomaly then -1.0::double else 0.0::double end, is_anomaly from truth)"""


def results(spark, d):
    t = ltx(spark, d)
    one = lambda cond: F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))
    per = t.groupBy("user_id").agg(one(F.col("hour_of_day").between(2, 5)).alias("night"),
                                   one(F.col("city").isin(C.REMOTE_CITIES)).alias("remote"))
    rows = lambda c, limit: per.select("user_id", (-F.col(c)).alias("anomaly_score"),
                                       (F.col(c) > limit).alias("is_anomaly"))
    truth = an.ground_truth(users(spark, d), t).select("user_id", F.when(
        F.col("is_anomaly"), F.lit(-1.0)).otherwise(F.lit(0.0)).alias("anomaly_score"), "is_anomaly")
    frames = [an.anomaly_result_rows(f, m) for m, f in (
        ("night", rows("night", 0.25)), ("remote", rows("remote", 0.05)), ("truth", truth))]
    return rel.concat_vertical(*frames)


@query("f5_argmax_select", S.with_("ltx", """
select anomaly_method, round(avg(anomaly_score), 6) as score from results group by anomaly_method
order by avg(anomaly_score) desc, anomaly_method limit 1""", extra=_RESULTS))
def argmax_select(spark, d):
    means = results(spark, d).groupBy("anomaly_method").agg(F.avg("anomaly_score").alias("score"))
    return rounded(rel.best_by(means, "anomaly_method", "score"))


@query("k7_select_detector", S.with_("ltx", """
select anomaly_method as best_method, count(*) filter (is_anomaly) as n_flags from results
group by anomaly_method order by anomaly_method <> 'supervised', n_flags desc, anomaly_method limit 1""",
    extra=_RESULTS))
def select_detector(spark, d):
    return an.select_detector(results(spark, d))


@query("k9_anomaly_pattern_summary", S.with_("ltx", """
select anomaly_method, count(*) as total, count(*) filter (is_anomaly) as anomalies,
  round(count(*) filter (is_anomaly) * 100.0::double / count(*), 6) as anomaly_rate,
  round(avg(anomaly_score), 6) as mean_score from results group by anomaly_method""", extra=_RESULTS))
def pattern_summary(spark, d):
    return rounded(an.pattern_summary(results(spark, d)))


_FLAG_PROFILE = " union all ".join(f"""select flagged, count(*) as size, '{c}' as feature, round(avg({c}), 6) as cluster_mean,
  round((select avg({c}) from flags), 6) as overall_mean from flags group by flagged""" for c in PROFILED)


@query("k9_flagged_vs_normal", S.with_("feats ltx", _FLAG_PROFILE, extra=_TRUTH + """,
flags as (select f.*, cast(is_anomaly as int) as flagged from feats f join truth using (user_id))"""))
def flagged_vs_normal(spark, d):
    truth = an.ground_truth(users(spark, d), ltx(spark, d)).select(
        "user_id", F.col("is_anomaly").cast("int").alias("flagged"))
    out = cl.cluster_profiles(feats(spark, d).join(truth, "user_id"), PROFILED, "flagged")
    return rounded(out.select("flagged", "size", "feature", "cluster_mean", "overall_mean"))


@query("k11_anomaly_method_stats", S.with_("ltx", """
select anomaly_method, count(*) as cnt, round(avg(anomaly_score), 6) as avg_score from results
group by anomaly_method order by cnt desc, anomaly_method""", extra=_RESULTS))
def method_stats(spark, d):
    return rounded(an.method_stats(results(spark, d)))


# Contributions given as deviations from the mean, so that SQL can follow.
_CONTRIB = ["total_amount", "age", "avg_hour_of_day"]
_CONTRIB_SQL = "contrib as (" + " union all ".join(
    f"select user_id, '{c}' as feature, {c} - (select avg({c}) from feats) as contribution from feats"
    for c in _CONTRIB) + ")"


def contributions(spark, d):
    from ..functions.quantiles import unpivot
    f = feats(spark, d)
    long = unpivot(f, _CONTRIB, ["user_id"])
    means = long.groupBy("feature").agg(F.avg("_v").alias("m"))
    return long.join(means, "feature").select(
        "user_id", "feature", (F.col("_v") - F.col("m")).alias("contribution"))


_IMPORTANCE = """select feature, round(avg(abs(contribution)), 6) as importance from contrib
group by feature order by importance desc, feature limit 10"""


@query("k6b_importance_ranking", S.with_("feats", _IMPORTANCE, extra=_CONTRIB_SQL))
def importance_ranking(spark, d):
    return rounded(an.importance_ranking(contributions(spark, d), 10))


@query("f4_top_features", S.with_("feats", """
select feature, round(avg(abs(contribution)), 6) as importance from contrib
group by feature order by importance desc, feature limit 2""", extra=_CONTRIB_SQL))
def top_features(spark, d):
    return rounded(an.importance_ranking(contributions(spark, d), 2))


@query("k10_anomaly_result_rows", S.with_("feats ltx", """
select user_id, 'truth' as anomaly_method, case when is_anomaly then -1.0::double else 0.0::double end as anomaly_score,
  is_anomaly, '{' || string_agg('"' || feature || '":' || cast(floor(contribution) as bigint), ',' order by feature) || '}'
  as shap_values, (select '{' || string_agg('"' || feature || '":' || i, ',' order by feature) || '}' from
    (select feature, cast(floor(avg(abs(contribution))) as bigint) as i from contrib group by feature)) as feature_importance
from truth join contrib using (user_id) group by user_id, is_anomaly""", extra=_TRUTH + ",\n" + _CONTRIB_SQL))
def anomaly_result_rows(spark, d):
    truth = an.ground_truth(users(spark, d), ltx(spark, d)).withColumn(
        "anomaly_score", F.when(F.col("is_anomaly"), F.lit(-1.0)).otherwise(F.lit(0.0)))
    parts = contributions(spark, d)
    whole = lambda df, c: df.withColumn(c, F.floor(c))
    rows = an.anomaly_result_rows(truth, "truth", whole(parts, "contribution"),
                                  whole(an.importance_ranking(parts), "importance"))
    return an.as_json_columns(rows)


# -- similarity -------------------------------------------------------------------------------

def hits(spark, d):
    return sim.knn_new_users(with_new_flag(spark, d), 10)


def _hits_sql(body: str) -> str:
    return f"with {HITS}\n{body}"


@query("c6_query_x_base", f"""with {FLAGGED}
select q.id as query_id, min(round(1.0::double - list_cosine_similarity(q.v, b.v), 6)) as nearest
from flagged q, flagged b where q.is_new_user and q.id <> b.id group by q.id""")
def query_x_base(spark, d):
    f = with_new_flag(spark, d)
    return sim.knn(f, f.where("is_new_user"), 1).select(
        "query_id", F.round("distance", 6).alias("nearest"))


_KNN_COLS = "query_id, similar_id, rank, round(distance, 6) as distance, round(1.0::double - distance, 6) as similarity_score"


def _knn_out(df):
    return rounded(df.select("query_id", "similar_id", F.col("rank").cast("bigint").alias("rank"),
                             "distance", "similarity_score"))


@query("l1_knn_exact", _hits_sql(f"select {_KNN_COLS} from hits"))
def knn_exact(spark, d):
    f = with_new_flag(spark, d)
    return _knn_out(sim.knn(f, f.where("is_new_user"), 10))


@query("l1_knn_all_users", f"""with {EMB}, hits as (select * from (select q.id as query_id, b.id as similar_id,
    round(1.0::double - list_cosine_similarity(q.v, b.v), 12) as distance, row_number() over (partition by q.id
      order by round(1.0::double - list_cosine_similarity(q.v, b.v), 12), b.id) as rank
  from emb q, emb b where q.id <> b.id) where rank <= 5) select {_KNN_COLS} from hits""")
def knn_all(spark, d):
    f = embedded(spark, d)
    return _knn_out(sim.knn(f, f, 5, block_rows=200))


@query("l2_knn_metric_euclidean", f"""with {FLAGGED}, hits as (select * from (select q.id as query_id, b.id as similar_id,
    round(list_distance(q.v, b.v), 12) as distance, row_number() over (partition by q.id
      order by round(list_distance(q.v, b.v), 12), b.id) as rank
  from flagged q, flagged b where q.is_new_user and q.id <> b.id) where rank <= 10)
select query_id, similar_id, rank, round(distance, 6) as distance, round(1 / (1 + distance), 6) as similarity_score
from hits""")
def knn_euclidean(spark, d):
    f = with_new_flag(spark, d)
    return _knn_out(sim.knn(f, f.where("is_new_user"), 10, sim.EUCLIDEAN))


@query("l3_knn_new_users", _hits_sql(f"select {_KNN_COLS}, is_new_user from hits"))
def knn_new_users(spark, d):
    df = hits(spark, d)
    return rounded(df.select("query_id", "similar_id", F.col("rank").cast("bigint").alias("rank"),
                             "distance", "similarity_score", "is_new_user"))


@query("e1_neighbor_rank", _hits_sql("select query_id, similar_id, rank from hits"))
def neighbor_rank(spark, d):
    return hits(spark, d).select("query_id", "similar_id", F.col("rank").cast("bigint").alias("rank"))


_TRIPLE = """triple as (select user_id as id, avg_hour_of_day as a, age / 10.0::double as b,
  transaction_frequency as c from feats)"""


def triple(spark, d):
    return feats(spark, d).select(F.col("user_id").alias("id"), F.array(
        "avg_hour_of_day", F.col("age") / F.lit(10.0), "transaction_frequency").alias("vec"))


@query("l4_similarity_join", S.with_("feats", """
select * from (select a.id as id_a, b.id as id_b, a.w as n_a, b.w as n_b,
  round(1 - ((a.a - b.a) ^ 2 + (a.b - b.b) ^ 2 + (a.c - b.c) ^ 2) / 2, 6) as similarity
  from unit_sites a join unit_sites b on a.id < b.id
  where 1 - ((a.a - b.a) ^ 2 + (a.b - b.b) ^ 2 + (a.c - b.c) ^ 2) / 2 >= 0.999::double - 1e-9)
union all select id, id, w, w, 1.0::double from unit_sites where w > 1""", extra=_TRIPLE + """,
unit_sites as (select round(a / n, 12) as a, round(b / n, 12) as b, round(c / n, 12) as c, min(id) as id, count(*) as w
  from (select *, sqrt(a * a + b * b + c * c) as n from triple) group by 1, 2, 3)"""))
def similarity_join(spark, d):
    return rounded(sim.similarity_join(triple(spark, d), 0.999, 3))


@query("l4_similarity_join_euclidean", S.with_("feats", """
select id_a, id_b, n_a, n_b, round(1 / (1 + dist), 6) as similarity from (
  select a.id as id_a, b.id as id_b, a.w as n_a, b.w as n_b,
    sqrt((a.a - b.a) ^ 2 + (a.b - b.b) ^ 2 + (a.c - b.c) ^ 2) as dist
  from sites a join sites b on a.id < b.id) where 1 / (1 + dist) >= 0.7::double - 1e-9
union all select id, id, w, w, 1.0::double from sites where w > 1""", extra=_TRIPLE + """,
sites as (select a, b, c, min(id) as id, count(*) as w from triple group by 1, 2, 3)"""))
def similarity_join_euclidean(spark, d):
    return rounded(sim.similarity_join(triple(spark, d), 0.7, 3, sim.EUCLIDEAN))


@query("l4_similarity_join_wide", f"""with {EMB}, sites as (select v, min(id) as id, count(*) as w from emb group by v)
select a.id as id_a, b.id as id_b, a.w as n_a, b.w as n_b, round(list_cosine_similarity(a.v, b.v), 6) as similarity
from sites a join sites b on a.id < b.id where list_cosine_similarity(a.v, b.v) >= 0.9::double - 1e-9
union all select id, id, w, w, 1.0::double from sites where w > 1""")
def similarity_join_wide(spark, d):
    return rounded(sim.similarity_join(embedded(spark, d).select("id", "vec"), 0.9, 64))


@query("l6_similarity_stats", _hits_sql("""
select count(*) as total_comparisons, round(avg(s), 6) as mean_similarity, round(stddev_pop(s), 6) as std_similarity,
  round(min(s), 6) as min_similarity, round(max(s), 6) as max_similarity,
  count(*) filter (not is_new_user) as new_to_existing_count,
  round(coalesce(avg(s) filter (not is_new_user), 0), 6) as new_to_existing_mean,
  round(count(*) filter (not is_new_user) * 100.0::double / count(*), 6) as new_to_existing_percentage,
  count(*) filter (is_new_user) as new_to_new_count, round(coalesce(avg(s) filter (is_new_user), 0), 6) as new_to_new_mean,
  round(count(*) filter (is_new_user) * 100.0::double / count(*), 6) as new_to_new_percentage
from (select *, 1.0::double - distance as s from hits)"""))
def similarity_stats(spark, d):
    return rounded(sim.similarity_stats(hits(spark, d)))


@query("l7_similarity_bands", _hits_sql("""
select count(*) filter (s > 0.8::double) as very_high, count(*) filter (s between 0.6::double and 0.8::double) as high,
  count(*) filter (s between 0.4::double and 0.6::double) as medium, count(*) filter (s < 0.4::double) as low,
  count(*) filter (s > 0.8::double) as pattern_high, count(*) filter (s < 0.3::double) as pattern_low
from (select 1.0::double - distance as s from hits)"""))
def similarity_bands(spark, d):
    return sim.similarity_bands(hits(spark, d))


@query("l8_similarity_result_rows", _hits_sql("""
select query_id as query_user_id, similar_id as similar_user_id, round(1.0::double - distance, 6) as similarity_score,
  'cosine' as similarity_method from hits"""))
def similarity_result_rows(spark, d):
    return rounded(sim.similarity_result_rows(hits(spark, d), "cosine"))


@query("l9_avg_similarity_per_query", _hits_sql("""
select query_id, round(avg(1.0::double - distance), 6) as avg_similarity from hits group by query_id"""))
def avg_similarity(spark, d):
    return rounded(sim.avg_similarity_per_query(hits(spark, d)))


@query("l10_similarity_report", _hits_sql("""
select count(*) as total_pairs, round(avg(1.0::double - distance), 6) as avg_similarity,
  count(distinct query_id) as query_users from hits"""))
def similarity_report(spark, d):
    return rounded(sim.similarity_report(sim.similarity_result_rows(hits(spark, d), "cosine")))


@query("n12_similarity_categories", _hits_sql("""
select case when s > 0.8::double then 'high' when s >= 0.5::double then 'medium' else 'low' end as category,
  count(*) as cnt from (select 1.0::double - distance as s from hits) group by 1"""))
def similarity_categories(spark, d):
    return rep.similarity_categories(hits(spark, d))


@query("n17_analysis_summary", S.with_("ltx", """
select (select count(*) from users) as processed_users,
  (select count(distinct label) from embeddings where label <> 9) as clusters,
  (select count(*) from results) as scored_users, (select count(*) from results where is_anomaly) as anomalies,
  (select count(*) from hits) as similar_pairs,
  (select round(avg(1.0::double - distance), 6) from hits) as avg_similarity""", extra=_RESULTS + ",\n" + HITS))
def analysis_summary(spark, d):
    clusters = embedded(spark, d).select("id", F.when(
        F.col("cluster_id") == 9, F.lit(-1)).otherwise(F.col("cluster_id")).alias("cluster_id"))
    return rounded(rep.analysis_summary(
        feats(spark, d), clusters, results(spark, d),
        sim.similarity_result_rows(hits(spark, d), "cosine")))
