"""Fitted feature transforms."""

from pyspark.sql import functions as F

from ..operators import transforms as t
from .. import constants as C
from . import sqltext as S
from .inputs import FLOAT_FEATURES, INT_FEATURES, TEXT_FEATURES, feats, rounded, users, vectors
from .registry import query

NUMBERS = ["total_amount", "avg_transaction_amount", "transaction_frequency", "age"]


def holed(spark, d):
    """Features with gaps: NULL numbers for some ages, NULL text for some birth years."""
    gap = F.col("age") % 7 == 0
    f = feats(spark, d).select("user_id", *NUMBERS, "most_frequent_city", "most_frequent_province")
    return f.withColumns({
        "total_amount": F.when(~gap, F.col("total_amount")),
        "transaction_frequency": F.when(F.col("age") % 5 != 0, F.col("transaction_frequency")),
        "most_frequent_city": F.when(~gap, F.col("most_frequent_city")),
        "most_frequent_province": F.when(F.col("age") % 3 != 0, F.col("most_frequent_province"))})


HOLED = """holed as (select user_id, case when age % 7 <> 0 then total_amount end as total_amount,
  avg_transaction_amount, case when age % 5 <> 0 then transaction_frequency end as transaction_frequency, age,
  case when age % 7 <> 0 then most_frequent_city end as most_frequent_city,
  case when age % 3 <> 0 then most_frequent_province end as most_frequent_province from feats)"""


@query("i1_impute_median", S.with_("feats", "select user_id, " + ", ".join(
    f"round(coalesce(cast({c} as double), (select quantile_cont(cast({c} as double), 0.5) from holed)), 9) as {c}"
    for c in NUMBERS) + " from holed", extra=HOLED))
def impute_median(spark, d):
    df = holed(spark, d).select("user_id", *NUMBERS)
    return rounded(t.impute_median(df, t.fit_medians(df, NUMBERS), NUMBERS), 9)


_TEXT = ["most_frequent_city", "most_frequent_province"]


@query("i2_impute_mode", S.with_("feats", "select user_id, " + ", ".join(
    f"coalesce({c}, (select {c} from holed where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as {c}"
    for c in _TEXT) + " from holed", extra=HOLED))
def impute_mode(spark, d):
    df = holed(spark, d).select("user_id", *_TEXT)
    return t.impute_mode(df, t.fit_modes(df, _TEXT), _TEXT)


@query("i3_label_encode", S.with_("users", """
select user_id, coalesce(c.code, 0) as city, coalesce(p.code, 0) as province from users u
left join (select city, cast(dense_rank() over (order by city) - 1 as int) as code
  from (select distinct city from users where age < 60)) c using (city)
left join (select province, cast(dense_rank() over (order by province) - 1 as int) as code
  from (select distinct province from users where age < 60)) p using (province)"""))
def label_encode(spark, d):
    df = users(spark, d).select("user_id", "age", "city", "province")
    labels = t.fit_labels(df.where("age < 60"), ["city", "province"])
    return t.label_encode(df, labels, ["city", "province"]).drop("age")


def _scaled(center: str, width: str) -> str:
    cols = ", ".join(f"""round((cast({c} as double) - (select {center.format(c=c)} from feats))
      / (select case when {width.format(c=c)} = 0 then 1 else {width.format(c=c)} end from feats), 9) as {c}"""
                     for c in NUMBERS)
    return S.with_("feats", f"select user_id, {cols} from feats")


def _scale(spark, d, method):
    df = feats(spark, d).select("user_id", *NUMBERS)
    return rounded(t.scale(df, t.fit_scaler(df, NUMBERS, method), NUMBERS), 9)


@query("i4_scale_standard", _scaled("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, d):
    return _scale(spark, d, "standard")


@query("i5_scale_minmax", _scaled("min({c})", "(max({c}) - min({c}))"))
def scale_minmax(spark, d):
    return _scale(spark, d, "minmax")


@query("i6_scale_robust", _scaled(
    "quantile_cont(cast({c} as double), 0.5)",
    "(quantile_cont(cast({c} as double), 0.75) - quantile_cont(cast({c} as double), 0.25))"))
def scale_robust(spark, d):
    return _scale(spark, d, "robust")


_WIDE = ["age", "birth_year", "avg_hour_of_day"]


def _kept(low: str, high: str) -> str:
    parts = " and ".join(f"""not coalesce({c} < (select {low.format(c=c)} from feats)
      or {c} > (select {high.format(c=c)} from feats), false)""" for c in _WIDE)
    return S.with_("feats", f"select user_id, age, birth_year, round(avg_hour_of_day, 6) as avg_hour_of_day "
                            f"from feats where {parts}")


_Q = "quantile_cont(cast({{c}} as double), {q})"
_IQR = f"({_Q.format(q=0.75)} - {_Q.format(q=0.25)})"


@query("i7_remove_outliers_iqr", _kept(f"{_Q.format(q=0.25)} - 1.5 * {_IQR}", f"{_Q.format(q=0.75)} + 1.5 * {_IQR}"))
def remove_outliers_iqr(spark, d):
    df = feats(spark, d).select("user_id", *_WIDE)
    return rounded(t.remove_outliers(df, _WIDE, "iqr", 1.5))


@query("i8_remove_outliers_zscore", _kept("avg({c}) - 1.5 * stddev_samp({c})", "avg({c}) + 1.5 * stddev_samp({c})"))
def remove_outliers_zscore(spark, d):
    df = feats(spark, d).select("user_id", *_WIDE)
    return rounded(t.remove_outliers(df, _WIDE, "zscore", 1.5))


@query("g3_union_of_outliers", S.with_("feats", f"""select user_id, {' or '.join(
    f'''coalesce({c} < (select {_Q.format(q=0.25).format(c=c)} - 1.5 * {_IQR.format(c=c)} from feats)
      or {c} > (select {_Q.format(q=0.75).format(c=c)} + 1.5 * {_IQR.format(c=c)} from feats), false)'''
    for c in _WIDE)} as is_outlier from feats"""))
def union_of_outliers(spark, d):
    df = feats(spark, d).select("user_id", *_WIDE)
    return t.outlier_flag(df, t.fit_fences(df, _WIDE), _WIDE).select("user_id", "is_outlier")


DIMS = [f"e{i}" for i in range(64)]


def embedding_columns(spark, d):
    return vectors(spark, d).select(
        "vec_id", "label", *[F.col("vec").getItem(i).alias(c) for i, c in enumerate(DIMS)])


LONG = """long as (select vec_id, label, 'e' || (i - 1) as feature, cast(embedding[i] as double) as v
  from (select *, unnest(range(1, 65)) as i from embeddings))"""


@query("i9_select_k_anova", f"""with {LONG}, pc as (select feature, label, count(*) as n, avg(v) as m,
  var_pop(v) * count(*) as w from long group by feature, label),
gm as (select feature, avg(v) as g, count(*) as total from long group by feature)
select feature, round((sum(pc.n * (m - g) ^ 2) / (count(*) - 1)) / (sum(w) / (any_value(total) - count(*))), 6) as f_score
from pc join gm using (feature) group by feature order by f_score desc, feature limit 20""")
def anova(spark, d):
    scores = t.anova_scores(embedding_columns(spark, d), "label", DIMS)
    return rounded(scores.orderBy(F.desc("f_score"), "feature").limit(20))


@query("i9_selected_columns", f"""with {LONG}, pc as (select feature, label, count(*) as n, avg(v) as m,
  var_pop(v) * count(*) as w from long group by feature, label),
gm as (select feature, avg(v) as g, count(*) as total from long group by feature),
top as (select feature, (sum(pc.n * (m - g) ^ 2) / (count(*) - 1)) / (sum(w) / (any_value(total) - count(*))) as f_score
  from pc join gm using (feature) group by feature order by f_score desc, feature limit 20)
select vec_id, label, feature, v as value from long join top using (feature)""")
def selected_columns(spark, d):
    """The columns kept, as rows: their names depend on the data."""
    df = embedding_columns(spark, d)
    kept = t.select_k_best(df, t.anova_scores(df, "label", DIMS), "f_score", "label", 20, ("vec_id",))
    names = [c for c in kept.columns if c not in ("vec_id", "label")]
    return kept.unpivot(["vec_id", "label"], names, "feature", "value")


@query("i10_select_k_mutual_info", f"""with {LONG}, cuts as (select feature, quantile_cont(v,
  [0.1::double, 0.2::double, 0.3::double, 0.4::double, 0.5::double, 0.6::double, 0.7::double, 0.8::double, 0.9::double]) as edges
  from long group by feature),
cells as (select feature, len(list_filter(edges, lambda e: e < v)) as b, label, count(*)::double as n
  from long join cuts using (feature) group by all)
select feature, round(sum(n / t * ln(n * t / (nb * ny))), 6) as mi from (
  select *, sum(n) over (partition by feature) as t, sum(n) over (partition by feature, b) as nb,
    sum(n) over (partition by feature, label) as ny from cells)
group by feature order by mi desc, feature limit 20""")
def mutual_info(spark, d):
    scores = t.mutual_information(embedding_columns(spark, d), "label", DIMS)
    return rounded(scores.orderBy(F.desc("mi"), "feature").limit(20))


def _digamma(n: str) -> str:
    up = f"({n} + 8.0::double)"
    steps = " - ".join(f"1 / ({n} + {i}.0::double)" for i in range(8))
    return (f"(ln({up}) - 1 / (2 * {up}) - 1 / (12 * {up} ^ 2) + 1 / (120 * {up} ^ 4) - 1 / (252 * {up} ^ 6) - {steps})")


@query("i10_neighbour_mutual_info", f"""with {LONG},
own as (select *, count(*) over (partition by feature, label) as n from long),
rows as (select * from own where n > 1 and feature in ('e0', 'e1', 'e2')),
near as (select a.feature, a.vec_id, a.v, a.n, abs(a.v - b.v) as d, least(3, a.n - 1) as k,
    row_number() over (partition by a.feature, a.vec_id order by abs(a.v - b.v)) as rn
  from rows a join rows b on a.feature = b.feature and a.label = b.label and a.vec_id <> b.vec_id),
kth as (select feature, vec_id, v, n, k, d from near where rn = k),
counted as (select t.feature, t.vec_id, t.n, t.k, count(*) as m from kth t join rows o on o.feature = t.feature
  and (abs(o.v - t.v) < t.d or (t.d = 0 and o.v = t.v)) group by all)
select feature, round(greatest(0, {_digamma('count(*)')} + avg({_digamma('k')} - {_digamma('n')} - {_digamma('m')})), 6) as mi
from counted group by feature""")
def neighbour_info(spark, d):
    return rounded(t.neighbour_information(embedding_columns(spark, d), "label", ["e0", "e1", "e2"]))


@query("i11_pca_reduce", f"""with {LONG},
m as (select feature, avg(v) as m from long group by feature)
select vec_id, round(sqrt(sum((v - m) ^ 2)), 6) as length, true as keeps_enough, true as none_too_many, true as is_shorter
from long join m using (feature) group by vec_id""")
def pca_reduce(spark, d):
    """Each row's length before; that it is no longer after, and that no fewer components would do."""
    df = embedding_columns(spark, d).drop("label")
    scores = t.pca_reduce(df, DIMS, variance_threshold=0.95, keys=("vec_id",))
    axes = [c for c in scores.columns if c != "vec_id"]
    var = scores.agg(*[F.var_samp(c).alias(c) for c in axes]).first()
    total = df.agg(sum((F.var_samp(c) for c in DIMS), F.lit(0.0)).alias("t"), *[F.avg(c).alias(c) for c in DIMS]).first()
    before = F.sqrt(sum(((F.col(c) - F.lit(total[c])) ** 2 for c in DIMS), F.lit(0.0)))
    after = F.sqrt(sum((F.col(c) ** 2 for c in axes), F.lit(0.0)))
    shares = [v / total["t"] for v in var]
    return rounded(df.select("vec_id", before.alias("length")).join(scores, "vec_id").select(
        "vec_id", "length", F.lit(sum(shares) >= 0.95 - 1e-9).alias("keeps_enough"),
        F.lit(sum(shares[:-1]) < 0.95).alias("none_too_many"), (after <= F.col("length") + 1e-9).alias("is_shorter")))


@query("i12_interaction_features", S.with_("feats", """
select user_id, round(total_amount * age, 6) as amount_per_age,
  round(avg_transaction_amount * transaction_frequency, 6) as amount_frequency_ratio,
  round(total_transactions * geographical_diversity, 6) as transaction_geo_ratio,
  round(total_amount / (total_transactions + 1), 9) as amount_per_transaction,
  round(1.0::double - weekend_transaction_ratio, 9) as weekday_transaction_ratio from feats"""))
def interactions(spark, d):
    out = t.interaction_features(feats(spark, d))
    digits = {"amount_per_transaction": 9, "weekday_transaction_ratio": 9}
    names = ["amount_per_age", "amount_frequency_ratio", "transaction_geo_ratio", *digits]
    return out.select("user_id", *[F.round(c, digits.get(c, 6)).alias(c) for c in names])


_ENCODED = {c: f"cast(dense_rank() over (order by {c}) - 1 as double)" for c in TEXT_FEATURES}
_DERIVED = """select *, total_amount * age as amount_per_age,
  avg_transaction_amount * transaction_frequency as amount_frequency_ratio,
  total_transactions * geographical_diversity as transaction_geo_ratio,
  total_amount / (total_transactions + 1) as amount_per_transaction,
  1.0::double - weekend_transaction_ratio as weekday_transaction_ratio from feats"""
_EXTRA = ["amount_per_age", "amount_frequency_ratio", "transaction_geo_ratio",
          "amount_per_transaction", "weekday_transaction_ratio"]
_ALL = FLOAT_FEATURES + INT_FEATURES + TEXT_FEATURES + _EXTRA


@query("i13_transform_steps", S.with_("feats", "select user_id, " + ", ".join(
    f"round((cast({c} as double) - avg({c}) over ()) / (case when stddev_pop({c}) over () < 1e-12 then 1 "
    f"else stddev_pop({c}) over () end), 6) as {c}" for c in _ALL) + " from encoded",
    extra=f"""encoded as (select * replace ({', '.join(f'{e} as {c}' for c, e in _ENCODED.items())}) from ({_DERIVED}))"""))
def transform_steps(spark, d):
    return rounded(t.FeatureSteps().fit(feats(spark, d)))


@query("i13_apply_to_new_rows", S.with_("feats", """
select user_id, round((age - (select avg(age) from feats where age < 60))
  / (select stddev_pop(age) from feats where age < 60), 6) as age,
  round((total_amount - (select avg(total_amount) from feats where age < 60))
  / (select stddev_pop(total_amount) from feats where age < 60), 6) as total_amount from feats"""))
def apply_steps(spark, d):
    f = feats(spark, d).select("user_id", "age", "total_amount")
    steps = t.FeatureSteps(("missing_values", "scaling"))
    steps.fit(f.where("age < 60"))
    return rounded(steps.apply(f))


_CORR = C.ANOMALY_FEATURES


@query("i15_correlation_matrix", S.with_("feats", " union all ".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as correlation from feats"
    for i, a in enumerate(_CORR) for b in _CORR[:i])))
def correlation(spark, d):
    return rounded(t.correlation_matrix(feats(spark, d), _CORR))
