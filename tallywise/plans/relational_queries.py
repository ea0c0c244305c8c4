"""Scans, filters, joins, ranking, sampling, set operations and scalar functions."""

from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..functions.quantiles import NEAREST, group_quantiles
from ..functions.vectors import cosine_similarity, euclidean
from ..operators import features as feat
from ..operators import quality, relational as r
from ..operators.synth import city_to_province, assign_weighted, with_user_age
from ..operators.synth import CITY_VALUES, CITY_WEIGHTS
from .. import constants as C
from ..sources import tables
from . import sqltext as S
from .inputs import feats, ltx, rounded, tx, users, vectors
from .registry import query

USER_COLS = "user_id, age, birth_year, registration_date, province, city, preferred_card_type, primary_device"
TX_COLS = ("transaction_id, user_id, amount, transaction_date, transaction_time, province, city, "
           "card_type, device_type, is_weekend, hour_of_day, day_of_month")


# -- scans ------------------------------------------------------------------------------------

@query("a1_scan_users", S.with_("users", f"select {USER_COLS} from users order by user_id"))
def scan_users(spark, d):
    return users(spark, d).orderBy("user_id")


@query("a2_scan_transactions", S.with_("tx", f"select {TX_COLS} from tx order by transaction_id"))
def scan_transactions(spark, d):
    return tx(spark, d).orderBy("transaction_id")


@query("a4_user_history", S.with_("tx", f"""
select {TX_COLS} from tx where user_id = 7 order by transaction_date, transaction_time"""))
def user_history(spark, d):
    return tables.user_history(tx(spark, d), 7)


@query("a4_users_history", S.with_("tx users", f"""
select {TX_COLS} from tx where user_id in (select user_id from users where age < 25)"""))
def users_history(spark, d):
    return tables.users_history(tx(spark, d), users(spark, d).where("age < 25"))


@query("a5_parameterised_sql", S.with_("tx", """
select card_type, count(*) as cnt, round(sum(amount), 4) as total from tx
where amount > 50 and hour_of_day between 8 and 20 group by card_type"""))
def parameterised_sql(spark, d):
    return tables.run_sql(spark, """
        select card_type, count(*) as cnt, round(sum(amount), 4) as total from {t}
        where amount > :floor and hour_of_day between :first and :last group by card_type""",
        {"floor": 50, "first": 8, "last": 20}, t=tx(spark, d))


# -- projections and filters ------------------------------------------------------------------

@query("b1_select_subset", S.with_("feats", f"""
select user_id, {', '.join(f'round({c}, 9) as {c}' if c not in ('total_transactions', 'age') else c
                           for c in C.ANOMALY_FEATURES)} from feats"""))
def select_subset(spark, d):
    return rounded(r.select_subset(feats(spark, d), C.ANOMALY_FEATURES + ["absent_column"]), 9)


@query("b2_drop_columns", S.with_("users", """
select user_id, age, birth_year, registration_date, preferred_card_type, primary_device from users"""))
def drop_columns(spark, d):
    return r.drop_columns(users(spark, d), ["province", "city", "absent_column"])


@query("b3_with_columns", S.with_("tx", """
select transaction_id, user_id, amount * 1.1::double as amount, hour_of_day + 1 as hour_of_day,
  upper(card_type) as card_upper from tx"""))
def with_columns(spark, d):
    return tx(spark, d).select("transaction_id", "user_id", "amount", "hour_of_day", "card_type") \
        .withColumns({"amount": F.col("amount") * F.lit(1.1), "hour_of_day": F.col("hour_of_day") + 1,
                      "card_upper": F.upper("card_type")}).drop("card_type")


@query("b4_cast_text", S.with_("feats", """
select user_id, cast(total_transactions as varchar) as total_transactions,
  cast(age as varchar) as age, most_frequent_city from feats"""))
def cast_text(spark, d):
    return r.cast_text(feats(spark, d).select(
        "user_id", "total_transactions", "age", "most_frequent_city"),
        ["total_transactions", "age", "most_frequent_city"])


@query("b6_noise_filter", S.with_("ltx", """
select transaction_id, user_id, round(amount, 4) as amount, city, province, hour_of_day,
  transaction_time, noise_type from ltx where is_noise"""))
def noise_filter(spark, d):
    return ltx(spark, d).where("is_noise").select(
        "transaction_id", "user_id", F.round("amount", 4).alias("amount"), "city", "province",
        "hour_of_day", "transaction_time", "noise_type")


_RATIO = """select user_id, count(*) as total_count, cast(sum(is_noise::int) as bigint) as noise_count,
  round(sum(is_noise::int)::double / count(*), 6) as noise_ratio from ltx group by user_id"""


@query("b7_threshold_filter", S.with_("ltx", _RATIO + " having sum(is_noise::int)::double / count(*) > 0.1::double"))
def threshold_filter(spark, d):
    return rounded(r.user_noise_ratio(ltx(spark, d)).where(F.col("noise_ratio") > 0.1))


@query("b8_isin_filter", S.with_("ltx", """
select user_id, age, city from users where user_id in (select user_id from ltx where is_noise)"""))
def isin_filter(spark, d):
    return r.members(users(spark, d), ltx(spark, d).where("is_noise"), "user_id").select(
        "user_id", "age", "city")


@query("b9_exclude_noise_cluster", """
select vec_id as user_id, label as cluster_id from
  (select vec_id, case when label = 9 then -1 else label end as label from embeddings) where label <> -1""")
def exclude_noise_cluster(spark, d):
    labelled = vectors(spark, d).select(
        F.col("vec_id").alias("user_id"),
        F.when(F.col("label") == 9, F.lit(-1)).otherwise(F.col("label")).alias("cluster_id"))
    return labelled.where(F.col("cluster_id") != -1)


_CASE_AGE = """case when age between 18 and 25 then '18-25' when age between 26 and 35 then '26-35'
  when age between 36 and 45 then '36-45' when age between 46 and 55 then '46-55'
  when age between 56 and 65 then '56-65' else '65+' end"""


@query("b10_case_age_group", S.with_("users", f"select user_id, age, {_CASE_AGE} as age_group from users"))
def case_age_group(spark, d):
    return users(spark, d).select("user_id", "age", fn.age_group(F.col("age")).alias("age_group"))


@query("b11_cut_age_group", S.with_("users", """
select user_id, age, case when age > 0 and age <= 30 then 'Young' when age > 30 and age <= 50 then 'Middle'
  when age > 50 and age <= 100 then 'Senior' end as age_band from users"""))
def cut_age_group(spark, d):
    return users(spark, d).select("user_id", "age", fn.age_band(F.col("age")).alias("age_band"))


# -- joins ------------------------------------------------------------------------------------

@query("c1_tx_left_user", S.with_("tx users", """
select t.transaction_id, t.user_id, coalesce(u.age, 30) as age
from tx t left join (select * from users where age <> 40) u using (user_id)"""))
def tx_left_user(spark, d):
    known = users(spark, d).where("age <> 40")
    return with_user_age(tx(spark, d), known).select("transaction_id", "user_id", "age")


@query("c3_anti_missing_features", S.with_("users tx", """
select user_id from users where user_id not in (select user_id from tx)"""))
def anti_missing_features(spark, d):
    return feat.missing_features(users(spark, d), feat.behavioral_features(tx(spark, d)))


@query("c4_decorrelated_ratio", S.with_("ltx", _RATIO))
def decorrelated_ratio(spark, d):
    return rounded(r.user_noise_ratio(ltx(spark, d)))


@query("c4_correlated_sql", S.with_("ltx", """
select user_id, round(sum(is_noise::int)::double / count(*), 6) as noise_ratio from ltx
group by user_id having sum(is_noise::int) > 0"""))
def correlated_sql(spark, d):
    return tables.run_sql(spark, """
        select user_id, round(noise_count / (select count(*) from {t} a where a.user_id = n.user_id), 6)
          as noise_ratio
        from (select user_id, count(*) as noise_count from {t} where is_noise group by user_id) n""", t=ltx(spark, d))


@query("c5_label_by_key", S.with_("feats", """
select f.user_id, round(total_amount, 4) as total_amount, label as cluster_id
from feats f left join (select vec_id as user_id, label from embeddings) using (user_id)"""))
def label_by_key(spark, d):
    labels = vectors(spark, d).select(F.col("vec_id").alias("user_id"),
                                      F.col("label").alias("cluster_id"))
    return r.label_by_key(feats(spark, d).select(
        "user_id", F.round("total_amount", 4).alias("total_amount")), labels)


_CITY_PROVINCE = " union all ".join(
    f"select '{c}' as drawn_city, '{p}' as drawn_province"
    for p, (_, cities) in C.PROVINCES.items() for c in cities)


@query("c7_city_to_province", S.with_("users", """
select user_id, drawn_city, drawn_province from drawn join dim using (drawn_city)""",
    extra=f"""drawn as (select user_id, {S.pick(S.u('user_id', 'drawn_city'), CITY_VALUES, CITY_WEIGHTS)}
    as drawn_city from users), dim as ({_CITY_PROVINCE})"""))
def city_to_province_query(spark, d):
    drawn = assign_weighted(users(spark, d).select("user_id"), "user_id", "drawn_city",
                            CITY_VALUES, CITY_WEIGHTS)
    return city_to_province(drawn, "drawn_city", "drawn_province")


@query("c8_referential_check", S.with_("tx users", """
select user_id, count(*) as cnt from tx where user_id not in (select user_id from users where age <> 40)
group by user_id"""))
def referential_check(spark, d):
    return quality.orphans(tx(spark, d), "user_id", users(spark, d).where("age <> 40"), "user_id")


@query("c9_scalar_total", S.with_("tx", """
select city, count(*) as cnt, round(count(*) * 100.0::double / (select count(*) from tx), 1) as percentage
from tx group by city"""))
def scalar_total(spark, d):
    return r.with_share(tx(spark, d).groupBy("city").agg(F.count("*").alias("cnt")))


# -- ranking ----------------------------------------------------------------------------------

@query("e2_top1_per_group", S.with_("tx", """
select user_id, city, cnt from (select user_id, city, count(*) as cnt, row_number() over (
  partition by user_id order by count(*) desc, city) as rn from tx group by user_id, city) where rn = 1"""))
def top1_per_group(spark, d):
    return r.top1_per_group(tx(spark, d), ["user_id"], "city")


@query("e3_nearest_rank_quantile", S.with_("tx", """
select user_id, max(case when rn = floor((n - 1) * 0.1 + 0.5) + 1 then amount end) as p10,
  max(case when rn = floor((n - 1) * 0.9 + 0.5) + 1 then amount end) as p90
from (select user_id, amount, row_number() over (partition by user_id order by amount) as rn,
  count(*) over (partition by user_id) as n from tx) group by user_id"""))
def nearest_rank_quantile(spark, d):
    return group_quantiles(tx(spark, d), ["user_id"], "amount",
                           {"p10": (0.1, NEAREST), "p90": (0.9, NEAREST)})


@query("e4_latest_by_key", S.with_("tx", """
select user_id, transaction_id, card_type, amount from (select *, row_number() over (
  partition by user_id order by transaction_id desc) as rn from tx) where rn = 1"""))
def latest_by_key(spark, d):
    return r.latest_by_key(tx(spark, d).select("user_id", "transaction_id", "card_type", "amount"),
                           ["user_id"], "transaction_id")


@query("e5_cumulative_variance", S.with_("tx", """
select component, round(ratio, 6) as ratio, round(cumulative, 6) as cumulative,
  coalesce(lag(cumulative) over (order by component) < 0.8::double, true) as kept
from (select component, ratio, sum(ratio) over (order by component) as cumulative
  from (select hour_of_day + 1 as component, count(*)::double / (select count(*) from tx) as ratio
    from tx group by hour_of_day))"""))
def cumulative_variance(spark, d):
    t = tx(spark, d)
    ratios = t.groupBy((F.col("hour_of_day") + 1).alias("component")).agg(
        F.count("*").alias("c")).withColumn("ratio", F.col("c") / t.agg(F.count("*")).scalar())
    return rounded(r.cumulative_variance(ratios.drop("c"), 0.8))


# -- order, limit, sampling -------------------------------------------------------------------

@query("f1_order_limit", S.with_("tx", """
select transaction_id, user_id, amount from tx order by amount desc, transaction_id limit 20"""))
def order_limit(spark, d):
    return r.top_n(tx(spark, d).select("transaction_id", "user_id", "amount"), "amount", 20,
                   "transaction_id")


@query("f2_top10_provinces", S.with_("tx", """
select city, count(*) as cnt from tx group by city order by cnt desc, city limit 10"""))
def top10(spark, d):
    return feat.value_counts(tx(spark, d), "city").limit(10)


@query("f3_random_sample_n", S.with_("users", f"""
select {USER_COLS} from users order by md5(cast(user_id as varchar) || ':sample'), user_id limit 100"""))
def random_sample(spark, d):
    return r.hash_sample(users(spark, d), "user_id", 100)


# -- set operations ---------------------------------------------------------------------------

@query("g1_concat_vertical", S.with_("tx", f"""
select {TX_COLS} from tx where is_weekend union all select {TX_COLS} from tx where not is_weekend"""))
def concat_vertical(spark, d):
    t = tx(spark, d)
    return r.concat_vertical(t.where("is_weekend"), t.where("not is_weekend"))


@query("g2_concat_outer", S.with_("users", """
select user_id, age, province, null::varchar as primary_device, false as is_new_user from users where age >= 30
union all select user_id, age, null, primary_device, true from users where age < 30"""))
def concat_outer(spark, d):
    w = users(spark, d)
    return r.concat_outer(w.where("age >= 30").select("user_id", "age", "province"),
                          w.where("age < 30").select("user_id", "age", "primary_device"))


@query("g4_id_difference", S.with_("users tx", """
select user_id from users except select user_id from tx"""))
def id_difference(spark, d):
    return r.id_difference(users(spark, d), tx(spark, d), "user_id")


# -- scalar functions -------------------------------------------------------------------------

@query("h1_weekend", """
select event_id, isodow(ts) = 5 as is_weekend from events""")
def weekend(spark, d):
    return tables.read_table(spark, d, "events").select(
        "event_id", fn.is_weekend(F.col("ts").cast("date")).alias("is_weekend"))


@query("h2_day_of_month", """
select event_id, cast(split_part(strftime(ts, '%Y-%m-%d'), '-', 3) as int) as day_of_month from events""")
def day_of_month(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd")
    return tables.read_table(spark, d, "events").select(
        "event_id", F.split(text, "-").getItem(2).cast("int").alias("day_of_month"))


@query("h3_date_shift", S.with_("users", """
select user_id, cast(registration_date + cast(age as int) as date) as shifted,
  strftime(registration_date, '%Y-%m-%d') as as_text from users"""))
def date_shift(spark, d):
    return users(spark, d).select("user_id", F.date_add("registration_date", F.col("age")).alias("shifted"),
                                  F.date_format("registration_date", "yyyy-MM-dd").alias("as_text"))


@query("h4_day_span", S.with_("users", """
select user_id, cast(date '2024-01-31' - registration_date + 1 as int) as days from users"""))
def day_span(spark, d):
    return users(spark, d).select(
        "user_id", fn.day_span(F.col("registration_date"), F.lit(C.END_DATE)).alias("days"))


@query("h5_clock_text", S.with_("tx", """
select transaction_id, printf('%02d:%02d:%02d', hour_of_day, day_of_month, user_id % 60) as clock from tx"""))
def clock_text(spark, d):
    return tx(spark, d).select("transaction_id", fn.clock(
        F.col("hour_of_day"), F.col("day_of_month"), F.col("user_id") % 60).alias("clock"))


@query("h6_replace_hour", S.with_("tx", """
select transaction_id, lpad(cast(day_of_month % 24 as varchar), 2, '0') || substr(transaction_time, 3)
  as new_time from tx"""))
def replace_hour(spark, d):
    return tx(spark, d).select("transaction_id", fn.replace_hour(
        F.col("transaction_time"), F.col("day_of_month") % 24).alias("new_time"))


@query("h7_join_labels", S.with_("tx", """
select transaction_id, nullif(concat_ws(',', case when is_weekend then 'weekend' end,
  case when hour_of_day < 7 then 'night' end, case when amount > 100 then 'large' end), '') as labels from tx"""))
def join_labels(spark, d):
    return tx(spark, d).select("transaction_id", fn.join_labels(
        F.when(F.col("is_weekend"), "weekend"), F.when(F.col("hour_of_day") < 7, "night"),
        F.when(F.col("amount") > 100, "large")).alias("labels"))


@query("h8_log_amount", S.with_("tx", """
select transaction_id, round(log10(amount + 1), 6) as log_amount from tx"""))
def log_amount(spark, d):
    return tx(spark, d).select("transaction_id",
                               F.round(F.log10(F.col("amount") + 1), 6).alias("log_amount"))


@query("h9_log_exp_clip", S.with_("tx", """
select transaction_id, round(ln(amount + 1), 6) as ln_amount, round(exp(amount / 100), 6) as exp_amount,
  greatest(least(amount, 200.0::double), 10.0::double) as clipped, cast(round(amount) as bigint) as whole
from tx"""))
def log_exp_clip(spark, d):
    a = F.col("amount")
    return tx(spark, d).select(
        "transaction_id", F.round(F.ln(a + 1), 6).alias("ln_amount"),
        F.round(F.exp(a / 100), 6).alias("exp_amount"), fn.clip(a, 10.0, 200.0).alias("clipped"),
        F.round(a).cast("bigint").alias("whole"))


@query("h10_round_percentage", S.with_("tx", """
select card_type, round(count(*) * 100.0::double / (select count(*) from tx), 1) as pct from tx group by card_type"""))
def round_percentage(spark, d):
    t = tx(spark, d)
    return r.with_share(t.groupBy("card_type").agg(F.count("*").alias("cnt")), out="pct").drop("cnt")


@query("h11_birth_year", S.with_("users", "select user_id, cast(2024 - age as int) as birth_year from users"))
def birth_year(spark, d):
    return users(spark, d).select(
        "user_id", (F.lit(C.REFERENCE_YEAR) - F.col("age")).alias("birth_year"))


@query("h12_map_to_json", S.with_("users", """
select user_id, '{"age":' || age || ',"birth_year":' || birth_year || '}' as as_json from users"""))
def map_to_json(spark, d):
    return users(spark, d).select("user_id", F.to_json(F.create_map(
        F.lit("age"), F.col("age"), F.lit("birth_year"), F.col("birth_year"))).alias("as_json"))


@query("h13_ratio_or_one", S.with_("tx", """
select transaction_id, abs(amount - 50) as gap,
  round(case when hour_of_day <> 0 then amount / hour_of_day else 1 end, 6) as ratio from tx"""))
def ratio_or_one(spark, d):
    return tx(spark, d).select(
        "transaction_id", F.abs(F.col("amount") - 50).alias("gap"),
        F.round(fn.ratio_or_one(F.col("amount"), F.col("hour_of_day")), 6).alias("ratio"))


@query("h14_vector_similarity", """
select e.vec_id, round(list_cosine_similarity(e.v, c.v), 6) as cosine,
  round(list_distance(e.v, c.v), 6) as distance,
  round(1 / (1 + list_distance(e.v, c.v)), 6) as similarity
from (select vec_id, label, embedding::double[] as v from embeddings) e
join (select label, embedding::double[] as v from embeddings
  qualify row_number() over (partition by label order by vec_id) = 1) c using (label)""")
def vector_similarity(spark, d):
    v = vectors(spark, d)
    first = v.groupBy("label").agg(F.min_by("vec", "vec_id").alias("c"))
    dist = euclidean(F.col("vec"), F.col("c"))
    return v.join(first, "label").select(
        "vec_id", F.round(cosine_similarity(F.col("vec"), F.col("c")), 6).alias("cosine"),
        F.round(dist, 6).alias("distance"),
        F.round(F.lit(1.0) / (F.lit(1.0) + dist), 6).alias("similarity"))


@query("h15_null_fill", S.with_("ltx", """
select transaction_id, coalesce(noise_type, 'none') as noise_type from ltx"""))
def null_fill(spark, d):
    return ltx(spark, d).select("transaction_id", "noise_type").na.fill({"noise_type": "none"})
