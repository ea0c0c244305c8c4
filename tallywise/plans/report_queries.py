"""Roll-up reports, chart data and data-quality checks."""

from pyspark.sql import functions as F

from ..functions.scalar import age_band
from ..operators import quality as qual
from ..operators import reports as rep
from ..operators.synth import perturb_users
from .. import constants as C
from . import sqltext as S
from .inputs import feats, ltx, rounded, tx, users
from .registry import query

_AGE = """case when age between 18 and 25 then '18-25' when age between 26 and 35 then '26-35'
  when age between 36 and 45 then '36-45' when age between 46 and 55 then '46-55'
  when age between 56 and 65 then '56-65' else '65+' end"""


def _share(table: str, column: str, extra: str = "") -> str:
    return (f"select {column}, count(*) as cnt, round(count(*) * 100.0::double / "
            f"(select count(*) from {table}), 1) as percentage from {table} group by {column} {extra}")


@query("n1_age_group_distribution", S.with_("users", f"""
select {_AGE} as age_group, count(*) as cnt,
  round(count(*) * 100.0::double / (select count(*) from users), 1) as percentage
from users group by 1 order by 1"""))
def age_groups(spark, d):
    return rep.age_group_distribution(users(spark, d))


@query("n2_province_top5", S.with_("users", _share(
    "users", "province", "order by cnt desc, province limit 5")))
def province_top5(spark, d):
    return rep.province_top(users(spark, d))


@query("n3_overall_counts", S.with_("users tx", """
select (select count(*) from users) as total_users, count(*) as total_transactions,
  round(count(*)::double / (select count(*) from users), 1) as avg_transactions_per_user from tx"""))
def overall_counts(spark, d):
    return rep.overall_counts(users(spark, d), tx(spark, d))


@query("n4_feature_table_stats", S.with_("users", """
select count(*) as processed_users, 26 as feature_columns from users"""))
def feature_table_stats(spark, d):
    return rep.feature_table_stats(feats(spark, d))


def _hist(table: str, expr: str, bins: int) -> str:
    return f"""select cast(bin as int) as bin, round(lo + w * bin, 6) as low,
  round(lo + w * (bin + 1), 6) as high, count(*) as cnt
from (select least(floor((x - lo) / w), {bins - 1}) as bin, lo, w from
  (select {expr} as x from {table}),
  (select min({expr}) as lo, (max({expr}) - min({expr})) / {float(bins)!r}::double as w from {table}))
group by bin, lo, w"""


@query("n5_histogram", S.with_("tx", _hist("tx", "amount", 50)))
def histogram(spark, d):
    return rounded(rep.histogram(tx(spark, d), F.col("amount"), 50))


@query("n5_histogram_age", S.with_("users", _hist("users", "cast(age as double)", 20)))
def histogram_age(spark, d):
    return rounded(rep.histogram(users(spark, d), F.col("age"), 20))


@query("n6_log_histogram", S.with_("tx", _hist("tx", "log10(amount + 1)", 50)))
def log_histogram(spark, d):
    return rounded(rep.log_histogram(tx(spark, d), "amount", 50))


_MARKED = ["amount", "hour_of_day", "day_of_month"]


@query("n7_mean_median_markers", S.with_("tx", " union all ".join(
    f"select '{c}' as feature, round(avg({c}), 6) as mean, round(cast(median({c}) as double), 6) as median from tx"
    for c in _MARKED)))
def mean_median(spark, d):
    return rounded(rep.mean_median_markers(tx(spark, d), _MARKED))


@query("n8_hourly_counts", S.with_("tx", """
select hour_of_day, count(*) as cnt from tx group by hour_of_day order by hour_of_day"""))
def hourly(spark, d):
    return rep.hourly_counts(tx(spark, d))


@query("n9_card_share", S.with_("tx", _share("tx", "card_type")))
def card_share(spark, d):
    return rep.card_share(tx(spark, d))


def _box(table: str, group: str, value: str) -> str:
    return f"""select {group}, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  min(x) as minimum, max(x) as maximum,
  min(case when inside then x end) as whisker_low, max(case when inside then x end) as whisker_high,
  count(*) filter (where not inside) as outliers
from (select *, x between q1 - (q3 - q1) * 1.5 and q3 + (q3 - q1) * 1.5 as inside
  from (select {group}, cast({value} as double) as x from {table}) join
    (select {group}, quantile_cont(cast({value} as double), 0.25) as q1,
       quantile_cont(cast({value} as double), 0.5) as median,
       quantile_cont(cast({value} as double), 0.75) as q3 from {table} group by {group}) using ({group}))
group by {group}, q1, median, q3"""


@query("n10_boxplot_stats", S.with_("tx", _box("tx", "card_type", "amount")))
def boxplot(spark, d):
    out = rep.boxplot_stats(tx(spark, d), "card_type", "amount")
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("n10_boxplot_age_band", S.with_("feats", _box(
    "(select *, case when age > 0 and age <= 30 then 'Young' when age > 30 and age <= 50 then 'Middle' "
    "when age > 50 and age <= 100 then 'Senior' end as age_band from feats)", "age_band",
    "total_transactions")))
def boxplot_age(spark, d):
    f = feats(spark, d).withColumn("age_band", age_band(F.col("age")))
    out = rep.boxplot_stats(f, "age_band", "total_transactions")
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("n11_normal_vs_anomaly", S.with_("ltx", """
select noisy as is_anomaly, count(*) as cnt from (select user_id,
  sum(is_noise::int)::double / count(*) > 0.1::double as noisy from ltx group by user_id) group by noisy"""))
def normal_vs_anomaly(spark, d):
    from ..operators.relational import user_noise_ratio
    flagged = user_noise_ratio(ltx(spark, d)).withColumn("is_anomaly", F.col("noise_ratio") > 0.1)
    return rep.counts_by_flag(flagged, "is_anomaly")


@query("n13_scatter_sample", S.with_("feats", """
select user_id, round(total_amount, 6) as total_amount, total_transactions from feats
order by md5(cast(user_id as varchar) || ':sample'), user_id limit 500"""))
def scatter(spark, d):
    return rounded(rep.scatter_sample(feats(spark, d), "user_id",
                                      ["total_amount", "total_transactions"], 500))


@query("n14_dashboard_stats", S.with_("feats ltx", """
select (select count(*) from users) as total_users, round(avg(total_amount), 6) as avg_total_amount,
  round(avg(total_transactions), 6) as avg_transactions, round(avg(age), 6) as avg_age,
  (select count(*) from ltx) as total_transactions,
  round((select avg(is_noise::int) from ltx) * 100.0::double, 6) as noise_percentage from feats"""))
def dashboard(spark, d):
    return rounded(rep.dashboard_stats(users(spark, d), feats(spark, d), ltx(spark, d)))


@query("n15_noise_share", S.with_("ltx", "select round(avg(is_noise::int), 6) as noise_share from ltx"))
def noise_share(spark, d):
    return rounded(rep.noise_share(ltx(spark, d)))


@query("n16_generation_report", S.with_("ltx", """
select metric, round(value, 2) as value from (
  select 'total_users' as metric, count(*)::double as value from users
  union all select 'total_transactions', count(*) from ltx
  union all select 'total_amount', sum(amount) from ltx
  union all select 'avg_transactions_per_user', count(*)::double / (select count(*) from users) from ltx
  union all select 'noise_transactions', sum(is_noise::int) from ltx
  union all select 'noise_percentage', sum(is_noise::int) * 100.0::double / count(*) from ltx
  union all select 'noise:' || kind, count(*) from
    (select unnest(string_split(noise_type, ',')) as kind from ltx where is_noise) group by kind)"""))
def generation_report(spark, d):
    return rounded(rep.generation_report(users(spark, d), ltx(spark, d)), 2)


# -- data quality -----------------------------------------------------------------------------

@query("o1_pk_duplicates", """
select user_id, ts_hour, cnt from (select user_id, date_trunc('hour', ts) as ts_hour, count(*) as cnt
from events group by all) where cnt > 1""")
def pk_duplicates(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    return qual.duplicate_keys(events.select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_hour")),
        ["user_id", "ts_hour"])


@query("o1_pk_duplicates_single", """
select o_custkey, count(*) as cnt from orders group by o_custkey having count(*) > 1""")
def pk_duplicates_single(spark, d):
    return qual.duplicate_keys(spark.read.parquet(f"{d}/orders.parquet"), ["o_custkey"])


@query("o2_orphans", """
select doc_id, count(*) as cnt from documents where doc_id not in (select doc_id from labels) group by doc_id""")
def orphans(spark, d):
    return qual.orphans(spark.read.parquet(f"{d}/documents.parquet"), "doc_id",
                        spark.read.parquet(f"{d}/labels.parquet"), "doc_id")


_CHECKED = ["transaction_id", "user_id", "amount", "noise_type"]


@query("o3_not_null_violations", S.with_("ltx", " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as violations from ltx"
    for c in _CHECKED)))
def not_null(spark, d):
    return qual.not_null_violations(ltx(spark, d), _CHECKED)


_PERTURBED = f"""pusers as (select user_id, birth_year,
  case when {S.u('user_id', 'p_age')} < 0.01::double then {S.pick(S.u('user_id', 'p_age_v'), C.NOISY_AGES)}
    else age end as age from users)"""


@query("o4_age_birth_year_mismatch", S.with_("users", """
select user_id, cast(age as int) as age, birth_year, cast(2024 - birth_year as int) as expected_age
from pusers where age <> 2024 - birth_year""", extra=_PERTURBED))
def age_mismatch(spark, d):
    return qual.age_birth_year_mismatch(perturb_users(users(spark, d)))


@query("o5_range_violations", S.with_("users ltx", """
select 'age' as rule, count(*) filter (where age not between 18 and 80) as violations from pusers
union all select 'amount', count(*) filter (where amount not between 1000 and 50000000) from ltx
union all select 'hour_of_day', count(*) filter (where hour_of_day not between 0 and 23) from ltx""",
    extra=_PERTURBED))
def range_violations(spark, d):
    return qual.range_violations(perturb_users(users(spark, d)), ltx(spark, d))


@query("o6_derived_mismatch", S.with_("tx", """
select rule, sum(bad) as violations from (
  select 'hour_of_day' as rule, (h <> cast(substr(transaction_time, 1, 2) as int))::int::bigint as bad from shifted
  union all select 'is_weekend', (is_weekend <> (isodow(transaction_date) = 5))::int from shifted
  union all select 'day_of_month', (day_of_month <> day(transaction_date))::int from shifted)
group by rule""".replace("sum(bad)", "cast(sum(bad) as bigint)"), extra="""shifted as (
  select transaction_time, is_weekend, day_of_month, transaction_date,
    case when amount > 100 then (hour_of_day + 1) % 24 else hour_of_day end as h from tx)"""))
def derived_mismatch(spark, d):
    late = F.when(F.col("amount") > 100, (F.col("hour_of_day") + 1) % 24).otherwise(
        F.col("hour_of_day"))
    return qual.derived_mismatch(tx(spark, d).withColumn("hour_of_day", late))
