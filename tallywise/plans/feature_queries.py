"""The user feature row and table-level statistics."""

from pyspark.sql import functions as F

from ..operators import features as f
from . import sqltext as S
from .inputs import FLOAT_FEATURES, INT_FEATURES, TEXT_FEATURES, feats, ltx, rounded, tx, users
from .registry import query


def _sql(columns: list[str], only_active: bool = True) -> str:
    text = [c for c in columns if c in TEXT_FEATURES]
    ints = [c for c in columns if c in INT_FEATURES]
    floats = [c for c in columns if c in FLOAT_FEATURES]
    cols = ", ".join(["user_id", *text, *ints, *[f"round(cast({c} as double), 9) as {c}" for c in floats]])
    active = " where total_transactions > 0" if only_active else ""
    return S.with_("feats", f"select {cols} from feats{active}")


@query("d1_volume_features", _sql(f.VOLUME))
def volume(spark, d):
    return rounded(f.volume_features(tx(spark, d)), 9)


@query("d2_temporal_features", _sql(f.TEMPORAL))
def temporal(spark, d):
    return rounded(f.temporal_features(tx(spark, d)), 9)


@query("d3_geo_features", _sql(f.GEO))
def geo(spark, d):
    return rounded(f.geo_features(tx(spark, d)), 9)


@query("d4_amount_distribution_features", _sql(f.AMOUNT_DISTRIBUTION))
def amount_distribution(spark, d):
    return rounded(f.amount_distribution_features(tx(spark, d)), 9)


@query("d5_behavioral_features", _sql(f.BEHAVIORAL))
def behavioral(spark, d):
    return rounded(f.behavioral_features(tx(spark, d)), 9)


@query("d6_demographics", _sql(["age", "birth_year"], only_active=False))
def demographics(spark, d):
    return users(spark, d).select("user_id", "age", "birth_year")


@query("d7_user_features", _sql(INT_FEATURES + TEXT_FEATURES + FLOAT_FEATURES, only_active=False))
def user_features(spark, d):
    return rounded(feats(spark, d), 9)


@query("c2_users_left_features", _sql(
    ["total_transactions", "avg_hour_of_day", "most_frequent_city", "regularity_score"],
    only_active=False))
def users_left_features(spark, d):
    return rounded(feats(spark, d).select(
        "user_id", "total_transactions", "avg_hour_of_day", "most_frequent_city",
        "regularity_score"), 9)


@query("d8_database_stats", S.with_("ltx", """
select (select count(*) from users) as total_users, count(*) as total_transactions,
  round(sum(amount), 2) as total_amount,
  round(count(*)::double / (select count(*) from users), 6) as avg_transactions_per_user,
  cast(sum(is_noise::int) as bigint) as noise_transactions,
  round(sum(is_noise::int) * 100.0::double / count(*), 6) as noise_percentage
from ltx"""))
def database_stats(spark, d):
    stats = f.database_stats(users(spark, d), ltx(spark, d))
    return rounded(stats.withColumn("total_amount", F.round("total_amount", 2)))


@query("d9_noise_statistics", S.with_("ltx", """
select noise_kind, count(*) as cnt,
  round(count(*) * 100.0::double / (select count(*) from ltx where is_noise), 6) as percentage
from (select unnest(string_split(noise_type, ',')) as noise_kind from ltx where is_noise)
group by noise_kind"""))
def noise_statistics(spark, d):
    return rounded(f.noise_statistics(ltx(spark, d)))


@query("d10_noise_type_breakdown", S.with_("ltx", """
select noise_type, count(*) as cnt,
  round(count(*) * 100.0::double / (select count(*) from ltx), 6) as percentage
from ltx where is_noise group by noise_type"""))
def noise_type_breakdown(spark, d):
    return rounded(f.noise_type_breakdown(ltx(spark, d)))


@query("d11_distinct_counts", S.with_("tx", """
select user_id, count(distinct transaction_date) as n_distinct from tx group by user_id"""))
def distinct_counts(spark, d):
    return f.distinct_counts(tx(spark, d), ["user_id"], "transaction_date")


@query("d12_value_counts", S.with_("tx", """
select city, count(*) as cnt from tx group by city order by cnt desc, city"""))
def value_counts(spark, d):
    return f.value_counts(tx(spark, d), "city")
