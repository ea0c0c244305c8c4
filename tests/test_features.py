"""Edge cases of the user feature row."""

import pytest
from pyspark.sql import functions as F
from conftest import transactions

from tallywise.constants import FALLBACK_CITY
from tallywise.operators import features as feat
from tallywise.operators import reports as rep
from tallywise.operators.relational import with_share

ROW = ("c", "p", "card", "dev")


def features(spark, rows, users=((1, 30, 1994),)):
    u = spark.createDataFrame(list(users), "user_id long, age int, birth_year int")
    return {r["user_id"]: r for r in feat.user_features(u, transactions(spark, rows)).collect()}


def test_user_without_transactions_gets_defaults(spark):
    f = features(spark, [(1, 5.0, "2024-01-01", 9, *ROW)], [(1, 30, 1994), (2, 40, 1984)])[2]
    assert f["total_transactions"] == 0 and f["avg_hour_of_day"] == 12.0
    assert f["most_frequent_city"] == FALLBACK_CITY and f["regularity_score"] == 0.0
    assert f["amount_skewness"] == 0.0 and f["age"] == 40


def test_single_transaction(spark):
    f = features(spark, [(1, 7.5, "2024-01-01", 9, *ROW)])[1]
    assert f["std_transaction_amount"] == 0.0 and f["std_hour_of_day"] == 0.0
    assert f["amount_percentile_25"] == f["amount_percentile_75"] == 7.5
    assert f["amount_iqr"] == 0.0 and f["amount_skewness"] == 0.0
    assert f["regularity_score"] == 1.0 and f["transaction_frequency"] == 1.0


def test_constant_amounts_and_equal_days(spark):
    rows = [(1, 0.1, f"2024-01-{day:02d}", 9, *ROW) for day in (1, 1, 2, 2, 3, 3)]
    f = features(spark, rows)[1]
    assert f["amount_skewness"] == 0.0 and f["regularity_score"] == 1.0
    assert f["transaction_frequency"] == 2.0


def test_tie_takes_smallest_name(spark):
    rows = [(1, 1.0, "2024-01-01", 9, c, "p", "k", "d") for c in ("b", "a", "a", "b")]
    assert features(spark, rows)[1]["most_frequent_city"] == "a"


def test_night_and_weekend_borders(spark):
    rows = [(1, 1.0, "2024-01-01", h, *ROW) for h in (6, 7, 21, 22)]
    assert features(spark, rows)[1]["night_transaction_ratio"] == 0.5
    rows = [(1, 1.0, d, 9, *ROW) for d in ("2024-01-04", "2024-01-05", "2024-01-06")]
    assert features(spark, rows)[1]["weekend_transaction_ratio"] == pytest.approx(1 / 3)


def test_empty_transactions(spark):
    empty = transactions(spark, [(1, 1.0, "2024-01-01", 9, *ROW)]).where("false")
    u = spark.createDataFrame([(1, 30, 1994)], "user_id long, age int, birth_year int")
    assert feat.user_features(u, empty).first()["total_transactions"] == 0
    from pyspark.sql import functions as F
    stats = feat.database_stats(u, empty.withColumn("is_noise", F.lit(False))).first()
    assert stats["noise_percentage"] == 0.0 and stats["total_amount"] == 0.0


def test_a_hot_user_gives_the_same_row_however_dealt(spark, folder):
    from tallywise.sources import tables
    u, t = tables.users(spark, folder), tables.transactions(spark, folder)
    key = lambda df: sorted(map(tuple, df.select(
        "user_id", "median_transaction_amount", "amount_percentile_25", "amount_percentile_75").collect()))
    hot = u.first()["user_id"]
    t = t.selectExpr("*").withColumn("user_id", F.when(F.col("transaction_id") % 3 == 0, hot).otherwise(F.col("user_id")))
    assert key(feat.user_features(u, t)) == key(feat.user_features(u, t.repartition(13)))


def test_age_buckets(spark):
    u = spark.createDataFrame([(17,), (18,), (25,), (26,), (65,), (66,), (95,)], "age int")
    got = {r["age_group"]: r["cnt"] for r in rep.age_group_distribution(u).collect()}
    assert got == {"18-25": 2, "26-35": 1, "56-65": 1, "65+": 3}


def test_shares_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "city string, cnt long")
    assert with_share(empty).collect() == []


def test_histogram_of_a_constant_column(spark):
    from pyspark.sql import functions as F
    rows = rep.histogram(spark.range(5).select(F.lit(3.0).alias("x")), F.col("x"), 10).collect()
    assert sum(r["cnt"] for r in rows) == 5 and all(r["low"] <= 3.0 <= r["high"] for r in rows)
