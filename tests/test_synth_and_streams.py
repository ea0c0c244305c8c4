"""Reproducible draws, labelled noise, idempotent writes and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import transactions
from tallywise import constants as C
from tallywise.functions.ranking import row_positions
from tallywise.operators import synth
from tallywise.operators.features import RUN_KINDS, features_of_runs, merged_runs, user_features, value_counts_by_user
from tallywise.plans.inputs import ltx, tx, users
from tallywise.session import work_path
from tallywise.sources import sinks
from tallywise.streaming import jobs


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(20_000).withColumnRenamed("id", "user_id").cache()


def test_draws_do_not_depend_on_partitions(ids):
    draw = lambda df: synth.user_attributes(df)
    assert draw(ids.repartition(3)).exceptAll(draw(ids.repartition(13))).count() == 0


def test_age_and_hour_shapes(ids):
    row = synth.draw_hour(synth.draw_age(ids, "user_id"), "user_id").agg(
        F.avg("age"), F.min("age"), F.max("age"), F.min("hour_of_day"), F.max("hour_of_day")).first()
    assert abs(row[0] - (18 + 62 * 2 / 7)) < 0.3 and row[1] >= 18 and row[2] <= 80
    assert row[3] >= 0 and row[4] == 23


def test_weights_and_poisson(ids):
    n = ids.count()
    cards = {r["card_type"]: r["count"] / n for r in synth.assign_card(ids, "user_id").groupBy("card_type").count().collect()}
    for name, (w, _) in C.CARDS.items():
        assert abs(cards[name] - w) < 4 * np.sqrt(w * (1 - w) / n)
    mean, var = synth.draw_poisson(ids, "user_id").agg(F.avg("daily_count"), F.var_pop("daily_count")).first()
    assert abs(mean - 3) < 0.06 and abs(var - 3) < 0.15


def test_noise_rates_and_exclusions(spark, ids):
    t = ids.select(F.col("user_id").alias("transaction_id"), "user_id", F.lit(2000.0).alias("amount"),
                   F.lit(C.START_DATE).alias("transaction_date"), F.lit("12:30:45").alias("transaction_time"),
                   F.lit("p").alias("province"), F.lit("c").alias("city"), F.lit("k").alias("card_type"),
                   F.lit("d").alias("device_type"), F.lit(False).alias("is_weekend"),
                   F.lit(12).alias("hour_of_day"), F.lit(1).alias("day_of_month"))
    age = F.when(F.col("user_id") % 3 == 0, F.lit(24)).when(F.col("user_id") % 3 == 1, F.lit(25))
    out = synth.perturb_transactions(t, ids.withColumn("age", age), {"age_amount": 0.5, "amount": 0.5}).cache()
    n = out.count()
    has = lambda label: out.where(F.array_contains(F.split("noise_type", ","), label))
    for label, rate in (("location_anomaly", 0.02), ("time_pattern_anomaly", 0.01)):
        assert abs(has(label).count() / n - rate) < 4 * np.sqrt(rate / n)
    young = has("age_amount_mismatch")
    assert young.where("user_id % 3 <> 0").count() == 0 and young.count() > 0.1 * n
    assert young.where("not amount between 5e6 and 2e7").count() == 0
    assert young.where("noise_type like '%amount_outlier%'").count() == 0
    assert has("time_pattern_anomaly").where(
        "not hour_of_day between 2 and 5 or cast(substr(transaction_time, 1, 2) as int) <> hour_of_day "
        "or substr(transaction_time, 3) <> ':30:45'").count() == 0
    assert out.where("is_noise <> (noise_type is not null)").count() == 0
    order = {name: i for i, name in enumerate(C.NOISE_LABELS)}
    for (text,) in out.where("noise_type like '%,%'").select("noise_type").distinct().collect():
        places = [order[p] for p in text.split(",")]
        assert places == sorted(places)


def test_zero_rate_means_zero(spark, folder):
    none = {k: 0.0 for k in C.NOISE_RATES}
    assert synth.perturb_transactions(tx(spark, folder), users(spark, folder), none).where("is_noise").count() == 0


def test_missing_columns_are_named(spark, folder):
    with pytest.raises(ValueError, match="hour_of_day"):
        synth.perturb_transactions(tx(spark, folder).drop("hour_of_day"), users(spark, folder))


def test_row_positions(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1000 as k").repartition(6)
    rows = row_positions(df, ["k"], "pos").collect()
    assert sorted((r["k"], r["pos"]) for r in rows) == [(i, i + 1) for i in range(1000)]


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, city string")
    new = spark.createDataFrame([(2, "z"), (3, "c")], "user_id long, city string")
    assert sorted(map(tuple, sinks.upsert(old, new, ["user_id"]).collect())) == [(1, "a"), (2, "z"), (3, "c")]


def test_replay_writes_the_same_rows_once(spark, folder):
    source, state = work_path(spark, "src"), work_path(spark, "out")
    t = tx(spark, folder)
    t.repartition(4).write.parquet(source)
    stream = lambda n: spark.readStream.schema(t.schema).option("maxFilesPerTrigger", n).parquet(source)
    shown = lambda: jobs.committed_rows(spark, state + "/t", t.schema)
    assert shown().count() == 0
    for run, files in (("/a", 1), ("/b", 3)):
        jobs.idempotent_batches(stream(files), state + "/t", state + run)
    assert shown().count() == t.count() and shown().exceptAll(t).count() == 0
    jobs.idempotent_batches(stream(1), state + "/t", state + "/a")  # nothing new: resumes at the end
    # Rows whose manifest never came are not shown, and go.
    t.limit(3).selectExpr("*", "'x' as version", "'y' as source").write.mode("append").partitionBy(
        "version", "source").parquet(state + "/t/rows")
    assert shown().count() == t.count() < spark.read.parquet(state + "/t/rows").count()
    jobs.drop_superseded(spark, state + "/t")
    assert shown().count() == t.count() == spark.read.parquet(state + "/t/rows").count()


def test_features_kept_by_counts_equal_features_of_all(spark, folder):
    source, state = work_path(spark, "arrive"), work_path(spark, "kept")
    t, u = tx(spark, folder), users(spark, folder)
    one = t.limit(1)
    more = t.unionByName(one)
    # Files of equal names in two folders, the second one later; then a replay with other limits.
    for name, part in (("a", t.repartition(3)), ("b", one)):
        part.write.parquet(f"{source}/{name}")
        jobs.refresh_features(spark, spark.readStream.schema(t.schema).option("recursiveFileLookup", True).option(
            "maxFilesPerTrigger", 2).parquet(source), u, state, state + "-c", 8)
        if name == "a":
            before = {r["user_id"]: r["total_transactions"] for r in jobs.current_features(spark, state).collect()}
    replay = lambda n, c: jobs.refresh_features(spark, spark.readStream.schema(t.schema).option(
        "recursiveFileLookup", True).option("maxFilesPerTrigger", n).parquet(source), u, state, state + c, 8)
    replay(1, "-d")
    got = {r["user_id"]: r.asDict() for r in jobs.current_features(spark, state).collect()}
    want = {r["user_id"]: r.asDict() for r in user_features(u, more).join(
        more.select("user_id").distinct(), "user_id", "left_semi").collect()}
    assert set(got) == set(want)
    for user, row in want.items():
        for name, value in row.items():
            assert got[user][name] == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value)
    user = one.first()["user_id"]
    assert {k: r["total_transactions"] for k, r in got.items()} == before | {user: before[user] + 1}
    # No transactions are stored, and only the last version of each bucket.
    counts = spark.read.parquet(state + "/counts")
    assert set(counts.columns) == {"user_id", "kind", "value", "cnt", "version", "bucket"}
    assert counts.groupBy("bucket").agg(F.count_distinct("version").alias("n")).where("n > 1").count() == 0


def test_counts_of_odd_rows(spark, folder):
    u = users(spark, folder)
    ids = [r[0] for r in u.select("user_id").limit(3).collect()]
    t = transactions(spark, [(ids[0], 5.0, "2024-01-05", 23, "a", "p", "c", "d")] * 4 + [
        (ids[1], None, "2024-01-06", None, None, "p", "c", None), (ids[1], 7.5, "2024-01-06", 3, "b", None, "c", "d"),
        (ids[1], 2.5, "2024-01-07", 12, "b", "q", "c", "e"), (ids[1], 1e9, "2024-01-07", 6, "a", "q", "c", "e")])
    runs = merged_runs(*[value_counts_by_user(t.where(c), RUN_KINDS) for c in ("amount > 5 or amount is null", "amount <= 5")])
    got = {r["user_id"]: r.asDict() for r in features_of_runs(u, runs).collect()}
    for r in user_features(u, t).collect():
        for name, value in r.asDict().items():
            assert got[r["user_id"]][name] == (pytest.approx(value, rel=1e-9) if isinstance(value, float) else value), name


def test_stage_completeness_of_an_empty_target(spark):
    empty = spark.createDataFrame([], "id long")
    row = jobs.stage_completeness({"s": empty}, {"s": empty}).first()
    assert row["rows"] == 0 and row["percentage"] == 0.0


def test_rule_flags_on_noise(spark, folder):
    from tallywise.operators.anomaly import rule_flags
    flagged = rule_flags(synth.with_user_age(ltx(spark, folder), users(spark, folder)))
    assert flagged.where("noise_type like '%location_anomaly%' and not rule_location").count() == 0
    assert flagged.where("noise_type like '%time_pattern%' and not rule_time").count() == 0
