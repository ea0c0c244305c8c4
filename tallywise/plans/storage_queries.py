"""Sinks, table maintenance, incremental refresh and streams, checked after re-reading."""

from pyspark.sql import functions as F

from .. import schemas
from ..operators import features as feat
from ..session import rename, work_path
from ..sources import sinks, tables
from ..streaming import jobs
from . import sqltext as S
from .inputs import feats, ltx, rounded, tx, users, vectors
from .model_queries import RULED
from .registry import query

_USER = ["user_id", "age", "birth_year", "province", "city", "preferred_card_type", "primary_device"]
_TX = ["transaction_id", "user_id", "amount", "transaction_date", "transaction_time", "province",
       "city", "card_type", "device_type", "is_weekend", "hour_of_day", "day_of_month"]


@query("a6_upsert_users", S.with_("users", f"""
select {', '.join(_USER)} from users where age >= 30
union all select user_id, cast(age + 1 as int), {', '.join(_USER[2:])} from users where age < 30"""))
def upsert_users(spark, d):
    stored = work_path(spark, "users")
    users(spark, d).where("age < 60").select(*_USER).write.parquet(stored + "/0")
    changed = users(spark, d).where("age < 30 or age >= 60").select(*_USER).withColumn(
        "age", F.when(F.col("age") < 30, F.col("age") + 1).otherwise(F.col("age")))
    merged = sinks.upsert(spark.read.parquet(stored + "/0"), changed, ["user_id"])
    merged.write.parquet(stored + "/1")
    return spark.read.parquet(stored + "/1")


@query("a7_replace_by_method", """
select vec_id as user_id, label as cluster_id, 'kmeans' as cluster_method from embeddings
union all select vec_id, cast(label % 3 as int), 'dbscan' from embeddings""")
def replace_by_method(spark, d):
    path = work_path(spark, "clusters")
    rows = vectors(spark, d).select(F.col("vec_id").alias("user_id"), F.col("label").alias("cluster_id"))
    as_method = lambda df, m: df.withColumn("cluster_method", F.lit(m))
    put = lambda df, *methods: sinks.replace_by_method(df, path, "cluster_method", list(methods))
    put(as_method(rows, "kmeans"), "kmeans")
    put(as_method(rows, "dbscan").unionByName(as_method(rows, "mixture")), "dbscan", "mixture")
    coarser = rows.withColumn("cluster_id", F.col("cluster_id") % 3)
    put(as_method(coarser, "dbscan"), "dbscan")
    put(as_method(rows.where("false"), "mixture"), "mixture")
    return spark.read.parquet(path)


@query("a8_append_transactions", S.with_("tx", f"""
select {', '.join(_TX)}, false as is_noise, null::varchar as noise_type from tx"""))
def append_transactions(spark, d):
    path = work_path(spark, "transactions")
    sinks.append_transactions(tx(spark, d).where("not is_weekend"), path)
    sinks.append_transactions(tx(spark, d).where("is_weekend"), path)
    return spark.read.parquet(path)


@query("a6_upsert_sequence", S.with_("users", """
select user_id, age, last_value from (
  select user_id, cast(age as int) as age, cast(3 as int) as last_value from users where user_id % 2 = 0
  union all select user_id, cast(age as int), 0 from users where user_id % 2 = 1)"""))
def upsert_sequence(spark, d):
    """Three writes of each even user in one batch, the largest value not last."""
    stored = users(spark, d).select("user_id", "age", F.lit(0).alias("last_value"))
    writes = stored.where("user_id % 2 = 0").withColumn("at", F.explode(F.array(*map(F.lit, (2, 1, 3))))).withColumn(
        "last_value", F.when(F.col("at") == 3, 3).otherwise(F.lit(10) - F.col("at")))
    return sinks.upsert(stored, writes, ["user_id"], "at")


@query("a8_append_continues", S.with_("tx", """
select user_id, transaction_date, transaction_time, row_number() over (
  order by is_weekend, user_id, transaction_date, transaction_time) as transaction_id from tx"""))
def append_continues(spark, d):
    """Two appends without ids: the second goes on where the first ended."""
    path = work_path(spark, "continued")
    for part in ("not is_weekend", "is_weekend"):
        sinks.append_transactions(
            tx(spark, d).where(part).select("user_id", "transaction_date", "transaction_time"), path)
    return spark.read.parquet(path).drop("is_noise", "noise_type")


@query("a8_surrogate_keys", S.with_("tx", """
select user_id, transaction_date, transaction_time, row_number() over (
  order by user_id, transaction_date, transaction_time) + 1000 as transaction_id from tx"""))
def surrogate_keys(spark, d):
    path = work_path(spark, "keyed")
    bare = tx(spark, d).select("user_id", "transaction_date", "transaction_time")
    sinks.append_transactions(bare, path, first_id=1001)
    return spark.read.parquet(path).drop("is_noise", "noise_type")


@query("a9_overwrite_features", S.with_("feats", """
select user_id, total_transactions, round(total_amount, 6) as total_amount, most_frequent_city from feats"""))
def overwrite_features(spark, d):
    path = work_path(spark, "features")
    f = feats(spark, d).select("user_id", "total_transactions", "total_amount", "most_frequent_city")
    sinks.overwrite_features(f.where("user_id < 0"), path)
    sinks.overwrite_features(f, path)
    return rounded(spark.read.parquet(path))


@query("a10_create_typed_tables", S.with_("users", """
select user_id, age, birth_year, registration_date, province, city, preferred_card_type, primary_device
from users"""))
def create_typed_tables(spark, d):
    folder = work_path(spark, "tables")
    sinks.create_typed_tables(spark, folder)
    sinks.conform(users(spark, d), schemas.USERS).write.mode("append").parquet(f"{folder}/users")
    return spark.read.schema(schemas.USERS).parquet(f"{folder}/users").drop("created_at")


@query("a11_layout_for_access", S.with_("tx", """
select user_id, count(*) as cnt, round(sum(amount), 4) as total from tx
where transaction_date between date '2024-01-05' and date '2024-01-12' group by user_id"""))
def layout_for_access(spark, d):
    path = work_path(spark, "laid-out")
    sinks.write_laid_out(tx(spark, d), path)
    week = spark.read.parquet(path).where("transaction_date between '2024-01-05' and '2024-01-12'")
    return week.groupBy("user_id").agg(F.count("*").alias("cnt"), F.round(F.sum("amount"), 4).alias("total"))


@query("a11_bucketed_join", S.with_("tx users", """
select user_id, any_value(age) as age, count(*) as cnt, max(amount) as largest
from tx join users using (user_id) group by user_id"""))
def bucketed_join(spark, d):
    name = work_path(spark, "bucketed")
    suffix = name[-32:]
    left = sinks.write_bucketed(tx(spark, d), f"tx_{suffix}", name + "/tx")
    right = sinks.write_bucketed(users(spark, d), f"users_{suffix}", name + "/users")
    return left.join(right.select("user_id", "age"), "user_id").groupBy("user_id").agg(
        F.first("age").alias("age"), F.count("*").alias("cnt"), F.max("amount").alias("largest"))


@query("a12_large_tx_subset", S.with_("ltx", """
select transaction_id, user_id, round(amount, 4) as amount from ltx where amount > 1000000"""))
def large_tx(spark, d):
    return rounded(ltx(spark, d).where("amount > 1000000").select("transaction_id", "user_id", "amount"), 4)


@query("a12_very_large_tx_subset", S.with_("ltx", """
select transaction_id, user_id, round(amount, 4) as amount from ltx where amount > 5000000"""))
def very_large_tx(spark, d):
    return rounded(ltx(spark, d).where("amount > 5000000").select("transaction_id", "user_id", "amount"), 4)


@query("a14_summary_json_sink", S.with_("ltx", """
select (select count(*) from users) as total_users, count(*) as total_transactions,
  count(*) filter (is_noise) as noise_transactions from ltx"""))
def summary_json(spark, d):
    path = work_path(spark, "summary")
    stats = feat.database_stats(users(spark, d), ltx(spark, d))
    sinks.write_json_summary(stats, path)
    return spark.read.json(path).select("total_users", "total_transactions", "noise_transactions")


@query("a15_csv_sink", S.with_("tx", "select city, count(*) as cnt from tx group by city"))
def csv_sink(spark, d):
    path = work_path(spark, "report")
    sinks.write_csv_report(feat.value_counts(tx(spark, d), "city"), path)
    return spark.read.option("header", True).schema("city string, cnt bigint").csv(path)


# -- incremental and streaming ----------------------------------------------------------------

_KEPT = ["total_transactions", "total_amount", "median_transaction_amount", "most_frequent_city",
         "amount_percentile_75"]
_KEPT_SQL = """user_id, total_transactions, round(total_amount, 6) as total_amount,
  round(median_transaction_amount, 6) as median_transaction_amount, most_frequent_city,
  round(amount_percentile_75, 6) as amount_percentile_75"""


@query("p1_incremental_features", S.with_("feats", f"select {_KEPT_SQL} from feats"))
def incremental_features(spark, d):
    path = work_path(spark, "incremental")
    u, t = users(spark, d), tx(spark, d)
    sinks.overwrite_features(feat.user_features(u.where("age < 40"), t), path)
    jobs.incremental_features(u, t, spark.read.parquet(path)).write.mode("append").parquet(path)
    return rounded(spark.read.parquet(path).select("user_id", *_KEPT))


def _files(spark, d, name: str, parts: int = 3) -> str:
    """The transactions as several files arriving one after another."""
    path = work_path(spark, name)
    t = tx(spark, d).withColumn("_p", F.pmod(F.xxhash64("transaction_id"), F.lit(parts)))
    t.repartition(parts, "_p").drop("_p").write.parquet(path)
    return path


@query("p2_resumable_feature_stream", S.with_("feats tx", f"""
select {_KEPT_SQL} from feats where user_id in (select user_id from tx)"""))
def feature_stream(spark, d):
    source = work_path(spark, "arrivals")
    state = work_path(spark, "stream")
    t = tx(spark, d)
    for run, arrived in (("first", "transaction_date < '2024-01-15'"), ("second", "transaction_date >= '2024-01-15'")):
        # The second run has a fresh checkpoint: it sees all files and adds the new ones.
        t.where(arrived).write.mode("append").parquet(source)
        stream = spark.readStream.schema(t.schema).parquet(source)
        jobs.refresh_features(spark, stream, users(spark, d), state + "/kept", state + "/" + run)
    return rounded(jobs.current_features(spark, state + "/kept").select("user_id", *_KEPT))


@query("p3_stage_completeness", S.with_("users tx", """
select 'users' as stage, count(*) as rows, count(*) as target, 100.0::double as percentage from users
union all select 'features', count(distinct user_id), (select count(*) from users),
  round(count(distinct user_id) * 100.0::double / (select count(*) from users), 6) from tx"""))
def stage_completeness(spark, d):
    u, t = users(spark, d), tx(spark, d)
    return rounded(jobs.stage_completeness(
        {"users": u, "features": feat.behavioral_features(t)}, {"users": u, "features": u}))


@query("p4_idempotent_batch_write", S.with_("tx", f"select {', '.join(_TX)} from tx"))
def idempotent_batch_write(spark, d):
    """Files of equal names in two folders; a second run with a fresh checkpoint and larger batches replays them."""
    state, t = work_path(spark, "batches"), tx(spark, d)
    first = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    for folder, part in (("a", first), ("b", ~first)):
        t.where(part).coalesce(1).write.parquet(f"{state}/pending-{folder}")
        rename(spark, part_file(spark, f"{state}/pending-{folder}"), f"{state}/source/{folder}/part-0.parquet")
    stream = lambda files: spark.readStream.schema(t.schema).option("maxFilesPerTrigger", files).option(
        "recursiveFileLookup", True).parquet(f"{state}/source")
    for run, files in (("/first", 1), ("/replay", 2)):
        jobs.idempotent_batches(stream(files), state + "/table", state + run)
    return jobs.committed_rows(spark, state + "/table", t.schema)


def part_file(spark, folder: str) -> str:
    """The one data file of a folder."""
    return spark.read.parquet(folder).select("_metadata.file_path").first()[0]


_RULES = ["rule_location", "rule_age_amount", "rule_time", "rule_amount", "rule_noise_type"]


@query("p5_stream_rule_flags", S.with_("ltx", "select transaction_id, " + ", ".join(_RULES) + " from ruled",
       extra=RULED))
def stream_rule_flags(spark, d):
    source, state = work_path(spark, "noisy"), work_path(spark, "flags")
    noisy = ltx(spark, d)
    noisy.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(noisy.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.stream_rule_flags(stream, users(spark, d), state + "/out", state + "/checkpoint")
    return spark.read.parquet(state + "/out").select("transaction_id", *_RULES)


@query("p6_chunk_stats", S.with_("tx", """
select cast(day_of_month as int) as batch_id, count(*) as rows, count(distinct user_id) as users,
  round(sum(amount), 4) as total_amount, round(avg(amount), 9) as avg_amount from tx group by day_of_month"""))
def chunk_stats(spark, d):
    out = jobs.chunk_stats(tx(spark, d).withColumn("batch_id", F.col("day_of_month")))
    return out.withColumns({"total_amount": F.round("total_amount", 4), "avg_amount": F.round("avg_amount", 9)})
