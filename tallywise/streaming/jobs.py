"""Incremental refresh and streams over transaction files.

No operator here keeps streaming state: what has to last from batch to batch are tables of counts, which
a batch adds to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.anomaly import rule_flags
from ..operators import features as feat
from ..operators.features import missing_features, user_features
from ..operators.synth import with_user_age
from ..session import cut_lineage, delete, exists, release, rename
from ..sources.sinks import write_partitions


def incremental_features(users: DataFrame, tx: DataFrame, features: DataFrame) -> DataFrame:
    """Feature rows of the users that have none yet, ready to append."""
    todo = missing_features(users, features)
    return user_features(users.join(todo, "user_id", "left_semi"),
                         tx.join(todo, "user_id", "left_semi"))


def _run(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def idempotent_batches(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write the rows of every source file once, whatever the batch limits and the order of arrival.

    A source is named by the hash of its whole path, so equal names in two folders stay apart, and is
    never split between micro-batches. A batch writes its sources under a name of its own and then
    renames a manifest of them into place; rows whose manifest is not there are not visible, so a
    write that is cut short leaves nothing. A replayed source gets another version, of which
    `committed_rows` shows the last. `stream` reads files.
    """
    named = stream.select("*", F.sha2(F.col("_metadata.file_path"), 256).alias("source"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, f"{batch_id:012d}-{uuid.uuid4().hex}"
        batch.withColumn("version", F.lit(version)).write.mode("append").partitionBy(
            "version", "source").parquet(f"{path}/rows")
        sources = batch.select("source").distinct().withColumn("version", F.lit(version))
        sources.coalesce(1).write.json(f"{path}/pending/{version}")
        rename(spark, f"{path}/pending/{version}", f"{path}/manifest/{version}")

    _run(named.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


_MANIFEST = "source string, version string"


def committed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that `idempotent_batches` made visible, of every source its last version."""
    if not exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], schema)
    last = spark.read.schema(_MANIFEST).json(f"{path}/manifest/*").groupBy("source").agg(
        F.max("version").alias("version"))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType()),
                                           T.StructField("source", T.StringType())])).parquet(f"{path}/rows")
    return rows.join(last, ["source", "version"], "left_semi").select(*schema.names)


def drop_superseded(spark: SparkSession, path: str) -> None:
    """Delete what no manifest shows: versions that were replayed or cut short. Not while a batch is being written."""
    shown = spark.read.schema(_MANIFEST).json(f"{path}/manifest/*").groupBy("source").agg(
        F.max("version").alias("version"))
    there = spark.read.parquet(f"{path}/rows").select("version", "source").distinct()
    for row in there.join(shown, ["version", "source"], "left_anti").toLocalIterator():
        delete(spark, f"{path}/rows/version={row['version']}/source={row['source']}")


def refresh_features(spark: SparkSession, stream: DataFrame, users: DataFrame, path: str, checkpoint: str,
                     buckets: int = 16) -> None:
    """Keep the features of users up with new transaction files, without a history of transactions.

    What is kept of a user are counts of values (`value_counts_by_user`), to which a batch adds its own.
    Users fall into `buckets` by hash; a batch reads the counts of its users' buckets and writes a new
    version of each with its users' features, then a manifest of the buckets and of the source files that
    went in, renamed into place. Files that a manifest names are left out of later batches, so a replay with a
    fresh checkpoint and other limits adds nothing, and a batch cut short leaves nothing. Versions without a use
    are deleted. Choose `buckets` so that the counts of one fit a few tasks. `stream` reads files.
    """
    named = stream.select("*", F.sha2(F.col("_metadata.file_path"), 256).alias("source"))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        done = _manifest(spark, path)
        fresh = cut_lineage(batch.join(done.where("source is not null").select("source").distinct(), "source", "left_anti")
                            .withColumn("bucket", _bucket(buckets)))
        mine = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if mine:
            version = f"{done.agg(F.max('at')).first()[0] or 0:012d}-{uuid.uuid4().hex}"
            held = _current(spark, path, "counts").where(F.col("bucket").isin(mine))
            counts = cut_lineage(feat.merged_runs(
                held.drop("bucket"), feat.value_counts_by_user(fresh, feat.RUN_KINDS)).withColumn("bucket", _bucket(buckets)))
            seen = counts.select("user_id").distinct()
            rows = feat.features_of_runs(users.join(seen, "user_id", "left_semi"), counts.drop("bucket"))
            for name, df in (("counts", counts), ("features", rows.withColumn("bucket", _bucket(buckets)))):
                df.withColumn("version", F.lit(version)).write.mode("append").partitionBy(
                    "version", "bucket").parquet(f"{path}/{name}")
            at = F.lit((done.agg(F.max("at")).first()[0] or 0) + 1).cast("long").alias("at")
            blank = lambda c, kind: F.lit(None).cast(kind).alias(c)
            entries = fresh.select("bucket").distinct().select("bucket", blank("source", "string")).union(
                fresh.select("source").distinct().select(blank("bucket", "int"), "source"))
            entries.select("bucket", "source", F.lit(version).alias("version"), at).coalesce(1).write.json(
                f"{path}/pending/{version}")
            rename(spark, f"{path}/pending/{version}", f"{path}/manifest/{version}")
            release(counts)
            _drop_old(spark, path)
        release(fresh)

    _run(named.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


_ENTRY = "bucket int, source string, version string, at long"


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """What every version holds: a row per bucket and per source; `at` numbers the versions."""
    if not exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).json(f"{path}/manifest/*")


def _last_versions(spark: SparkSession, path: str) -> DataFrame:
    return _manifest(spark, path).where("bucket is not null").groupBy("bucket").agg(
        F.max(F.struct("at", "version")).alias("_l")).select("bucket", F.col("_l.version").alias("version"))


def _current(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of the last version of every bucket."""
    if name == "counts" and not exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], "user_id long, kind string, value string, cnt long, bucket int")
    rows = spark.read.option("recursiveFileLookup", False).parquet(f"{path}/{name}")
    return rows.join(F.broadcast(_last_versions(spark, path)), ["version", "bucket"], "left_semi").drop("version")


def _drop_old(spark: SparkSession, path: str) -> None:
    last = {(r["version"], r["bucket"]) for r in _last_versions(spark, path).collect()}  # a row per bucket
    for name in ("counts", "features"):
        for row in spark.read.parquet(f"{path}/{name}").select("version", "bucket").distinct().collect():
            if (row["version"], row["bucket"]) not in last:
                delete(spark, f"{path}/{name}/version={row['version']}/bucket={row['bucket']}")


def current_features(spark: SparkSession, path: str) -> DataFrame:
    """The newest feature row of every user that had a transaction."""
    return _current(spark, path, "features").drop("bucket")


def stream_rule_flags(stream: DataFrame, users: DataFrame, path: str, checkpoint: str) -> None:
    """Rule flags on a transaction stream: a stream-static join and stateless columns."""
    flagged = rule_flags(with_user_age(stream, users))
    _run(flagged.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint))


def chunk_stats(batches: DataFrame) -> DataFrame:
    """Rows, users and amounts per batch."""
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("users"),
        F.sum("amount").alias("total_amount"), F.avg("amount").alias("avg_amount"))


def stage_completeness(tables: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows, target, percentage): rows present against rows wanted."""
    out = None
    for stage, df in tables.items():
        row = df.agg(F.count("*").alias("rows")).withColumn(
            "target", targets[stage].agg(F.count("*")).scalar()).select(
            F.lit(stage).alias("stage"), "rows", "target",
            F.coalesce(F.try_divide(F.col("rows") * 100.0, F.col("target")), F.lit(0.0))
            .alias("percentage"))
        out = row if out is None else out.unionByName(row)
    return out
