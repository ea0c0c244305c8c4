"""Writing tables: upsert, replace by partition, append, layout, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.ranking import row_positions
from ..session import delete, exists


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a table schema; absent columns become NULL, others are dropped."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def create_typed_tables(spark: SparkSession, folder: str) -> None:
    """Empty parquet tables with the explicit schemas."""
    for name, schema in schemas.TABLES.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/{name}")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str],
           sequence: str | None = None) -> DataFrame:
    """Replace by key, last write wins. The caller writes the result to a new path.

    `sequence` is the column of `incoming` that orders the writes of one key. Several writes of a
    key with one place in that order are an error, as none of them is the last.
    """
    place = F.col(sequence) if sequence else F.lit(0)
    stacked = (existing.withColumns({"_batch": F.lit(0), "_at": F.lit(None)})
               .unionByName(incoming.withColumns({"_batch": F.lit(1), "_at": place}), allowMissingColumns=True))
    rest = [c for c in existing.columns if c not in keys]
    versions = stacked.groupBy(*keys, "_batch", "_at").agg(
        F.any_value(F.struct(*rest)).alias("_row"), F.count("*").alias("_n"))
    last = versions.groupBy(*keys).agg(
        F.max_by(F.struct("_row", "_n"), F.struct("_batch", "_at")).alias("_last"))
    row = F.when(F.col("_last._n") == 1, F.col("_last._row")).otherwise(
        F.raise_error(F.lit("several writes of one key share a place in the sequence")))
    return last.withColumn("_row", row).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in existing.columns])


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace only the partitions that occur in `df`; a retry writes the same files again."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def replace_by_method(df: DataFrame, path: str, method: str, methods: list[str]) -> None:
    """The rows of `methods` become those of `df`, none if it holds none; other methods stay."""
    spark = df.sparkSession
    held = {r[0] for r in df.select(method).distinct().collect()}  # a row per method
    if not held <= set(methods):
        raise ValueError(f"rows of {sorted(held - set(methods))} are not among the replaced methods")
    write_partitions(df, path, [method])
    for name in set(methods) - held:
        delete(spark, f"{path}/{method}={name}")


def replace_all(df: DataFrame, path: str, method: str) -> None:
    """The rows of `df` instead of those of every method."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(method).parquet(path)


def prepare_transactions(df: DataFrame, first_id: int = 1) -> DataFrame:
    """Default noise columns and, where missing, a gap-free surrogate key from `first_id`."""
    if "is_noise" not in df.columns:
        df = df.withColumn("is_noise", F.lit(False))
    if "noise_type" not in df.columns:
        df = df.withColumn("noise_type", F.lit(None).cast("string"))
    if "transaction_id" not in df.columns:
        order = [c for c in ("user_id", "transaction_date", "transaction_time", "row_no")
                 if c in df.columns]
        df = row_positions(df, order, "transaction_id").withColumn(
            "transaction_id", F.col("transaction_id") + F.lit(first_id - 1))
    return df.withColumn("is_noise", F.coalesce("is_noise", F.lit(False)))


def append_transactions(df: DataFrame, path: str, first_id: int | None = None) -> None:
    """Append rows; missing ids go on after the largest stored one, or from `first_id`."""
    if first_id is None:
        stored = None
        if "transaction_id" not in df.columns and exists(df.sparkSession, path):
            stored = df.sparkSession.read.parquet(path).agg(F.max("transaction_id")).first()[0]
        first_id = (stored or 0) + 1
    prepare_transactions(df, first_id).write.mode("append").parquet(path)


def overwrite_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_laid_out(tx: DataFrame, path: str) -> None:
    """By date folder, sorted by user within files, so that user and date filters skip data.

    Rows are dealt by ranges of date and user, which cut a crowded date into as many tasks as its
    share of the rows asks for.
    """
    (tx.repartitionByRange("transaction_date", "user_id")
     .sortWithinPartitions("transaction_date", "user_id")
     .write.mode("overwrite").partitionBy("transaction_date").parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "user_id",
                   buckets: int = 16) -> DataFrame:
    """A table bucketed and sorted by key: joins and aggregates on the key need no shuffle."""
    (df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def write_json_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
