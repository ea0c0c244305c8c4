"""Reading tables: scans, one user's history, parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalar import is_weekend
from ..operators.synth import perturb_transactions

DEVICE_NAMES = ["android", "ios", "web", "atm", "pos"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", F.col("r_name").alias("province"), F.col("n_name").alias("city")))


def _device(n) -> "F.Column":
    return F.element_at(F.array(*[F.lit(d) for d in DEVICE_NAMES]), (n % 5 + 1).cast("int"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table as users."""
    key = F.col("c_custkey")
    age = (F.lit(C.AGE_MIN) + (key * 37) % 63).cast("int")
    return (read_table(spark, folder, "customer")
            .join(_places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                key.alias("user_id"), age.alias("age"),
                (F.lit(C.REFERENCE_YEAR) - age).cast("int").alias("birth_year"),
                F.date_sub(F.lit(C.START_DATE), (F.lit(180) + (key * 131) % 1645).cast("int"))
                .alias("registration_date"),
                "province", "city", F.col("c_mktsegment").alias("preferred_card_type"),
                _device(key).alias("primary_device")))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as card transactions."""
    k = F.get_json_object("props", "$.k").cast("int")
    date = F.col("ts").cast("date")
    return (read_table(spark, folder, "events").withColumn("_k", k)
            .join(_places(spark, folder), F.col("_k") % 25 == F.col("n_nationkey"), "left")
            .select(
                F.col("event_id").alias("transaction_id"), "user_id",
                F.col("value").alias("amount"), date.alias("transaction_date"),
                F.date_format("ts", "HH:mm:ss").alias("transaction_time"),
                "province", "city", F.col("event_type").alias("card_type"),
                _device(F.col("_k")).alias("device_type"), is_weekend(date).alias("is_weekend"),
                F.hour("ts").alias("hour_of_day"), F.dayofmonth(date).alias("day_of_month")))


def labelled_transactions(spark: SparkSession, folder: str, factor: float = 2.0) -> DataFrame:
    """Transactions with labelled perturbations, rates `factor` times the defaults."""
    rates = {k: v * factor for k, v in C.NOISE_RATES.items()}
    return perturb_transactions(transactions(spark, folder), users(spark, folder), rates)


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The embedding table with double vectors: (vec_id, vec, label)."""
    return read_table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")


def user_history(tx: DataFrame, user_id: int) -> DataFrame:
    """One user's transactions in time order."""
    return (tx.where(F.col("user_id") == F.lit(user_id))
            .orderBy("transaction_date", "transaction_time", "transaction_id"))


def users_history(tx: DataFrame, ids: DataFrame) -> DataFrame:
    """The transactions of the users listed in `ids(user_id)`."""
    return tx.join(ids.select("user_id"), "user_id", "left_semi")


def run_sql(spark: SparkSession, text: str, params=None, **frames: DataFrame) -> DataFrame:
    """Run SQL text with `?` or `:name` parameters; `{name}` in the text refers to a frame."""
    return spark.sql(text, args=params, **frames)
