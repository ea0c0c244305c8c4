"""One aggregated feature row per user.

Two aggregates and one quantile pass over the transactions, all keyed by user:
- numeric measures in one map-side combined aggregate;
- categories and days as (user, kind, value) counts, so that distinct counts, modes and daily
  regularity share one scan and no user's rows have to meet in one task;
- exact quantiles through `group_quantiles`, which deals out hot users by ranges of value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FALLBACK_CITY
from ..functions.quantiles import LINEAR, NEAREST, group_quantiles, weighted_quantiles
from ..schemas import FEATURE_COLUMNS
from ..session import cut_lineage

USER = "user_id"
AMOUNT = "amount"

VOLUME = ["total_transactions", "total_amount", "avg_transaction_amount",
          "std_transaction_amount", "min_transaction_amount", "max_transaction_amount",
          "median_transaction_amount"]
TEMPORAL = ["avg_hour_of_day", "std_hour_of_day", "weekend_transaction_ratio",
            "night_transaction_ratio", "transaction_frequency"]
GEO = ["unique_cities_count", "unique_provinces_count", "most_frequent_city",
       "most_frequent_province", "geographical_diversity"]
AMOUNT_DISTRIBUTION = ["amount_percentile_25", "amount_percentile_75", "amount_iqr",
                       "amount_skewness"]
BEHAVIORAL = ["card_type_diversity", "device_type_diversity", "regularity_score"]

# Values of a user without transactions; everything not named is zero.
DEFAULTS = {"avg_hour_of_day": 12.0, "most_frequent_city": FALLBACK_CITY,
            "most_frequent_province": FALLBACK_CITY}

_QUANTILES = {"median_transaction_amount": (0.5, LINEAR),
              "amount_percentile_25": (0.25, NEAREST), "amount_percentile_75": (0.75, NEAREST)}


_VOLUME_AGGS = {
    "total_transactions": "count(*)",
    "total_amount": "sum(amount)",
    "avg_transaction_amount": "avg(amount)",
    "std_transaction_amount": "coalesce(stddev_samp(amount), 0.0D)",
    "min_transaction_amount": "min(amount)",
    "max_transaction_amount": "max(amount)",
}
_HOUR_AGGS = {
    "avg_hour_of_day": "avg(hour_of_day)",
    "std_hour_of_day": "coalesce(stddev_samp(hour_of_day), 0.0D)",
    "weekend_transaction_ratio": "avg(cast(is_weekend as int))",
    "night_transaction_ratio": "avg(cast(hour_of_day >= 22 or hour_of_day <= 6 as int))",
}
# Population skewness; a constant or single value has none and counts as zero.
_SKEWNESS = {
    "amount_skewness": "if(min(amount) = max(amount), 0.0D, "
                       "coalesce(nanvl(skewness(amount), 0.0D), 0.0D))",
}


def _distinct(kind: str) -> str:
    return f"count_if(kind = '{kind}' and value is not null)"


def _rows(kind: str) -> str:
    return f"sum(if(kind = '{kind}', cnt, 0))"


def _mode(kind: str) -> str:
    """Most frequent value, the smallest name on a tie."""
    return f"min(if(kind = '{kind}' and value is not null, struct(-cnt, value), null)).value"


_FREQUENCY = {"transaction_frequency":
              f"{_rows('transaction_date')} / greatest({_distinct('transaction_date')}, 1)"}
_GEO_AGGS = {
    "unique_cities_count": _distinct("city"),
    "unique_provinces_count": _distinct("province"),
    "most_frequent_city": _mode("city"),
    "most_frequent_province": _mode("province"),
    "geographical_diversity": f"{_distinct('city')} / {_rows('city')}",
}
_BEHAVIORAL_AGGS = {
    "card_type_diversity": f"{_distinct('card_type')} / {_rows('card_type')}",
    "device_type_diversity": f"{_distinct('device_type')} / {_rows('device_type')}",
    "regularity_score": "1.0D / (coalesce(stddev_samp("
                        "if(kind = 'transaction_date', cnt, null)), 0.0D) + 1.0D)",
}


def _by_user(df: DataFrame, *aggs: dict[str, str]) -> DataFrame:
    return df.groupBy(USER).agg(*[F.expr(f"{text} as {name}")
                                  for group in aggs for name, text in group.items()])


def value_counts_by_user(tx: DataFrame, kinds: list[str]) -> DataFrame:
    """(user_id, kind, value, cnt) for several columns in one scan."""
    items = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value"))
                      for c in kinds])
    return (tx.select(USER, F.explode(items).alias("_e"))
            .groupBy(USER, F.col("_e.kind").alias("kind"), F.col("_e.value").alias("value"))
            .agg(F.count("*").alias("cnt")))


def volume_features(tx: DataFrame) -> DataFrame:
    """Count, sum, mean, sample std, min, max and median of the amounts."""
    spec = {"median_transaction_amount": (0.5, LINEAR)}
    return (_by_user(tx, _VOLUME_AGGS)
            .join(group_quantiles(tx, [USER], AMOUNT, spec), USER, "left")
            .select(USER, *VOLUME))


def temporal_features(tx: DataFrame) -> DataFrame:
    """Hour statistics, Friday and night shares, transactions per active day."""
    days = _by_user(value_counts_by_user(tx, ["transaction_date"]), _FREQUENCY)
    return _by_user(tx, _HOUR_AGGS).join(days, USER).select(USER, *TEMPORAL)


def geo_features(tx: DataFrame) -> DataFrame:
    """Distinct places, most frequent places, distinct cities per transaction."""
    return _by_user(value_counts_by_user(tx, ["city", "province"]), _GEO_AGGS).select(USER, *GEO)


def amount_distribution_features(tx: DataFrame) -> DataFrame:
    """Nearest-rank quartiles, their range, population skewness."""
    spec = {k: v for k, v in _QUANTILES.items() if k != "median_transaction_amount"}
    q = group_quantiles(tx, [USER], AMOUNT, spec)
    return (_by_user(tx, _SKEWNESS).join(q, USER, "left")
            .withColumn("amount_iqr", F.col("amount_percentile_75") - F.col("amount_percentile_25"))
            .select(USER, *AMOUNT_DISTRIBUTION))


def behavioral_features(tx: DataFrame) -> DataFrame:
    """Card and device variety per transaction, evenness of the daily counts."""
    counts = value_counts_by_user(tx, ["card_type", "device_type", "transaction_date"])
    return _by_user(counts, _BEHAVIORAL_AGGS).select(USER, *BEHAVIORAL)


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill the feature columns of users without transactions."""
    zero = {"bigint": 0, "double": 0.0, "string": ""}
    return df.na.fill({name: DEFAULTS.get(name, zero[kind.simpleString()])
                       for name, kind in FEATURE_COLUMNS
                       if name in df.columns and name not in ("age", "birth_year")})


def user_features(users: DataFrame, tx: DataFrame) -> DataFrame:
    """user_id plus 26 features for every user, defaults where there are no transactions."""
    measures = _by_user(tx, _VOLUME_AGGS, _HOUR_AGGS, _SKEWNESS)
    kinds = ["transaction_date", "city", "province", "card_type", "device_type"]
    counts = _by_user(value_counts_by_user(tx, kinds), _FREQUENCY, _GEO_AGGS, _BEHAVIORAL_AGGS)
    quantiles = group_quantiles(tx, [USER], AMOUNT, _QUANTILES)
    joined = (users.select(USER, "age", "birth_year")
              .join(measures, USER, "left").join(counts, USER, "left")
              .join(quantiles, USER, "left")
              .withColumn("amount_iqr",
                          F.col("amount_percentile_75") - F.col("amount_percentile_25")))
    return with_defaults(joined).select(USER, *[name for name, _ in FEATURE_COLUMNS])


#: Columns whose values a feature row rests on.
RUN_KINDS = ["transaction_date", "city", "province", "card_type", "device_type", AMOUNT, "hour_of_day", "is_weekend"]


def merged_runs(*runs: DataFrame) -> DataFrame:
    """(user_id, kind, value, cnt) of several such tables: counts of the same value add up."""
    every = runs[0]
    for more in runs[1:]:
        every = every.unionByName(more)
    return every.groupBy(USER, "kind", "value").agg(F.sum("cnt").alias("cnt"))


def features_of_runs(users: DataFrame, runs: DataFrame) -> DataFrame:
    """`user_features` from the counts of RUN_KINDS (`value_counts_by_user`) instead of transactions.

    Counts of two sets of transactions merge by addition, so features can be kept up without the
    transactions behind them.
    """
    number = F.when(F.col("value") == "true", 1.0).when(F.col("value") == "false", 0.0).otherwise(
        F.expr("try_cast(value as double)"))
    runs = cut_lineage(runs)
    counted = runs.where(F.col("kind").isin(AMOUNT, "hour_of_day", "is_weekend")).withColumn("v", number)
    n, s = (lambda k: F.sum(F.when((F.col("kind") == k) & F.col("v").isNotNull(), F.col("cnt")))), (
        lambda k: F.sum(F.when(F.col("kind") == k, F.col("v") * F.col("cnt"))))
    own = lambda f, k: f(F.when(F.col("kind") == k, F.col("v")))
    night = (F.col("kind") == "hour_of_day") & ((F.col("v") >= 22) | (F.col("v") <= 6))
    first = counted.groupBy(USER).agg(
        F.sum(F.when(F.col("kind") == AMOUNT, F.col("cnt"))).alias("total_transactions"),
        s(AMOUNT).alias("total_amount"), n(AMOUNT).alias("_n"), n("hour_of_day").alias("_hours"),
        own(F.min, AMOUNT).alias("min_transaction_amount"), own(F.max, AMOUNT).alias("max_transaction_amount"),
        (s(AMOUNT) / n(AMOUNT)).alias("avg_transaction_amount"),
        (s("hour_of_day") / n("hour_of_day")).alias("avg_hour_of_day"),
        (s("is_weekend") / n("is_weekend")).alias("weekend_transaction_ratio"),
        (F.coalesce(F.sum(F.when(night, F.col("cnt"))), F.lit(0)) / n("hour_of_day")).alias("night_transaction_ratio"))
    off = F.col("v") - F.when(F.col("kind") == AMOUNT, F.col("avg_transaction_amount")).otherwise(F.col("avg_hour_of_day"))
    power = lambda k, p: F.sum(F.when(F.col("kind") == k, F.col("cnt") * F.pow(off, F.lit(p))))
    moments = counted.join(first, USER).groupBy(USER).agg(
        power(AMOUNT, 2).alias("_m2"), power(AMOUNT, 3).alias("_m3"), power("hour_of_day", 2).alias("_h2"))
    deviation = lambda m, k: F.coalesce(F.sqrt(F.try_divide(F.col(m), F.col(k) - 1)), F.lit(0.0))
    constant = F.col("min_transaction_amount") == F.col("max_transaction_amount")
    skew = F.try_divide(F.col("_m3") / F.col("_n"), F.pow(F.col("_m2") / F.col("_n"), F.lit(1.5)))
    measures = first.join(moments, USER).select(
        *[c for c in first.columns if c not in ("_n", "_hours")], deviation("_m2", "_n").alias("std_transaction_amount"),
        deviation("_h2", "_hours").alias("std_hour_of_day"),
        F.when(constant, 0.0).otherwise(F.coalesce(skew, F.lit(0.0))).alias("amount_skewness"))
    counts = _by_user(runs, _FREQUENCY, _GEO_AGGS, _BEHAVIORAL_AGGS)
    quantiles = weighted_quantiles(runs.where(F.col("kind") == AMOUNT), [USER], "value", "cnt", _QUANTILES)
    joined = (users.select(USER, "age", "birth_year").join(measures, USER, "left").join(counts, USER, "left")
              .join(quantiles, USER, "left").withColumn(
                  "amount_iqr", F.col("amount_percentile_75") - F.col("amount_percentile_25")))
    return with_defaults(joined).select(USER, *[name for name, _ in FEATURE_COLUMNS])


def missing_features(users: DataFrame, features: DataFrame) -> DataFrame:
    """Ids of users without a feature row."""
    return users.select(USER).join(features.select(USER), USER, "left_anti")


def database_stats(users: DataFrame, tx: DataFrame) -> DataFrame:
    """Users, transactions, total amount, transactions per user, noise count and percentage."""
    t = tx.agg(F.count("*").alias("total_transactions"),
               F.coalesce(F.sum(AMOUNT), F.lit(0.0)).alias("total_amount"),
               F.coalesce(F.count_if("is_noise"), F.lit(0)).alias("noise_transactions"))
    u = users.agg(F.count("*").alias("total_users"))
    both = t.withColumn("total_users", u.scalar())
    zero = F.lit(0.0)
    return both.select(
        "total_users", "total_transactions", "total_amount",
        F.coalesce(F.try_divide("total_transactions", "total_users"), zero)
        .alias("avg_transactions_per_user"),
        "noise_transactions",
        F.coalesce(F.try_divide(F.col("noise_transactions") * 100, F.col("total_transactions")),
                   zero).alias("noise_percentage"))


def noise_statistics(tx: DataFrame) -> DataFrame:
    """Rows per single noise kind and their share of all noise rows (shares may exceed 100)."""
    noisy = tx.where("is_noise")
    total = noisy.agg(F.count("*")).scalar()
    return (noisy.select(F.explode(F.split("noise_type", ",")).alias("noise_kind"))
            .groupBy("noise_kind").agg(F.count("*").alias("cnt"))
            .withColumn("percentage", F.col("cnt") * 100.0 / total))


def noise_type_breakdown(tx: DataFrame) -> DataFrame:
    """Rows per combined noise_type and percentage of all transactions."""
    total = tx.agg(F.count("*")).scalar()
    return (tx.where("is_noise").groupBy("noise_type").agg(F.count("*").alias("cnt"))
            .withColumn("percentage", F.col("cnt") * 100.0 / total))


def distinct_counts(df: DataFrame, keys: list[str], column: str,
                    approximate: bool = False) -> DataFrame:
    fn = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*keys).agg(fn(column).alias("n_distinct"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table, most frequent first."""
    return (df.groupBy(column).agg(F.count("*").alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc(column)))
