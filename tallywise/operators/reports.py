"""Roll-ups and the aggregate tables behind the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import LINEAR, column_quantiles, group_quantiles
from ..functions.scalar import age_group
from ..schemas import column_kinds
from .features import database_stats
from .relational import hash_sample, with_share


def age_group_distribution(users: DataFrame) -> DataFrame:
    counts = users.groupBy(age_group(F.col("age")).alias("age_group")).agg(
        F.count("*").alias("cnt"))
    return with_share(counts).orderBy("age_group")


def province_top(users: DataFrame, n: int = 5) -> DataFrame:
    counts = users.groupBy("province").agg(F.count("*").alias("cnt"))
    return with_share(counts).orderBy(F.desc("cnt"), F.asc("province")).limit(n)


def overall_counts(users: DataFrame, tx: DataFrame) -> DataFrame:
    both = tx.agg(F.count("*").alias("total_transactions")).withColumn(
        "total_users", users.agg(F.count("*")).scalar())
    return both.withColumn("avg_transactions_per_user", F.round(
        F.coalesce(F.try_divide("total_transactions", "total_users"), F.lit(0.0)), 1))


def feature_table_stats(features: DataFrame) -> DataFrame:
    """Processed users and the number of feature columns."""
    n = len(column_kinds(features)["numerical"]) + len(column_kinds(features)["categorical"])
    return features.agg(F.count("*").alias("processed_users")).withColumn(
        "feature_columns", F.lit(n))


def histogram(df: DataFrame, column: Column, bins: int) -> DataFrame:
    """(bin, low, high, cnt) of equal-width bins from min to max; the last bin is closed."""
    values = df.select(column.cast("double").alias("x")).where(F.col("x").isNotNull())
    limits = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = F.col("_l.lo"), F.col("_l.hi")
    width = F.when(hi > lo, (hi - lo) / F.lit(float(bins))).otherwise(F.lit(1.0 / bins))
    start = F.when(hi > lo, lo).otherwise(lo - F.lit(0.5))
    index = F.least(F.floor((F.col("x") - start) / width).cast("int"), F.lit(bins - 1))
    counts = values.withColumn("_l", limits).groupBy(
        index.alias("bin"), start.alias("_s"), width.alias("_w")).agg(F.count("*").alias("cnt"))
    edge = lambda i: F.col("_s") + F.col("_w") * i
    return counts.select("bin", edge(F.col("bin")).alias("low"),
                         edge(F.col("bin") + 1).alias("high"), "cnt")


def log_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    return histogram(df, F.log10(F.col(column) + F.lit(1)), bins)


def mean_median_markers(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, median)."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean"))
                      for c in columns])
    return means.select(F.inline(items)).join(
        column_quantiles(df, columns, {"median": (0.5, LINEAR)}), "feature")


def hourly_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("hour_of_day").agg(F.count("*").alias("cnt")).orderBy("hour_of_day")


def card_share(tx: DataFrame) -> DataFrame:
    return with_share(tx.groupBy("card_type").agg(F.count("*").alias("cnt")))


def boxplot_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles per group and whiskers: the outermost values within 1.5 IQR of the box."""
    q = group_quantiles(df, [group], value, {
        "q1": (0.25, LINEAR), "median": (0.5, LINEAR), "q3": (0.75, LINEAR)})
    x = F.col(value).cast("double")
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return df.where(F.col(value).isNotNull()).join(q, group).groupBy(
        group, "q1", "median", "q3").agg(
        F.min(x).alias("minimum"), F.max(x).alias("maximum"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def counts_by_flag(df: DataFrame, flag: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count("*").alias("cnt"))


def similarity_categories(pairs: DataFrame, score: str = "similarity_score") -> DataFrame:
    s = F.col(score)
    category = F.when(s > 0.8, "high").when(s >= 0.5, "medium").otherwise("low")
    return pairs.groupBy(category.alias("category")).agg(F.count("*").alias("cnt"))


def scatter_sample(df: DataFrame, key: str, columns: list[str], n: int = 1000) -> DataFrame:
    return hash_sample(df.select(key, *columns), key, n)


def dashboard_stats(users: DataFrame, features: DataFrame, tx: DataFrame) -> DataFrame:
    f = features.agg(F.avg("total_amount").alias("avg_total_amount"),
                     F.avg("total_transactions").alias("avg_transactions"),
                     F.avg("age").alias("avg_age"))
    t = tx.agg(F.struct(F.count("*").alias("n"), F.avg(F.col("is_noise").cast("int")).alias("s")))
    return f.withColumns({"_t": t.scalar(), "total_users": users.agg(F.count("*")).scalar()}) \
        .select("total_users", "avg_total_amount", "avg_transactions", "avg_age",
                F.col("_t.n").alias("total_transactions"),
                (F.col("_t.s") * 100.0).alias("noise_percentage"))


def noise_share(tx: DataFrame) -> DataFrame:
    return tx.agg(F.avg(F.col("is_noise").cast("int")).alias("noise_share"))


def generation_report(users: DataFrame, tx: DataFrame) -> DataFrame:
    """(metric, value): table totals and one row per noise kind."""
    stats = database_stats(users, tx)
    items = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                      for c in stats.columns])
    kinds = (tx.where("is_noise").select(F.explode(F.split("noise_type", ",")).alias("kind"))
             .groupBy("kind").agg(F.count("*").alias("c")))
    return stats.select(F.inline(items)).unionByName(kinds.select(
        F.concat(F.lit("noise:"), "kind").alias("metric"), F.col("c").cast("double").alias("value")))


def analysis_summary(features: DataFrame, clusters: DataFrame, anomalies: DataFrame,
                     similarities: DataFrame) -> DataFrame:
    """Totals of the four result tables in one row."""
    s = similarities.agg(F.struct(F.count("*").alias("n"), F.avg("similarity_score").alias("m")))
    a = anomalies.agg(F.struct(F.count("*").alias("n"), F.count_if("is_anomaly").alias("f")))
    c = clusters.agg(F.count_distinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))))
    return features.agg(F.count("*").alias("processed_users")).withColumns(
        {"clusters": c.scalar(), "_a": a.scalar(), "_s": s.scalar()}).select(
        "processed_users", "clusters", F.col("_a.n").alias("scored_users"),
        F.col("_a.f").alias("anomalies"), F.col("_s.n").alias("similar_pairs"),
        F.col("_s.m").alias("avg_similarity"))
