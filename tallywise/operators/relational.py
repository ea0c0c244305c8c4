"""Projections, filters, joins, ranking, sampling and set operations of the analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def select_subset(df: DataFrame, wanted: list[str], keys: tuple = ("user_id",)) -> DataFrame:
    """Key columns plus those of the wanted columns that exist."""
    return df.select(*[c for c in [*keys, *wanted] if c in df.columns])


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def cast_text(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names if n in df.columns})


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in `ids`."""
    return df.join(ids.select(key), key, "left_semi")


def user_noise_ratio(tx: DataFrame) -> DataFrame:
    """Transactions, noise transactions and noise share per user in one pass."""
    return (tx.groupBy("user_id")
            .agg(F.count("*").alias("total_count"), F.count_if("is_noise").alias("noise_count"))
            .withColumn("noise_ratio", F.col("noise_count") / F.col("total_count")))


def label_by_key(features: DataFrame, labels: DataFrame, key: str = "user_id") -> DataFrame:
    """Attach result labels by key."""
    return features.join(labels, key, "left")


def with_share(counts: DataFrame, column: str = "cnt", out: str = "percentage",
               digits: int | None = 1) -> DataFrame:
    """Percentage of the column total; `counts` is an aggregated table."""
    total = counts.agg(F.sum(column)).scalar()
    share = F.col(column) * F.lit(100.0) / total
    return counts.withColumn(out, share if digits is None else F.round(share, digits))


def top1_per_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per group, smallest value on a tie; counts combine map-side."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_c"))
    return counts.groupBy(*keys).agg(
        F.min(F.struct(-F.col("_c"), F.col(value))).getField(value).alias(value),
        F.max("_c").alias("cnt"))


def latest_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last write per key: an aggregate, so versions of a hot key combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c != order]
    newest = F.max_by(F.struct(*rest, order), F.struct(order, *rest))
    return (df.groupBy(*keys).agg(newest.alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*rest, order]]))


def rank_within(df: DataFrame, keys: list[str], order: list, out: str = "rank") -> DataFrame:
    """1.. per group. The groups must be bounded (k hits per query, d components)."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def cumulative_variance(ratios: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Running sum over the d explained-variance ratios and the first index reaching it.

    `ratios(component, ratio)` has one row per dimension.
    """
    upto = W.orderBy("component").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = ratios.withColumn("cumulative", F.sum("ratio").over(upto))
    return run.withColumn("kept", F.coalesce(
        F.lag("cumulative").over(W.orderBy("component")) < threshold, F.lit(True)))


def hash_sample(df: DataFrame, key: str, n: int, salt: str = "sample") -> DataFrame:
    """n rows in a key-hash order: reproducible, and a top-k instead of a full sort."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{salt}")))
    return df.orderBy(order, F.col(key)).limit(n)


def top_n(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(column), F.asc(tie)).limit(n)


def best_by(df: DataFrame, name: str, score: str) -> DataFrame:
    """The name with the largest score, smallest name on a tie; NULL scores lose."""
    return (df.where(F.col(score).isNotNull())
            .agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(name).alias("n"))).alias("_b"))
            .select(F.col("_b.n").alias(name), (-F.col("_b.s")).alias(score)))


def concat_vertical(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def concat_outer(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stack frames with differing columns; `is_new_user` tells the origin."""
    return (existing.withColumn("is_new_user", F.lit(False))
            .unionByName(new.withColumn("is_new_user", F.lit(True)), allowMissingColumns=True))


def id_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_anti")
