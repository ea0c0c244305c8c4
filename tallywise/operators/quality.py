"""Constraints as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalar import is_weekend


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and the number of child rows."""
    refs = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("cnt"))
    return refs.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def _counts_per_rule(df: DataFrame, rules: dict[str, Column], name: str) -> DataFrame:
    """One pass: count_if per rule, then one row per rule."""
    row = df.agg(*[F.count_if(cond).alias(rule) for rule, cond in rules.items()])
    items = F.array(*[F.struct(F.lit(rule).alias(name), F.col(rule).alias("violations"))
                      for rule in rules])
    return row.select(F.inline(items))


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    return _counts_per_rule(df, {c: F.col(c).isNull() for c in columns}, "column_name")


def age_birth_year_mismatch(users: DataFrame, year: int = C.REFERENCE_YEAR) -> DataFrame:
    expected = F.lit(year) - F.col("birth_year")
    return (users.where(F.col("age") != expected)
            .select("user_id", "age", "birth_year", expected.cast("int").alias("expected_age")))


def range_violations(users: DataFrame, tx: DataFrame) -> DataFrame:
    """Violations per range rule on ages, amounts and hours."""
    ages = {"age": ~F.col("age").between(C.AGE_MIN, C.AGE_MAX)}
    rows = {"amount": ~F.col("amount").between(C.AMOUNT_MIN, C.AMOUNT_MAX),
            "hour_of_day": ~F.col("hour_of_day").between(0, 23)}
    return _counts_per_rule(users, ages, "rule").unionByName(_counts_per_rule(tx, rows, "rule"))


def derived_mismatch(tx: DataFrame) -> DataFrame:
    """Rows whose derived columns contradict the date or the time text."""
    date = F.col("transaction_date")
    return _counts_per_rule(tx, {
        "hour_of_day": F.col("hour_of_day") != F.split("transaction_time", ":").getItem(0)
        .try_cast("int"),
        "is_weekend": F.col("is_weekend") != is_weekend(date),
        "day_of_month": F.col("day_of_month") != F.dayofmonth(date)}, "rule")
