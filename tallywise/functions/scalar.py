"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_weekend(date: Column) -> Column:
    """Friday is the only weekend day."""
    return F.dayofweek(date) == F.lit(6)


def is_night(hour: Column) -> Column:
    return (hour >= F.lit(22)) | (hour <= F.lit(6))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def clock(hour: Column, minute: Column, second: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", hour, minute, second)


def replace_hour(time: Column, hour: Column) -> Column:
    """Replace the hour of HH:MM:SS; any other text stays as it is."""
    parts = F.split(time, ":")
    return F.when(
        F.size(parts) == 3,
        F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), parts.getItem(1), parts.getItem(2)),
    ).otherwise(time)


def join_labels(*labels: Column) -> Column:
    """Comma-joined labels that are set, NULL when none is."""
    return F.nullif(F.concat_ws(",", *labels), F.lit(""))


def day_span(start: Column, end: Column) -> Column:
    """Days between two dates, both ends counted."""
    return F.datediff(end, start) + F.lit(1)


def ratio_or_one(x: Column, base: Column) -> Column:
    return F.when(base != 0, F.try_divide(x, base)).otherwise(F.lit(1.0))


def remote_province(city: Column, sistan: list[str], sistan_name: str, other: str) -> Column:
    return F.when(city.isin(sistan), F.lit(sistan_name)).otherwise(F.lit(other))


def age_group(age: Column) -> Column:
    """Report buckets; ages outside 18-65 on either side share the last one."""
    expr = None
    for low, high in [(18, 25), (26, 35), (36, 45), (46, 55), (56, 65)]:
        inside, label = age.between(low, high), F.lit(f"{low}-{high}")
        expr = F.when(inside, label) if expr is None else expr.when(inside, label)
    return expr.otherwise(F.lit("65+"))


def age_band(age: Column) -> Column:
    """Right-closed chart bins (0,30], (30,50], (50,100]; NULL outside."""
    return (F.when((age > 0) & (age <= 30), "Young")
            .when((age > 30) & (age <= 50), "Middle")
            .when((age > 50) & (age <= 100), "Senior"))
