"""Expressions over array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda s, x: s + x)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def cosine_similarity(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column) -> Column:
    """Vector divided by its length; a zero vector stays zero."""
    length = norm(a)
    return F.transform(a, lambda x: F.coalesce(F.try_divide(x, length), F.lit(0.0)))
