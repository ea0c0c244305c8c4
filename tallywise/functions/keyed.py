"""Reproducible draws: every value is a function of the row key and a salt.

No partition count, retry or lost executor can change a value, unlike `rand()`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(key: Column | str, salt: str) -> Column:
    """Uniform in [0, 1): the first 32 bits of md5('<key>:<salt>')."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def cumulative(weights: list[float]) -> list[float]:
    """Upper bounds of all but the last category, weights normalised."""
    total, bounds, acc = sum(weights), [], 0.0
    for w in weights[:-1]:
        acc += w
        bounds.append(acc / total)
    return bounds


def pick(u: Column, values: list, weights: list[float] | None = None) -> Column:
    """Weighted category for a uniform; equal weights when none are given."""
    bounds = cumulative(weights or [1.0] * len(values))
    expr = None
    for bound, value in zip(bounds, values):
        expr = (F if expr is None else expr).when(u < F.lit(bound), F.lit(value))
    return F.lit(values[-1]) if expr is None else expr.otherwise(F.lit(values[-1]))


def beta_order_statistic(uniforms: list[Column], a: int) -> Column:
    """Beta(a, b) for integer a, b: the a-th smallest of a+b-1 uniforms."""
    return F.sort_array(F.array(*uniforms)).getItem(a - 1)


def normal(u1: Column, u2: Column) -> Column:
    """Standard normal from two uniforms (Box-Muller)."""
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def poisson_bounds(rate: float) -> list[float]:
    """Cumulative Poisson probabilities up to the resolution of a 32-bit uniform."""
    bounds, term, acc, k = [], math.exp(-rate), 0.0, 0
    while 1.0 - acc > 2.0 ** -33:
        acc += term
        bounds.append(acc)
        k += 1
        term *= rate / k
    return bounds


def poisson(u: Column, rate: float) -> Column:
    """Poisson count by inversion of the distribution function."""
    bounds = poisson_bounds(rate)
    expr = F.when(u < F.lit(bounds[0]), F.lit(0))
    for k, bound in enumerate(bounds[1:], start=1):
        expr = expr.when(u < F.lit(bound), F.lit(k))
    return expr.otherwise(F.lit(len(bounds)))


def scaled_int(u: Column, low: int, high: int) -> Column:
    """Integer uniform in [low, high], both ends included."""
    return (F.lit(low) + F.floor(u * F.lit(float(high - low + 1)))).cast("int")


def hashed_normal(key: Column, salt: str) -> Column:
    return normal(uniform(key, f"{salt}a"), uniform(key, f"{salt}b"))
