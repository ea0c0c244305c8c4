"""Exact quantiles that survive groups of any size.

Groups by a key count their values where they lie, deal them out by ranges of group and value, and count them
up range by range, so a key with a third of the rows is many tasks. Whole columns are not
shuffled at all: a mergeable sketch brackets each wanted rank, counts per bin narrow the bracket, and only
the distinct values inside the last bin are ranked one by one. The brackets are broadcast, so
rows are counted where they lie and only counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

NEAREST, LINEAR = "nearest", "linear"
BINS = 4_096


def _ranks(n: Column, q: float, how: str) -> tuple[Column, Column, Column]:
    """1-based lower rank, upper rank and weight of the upper value."""
    h = (n - F.lit(1)) * F.lit(float(q))
    if how == NEAREST:
        r = F.floor(h + F.lit(0.5)) + F.lit(1)
        return r, r, F.lit(0.0)
    lo = F.floor(h)
    return lo + F.lit(1), F.ceil(h) + F.lit(1), h - lo


def _blend(lo: Column, hi: Column, w: Column) -> Column:
    return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * w)


def _brackets(df: DataFrame, keys: list[str], specs: dict, accuracy: int) -> DataFrame:
    """A row per group and wanted rank (i, side): the values `lo` and `hi` that enclose it, and `r`."""
    eps = 2.0 / accuracy
    probs = []
    for q, _ in specs.values():
        probs += [max(q - eps, 0.0), min(q + eps, 1.0)]
    sketch = df.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", [float(p) for p in probs], accuracy).alias("_b"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    probes = []
    for i, (q, how) in enumerate(specs.values()):
        lo_rank, hi_rank, w = _ranks(F.col("_n"), q, how)
        # Below 4*accuracy rows the margin would be under a few ranks: take the whole range.
        few = F.col("_n") < F.lit(4 * accuracy)
        lo = F.when(few | F.lit(q <= eps), F.col("_min")).otherwise(F.col("_b").getItem(2 * i))
        hi = F.when(few | F.lit(q >= 1.0 - eps), F.col("_max")).otherwise(
            F.col("_b").getItem(2 * i + 1))
        for side, r in enumerate((lo_rank, hi_rank)):
            probes.append(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), lo.alias("lo"),
                                   hi.alias("hi"), r.cast("bigint").alias("r"), w.alias("w")))
    return sketch.select(*keys, F.explode(F.array(*probes)).alias("_p")).select(*keys, "_p.*")


def _met(df: DataFrame, keys: list[str], probes: DataFrame) -> DataFrame:
    """Rows beside the probes of their group that they do not exceed.

    The probes of a group travel as one array, by broadcast: groups are columns of a schema, so there
    are few of them and the rows stay where they are.
    """
    state = probes.groupBy(*keys).agg(F.collect_list(F.struct(
        *[c for c in probes.columns if c not in keys])).alias("_p"))
    return (df.join(F.broadcast(state), keys)
            .select(*keys, "_v", F.explode(F.filter("_p", lambda p: F.col("_v") <= p["hi"])).alias("_p"))
            .select(*keys, "_v", "_p.*"))


def _narrowed(df: DataFrame, keys: list[str], probes: DataFrame) -> DataFrame:
    """The same probes with `lo` and `hi` moved to the ends of the bin that holds the rank.

    A bracket is cut into BINS equal parts; only counts per part and their ends are shuffled.
    """
    width = (F.col("hi") - F.col("lo")) / F.lit(float(BINS))
    at = F.when(F.col("_v") < F.col("lo"), -1).when(width > 0, F.least(
        F.floor((F.col("_v") - F.col("lo")) / width), F.lit(BINS - 1))).otherwise(0)
    probe = [*keys, "i", "side", "r", "w"]
    bins = (_met(df, keys, probes).groupBy(*probe, at.alias("_bin"))
            .agg(F.count("*").alias("_c"), F.min("_v").alias("lo"), F.max("_v").alias("hi")))
    upto = W.partitionBy(*probe).orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = bins.withColumn("_cum", F.sum("_c").over(upto)).where(
        (F.col("_cum") >= F.col("r")) & (F.col("_cum") - F.col("_c") < F.col("r")))
    return found.select(*probe, "lo", "hi")


def _bracketed_quantiles(df: DataFrame, keys: list[str], specs: dict, accuracy: int) -> DataFrame:
    probes = _narrowed(df, keys, _brackets(df, keys, specs, accuracy))
    probe = [*keys, "i", "side", "r", "w"]
    # Rows below a bracket become one null-valued count; nulls sort first in the ranking window.
    hits = (_met(df, keys, probes)
            .groupBy(*probe, F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("_x"))
            .agg(F.count("*").alias("_c")))
    upto = W.partitionBy(*probe).orderBy(F.col("_x").asc_nulls_first()).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    found = hits.withColumn("_cum", F.sum("_c").over(upto)).where(
        (F.col("_cum") >= F.col("r")) & (F.col("_cum") - F.col("_c") < F.col("r")))
    at = lambda i, side: F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col("_x")))
    weight = lambda i: F.max(F.when(F.col("i") == i, F.col("w")))
    return found.groupBy(*keys).agg(*[
        _blend(at(i, 0), at(i, 1), weight(i)).alias(name) for i, name in enumerate(specs)])


def weighted_quantiles(runs: DataFrame, keys: list[str], value: str, weight: str, specs: dict) -> DataFrame:
    """As `group_quantiles`, of values that occur `weight` times each.

    Values are dealt by ranges of key and value and counted up within a range, and the ranges of a key
    follow each other, so that a key of any size is as many tasks as its share of the values asks for.
    """
    base = runs.select(*keys, F.col(value).cast("double").alias("_v"), F.col(weight).alias("_w")).where(
        F.col("_v").isNotNull())
    ranged = cut_lineage(base.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_w").alias("_c"))
    whole = W.partitionBy(*keys)
    upto = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = parts.select(*keys, "_part", (F.sum("_c").over(upto) - F.col("_c")).alias("_before"),
                          F.sum("_c").over(whole).alias("_n"))
    inside = W.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto_here = ranged.withColumn("_upto", F.sum("_w").over(inside)).alias("r")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_part"]]
    counted = upto_here.join(before.alias("b"), same).select(
        *[F.col(f"r.{k}").alias(k) for k in keys], "_v", "_w", "_n", (F.col("_upto") + F.col("_before")).alias("_upto"))
    at = lambda r: F.max(F.when((F.col("_upto") >= r) & (F.col("_upto") - F.col("_w") < r), F.col("_v")))
    ends = [_ranks(F.col("_n"), q, how) for q, how in specs.values()]
    found = counted.groupBy(*keys).agg(F.max("_n").alias("_n"), *[
        at(r).alias(f"_{side}{i}") for i, (lo, hi, _) in enumerate(ends) for side, r in (("lo", lo), ("hi", hi))])
    return found.select(*keys, *[_blend(F.col(f"_lo{i}"), F.col(f"_hi{i}"), w).alias(name)
                                 for i, (name, (_, _, w)) in enumerate(zip(specs, ends))])


def group_quantiles(df: DataFrame, keys: list[str], value: str, specs: dict) -> DataFrame:
    """One row per group with the columns named in `specs`: name -> (q, 'nearest'|'linear').

    'nearest' takes sorted row round((n-1)q)+1, 'linear' interpolates. Nulls do not count;
    a group with only nulls yields no row. Equal values are added up before they are shuffled, and one plan
    serves groups of any size; the rows are read once.
    """
    runs = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).groupBy(
        *keys, "_v").agg(F.count("*").alias("_w"))
    return weighted_quantiles(cut_lineage(runs), keys, "_v", "_w", specs)


def column_quantiles(df: DataFrame, columns: list[str], specs: dict,
                     accuracy: int = 10_000) -> DataFrame:
    """Exact whole-table quantiles, one row per column: (feature, <names of specs>).

    Every column is a group as large as the table, so all go through the brackets.
    """
    return _bracketed_quantiles(unpivot(df, columns), ["feature"], specs, accuracy)


def unpivot(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Long form (keep..., feature, _v) of numeric columns without nulls."""
    items = ", ".join(f"struct('{c}' as feature, cast(`{c}` as double) as _v)" for c in columns)
    return (df.select(*(keep or []), F.expr(f"inline(array({items}))"))
            .where(F.col("_v").isNotNull()))
