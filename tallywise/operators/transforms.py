"""Feature transforms: `fit_*` returns a small statistics table, the others apply it.

Statistics tables hold one row per column (or per category), never per data row, so a fitted
transform can be stored as parquet and applied to other data later.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.quantiles import LINEAR, column_quantiles, unpivot
from ..functions.ranking import row_positions
from ..schemas import column_kinds
from ..session import cut_lineage

FENCES = {"q1": (0.25, LINEAR), "q2": (0.5, LINEAR), "q3": (0.75, LINEAR)}


def _as_map(stats: DataFrame, key: str, value: Column) -> Column:
    """A statistics table with one row per column as one map, evaluated once per query."""
    return stats.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), value)))).scalar()


def _apply(df: DataFrame, stats: DataFrame, columns: list[str], value: Column, expr) -> DataFrame:
    fitted = df.withColumn("_s", _as_map(stats, "feature", value))
    return fitted.withColumns({c: expr(c, F.col("_s").getItem(c)) for c in columns}).drop("_s")


# -- missing values ---------------------------------------------------------------------------

def fit_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, median)."""
    return column_quantiles(df, columns, {"median": (0.5, LINEAR)})


def impute_median(df: DataFrame, medians: DataFrame, columns: list[str]) -> DataFrame:
    return _apply(df, medians, columns, F.col("median"),
                  lambda c, m: F.coalesce(F.col(c).cast("double"), m))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, cnt), NULL values included."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(items).alias("_e")).groupBy("_e.feature", "_e.value")
            .agg(F.count("*").alias("cnt")))


def fit_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mode): most frequent value, smallest on a tie, 'unknown' for an empty column."""
    ranked = F.when(F.col("value").isNotNull(), F.struct(-F.col("cnt"), F.col("value")))
    return category_counts(df, columns).groupBy("feature").agg(
        F.coalesce(F.min(ranked).getField("value"), F.lit("unknown")).alias("mode"))


def impute_mode(df: DataFrame, modes: DataFrame, columns: list[str]) -> DataFrame:
    return _apply(df, modes, columns, F.col("mode"), lambda c, m: F.coalesce(F.col(c), m))


# -- categories -------------------------------------------------------------------------------

def fit_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, code): codes in text order over the distinct values.

    The code is the number of smaller distinct values of the column, counted over range
    partitions, so a dictionary of any length is never ranked in one task.
    """
    values = category_counts(df, columns).where(F.col("value").isNotNull()).select(
        "feature", "value")
    placed = row_positions(values, ["feature", "value"], "place")
    first = placed.groupBy("feature").agg(F.min("place").alias("first"))
    return placed.join(first, "feature").select(
        "feature", "value", (F.col("place") - F.col("first")).cast("int").alias("code"))


def label_encode(df: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """Replace text by code; a value unseen at fit time gets 0 on that row only.

    An equi-join per column: the dictionary may be large, AQE broadcasts it when it is small.
    """
    order = df.columns
    for c in columns:
        codes = labels.where(F.col("feature") == c).select(
            F.col("value").alias(c), F.col("code").alias("_code"))
        df = (df.join(codes, c, "left")
              .withColumn(c, F.coalesce(F.col("_code"), F.lit(0))).drop("_code"))
    return df.select(*order)


# -- scaling ----------------------------------------------------------------------------------

def column_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, n, mean, std_pop, std_samp, min, max) in one map-side combined pass."""
    stats = {"n": "count", "mean": "avg", "std_pop": "stddev_pop", "std_samp": "stddev_samp",
             "min": "min", "max": "max"}
    rows = ", ".join(f"struct('{c}' as feature, " + ", ".join(
        f"{fn}(cast(`{c}` as double)) as {name}" for name, fn in stats.items()) + ")"
        for c in columns)
    return df.agg(F.expr(f"array({rows})").alias("_r")).select(F.inline("_r"))


def fit_scaler(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    """(feature, center, width); a zero width becomes 1."""
    if method == "robust":
        q = column_quantiles(df, columns, FENCES)
        center, width = F.col("q2"), F.col("q3") - F.col("q1")
    else:
        q = column_moments(df, columns)
        center, width = ((F.col("min"), F.col("max") - F.col("min")) if method == "minmax"
                         else (F.col("mean"), F.col("std_pop")))
    return q.select("feature", center.alias("center"),
                    F.when(width == 0, F.lit(1.0)).otherwise(width).alias("width"))


def scale(df: DataFrame, scaler: DataFrame, columns: list[str]) -> DataFrame:
    return _apply(df, scaler, columns, F.struct("center", "width"),
                  lambda c, s: (F.col(c).cast("double") - s["center"]) / s["width"])


# -- outliers ---------------------------------------------------------------------------------

def fit_fences(df: DataFrame, columns: list[str], method: str = "iqr",
               threshold: float = 1.5) -> DataFrame:
    """(feature, low, high): inside values are kept."""
    if method == "iqr":
        q = column_quantiles(df, columns, FENCES)
        reach = (F.col("q3") - F.col("q1")) * F.lit(float(threshold))
        return q.select("feature", (F.col("q1") - reach).alias("low"),
                        (F.col("q3") + reach).alias("high"))
    q = column_moments(df, columns)
    reach = F.when(F.col("std_samp") > 0, F.col("std_samp") * F.lit(float(threshold)))
    return q.select("feature", (F.col("mean") - reach).alias("low"),
                    (F.col("mean") + reach).alias("high"))


def outlier_flag(df: DataFrame, fences: DataFrame, columns: list[str]) -> DataFrame:
    """`is_outlier`: any column outside its fences; NULL values and fences never are."""
    fenced = df.withColumn("_s", _as_map(fences, "feature", F.struct("low", "high")))
    outside = [F.coalesce((F.col(c) < F.col("_s").getItem(c)["low"])
                          | (F.col(c) > F.col("_s").getItem(c)["high"]), F.lit(False))
               for c in columns]
    return fenced.withColumn("is_outlier", reduce(lambda a, b: a | b, outside)).drop("_s")


def remove_outliers(df: DataFrame, columns: list[str] | None = None, method: str = "iqr",
                    threshold: float = 1.5) -> DataFrame:
    columns = columns or column_kinds(df)["numerical"]
    fences = fit_fences(df, columns, method, threshold)
    return outlier_flag(df, fences, columns).where(~F.col("is_outlier")).drop("is_outlier")


# -- selection --------------------------------------------------------------------------------

def anova_scores(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(feature, f_score): one-way ANOVA F against a class column.

    Values are centred by the column mean first, so sums of squares do not cancel.
    """
    center = column_moments(df, columns).select("feature", F.col("mean").alias("_m"))
    centred = _apply(df, center, columns, F.col("_m"),
                     lambda c, m: F.col(c).cast("double") - m)
    per_class = (unpivot(centred.where(F.col(target).isNotNull()), columns, [target])
                 .groupBy("feature", target)
                 .agg(F.count("*").alias("n"), F.sum("_v").alias("s"),
                      F.sum(F.col("_v") * F.col("_v")).alias("ss")))
    total = per_class.groupBy("feature").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"),
        F.sum("ss").alias("ss"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"))
    ssb = F.col("between") - F.col("s") * F.col("s") / F.col("n")
    ssw = F.col("ss") - F.col("between")
    return total.select("feature", F.try_divide(
        F.try_divide(ssb, F.col("k") - 1), F.try_divide(ssw, F.col("n") - F.col("k")))
        .alias("f_score"))


def mutual_information(df: DataFrame, target: str, columns: list[str],
                       bins: int = 10) -> DataFrame:
    """(feature, mi): mutual information of equal-frequency bins with a class column."""
    cuts = {f"c{i}": (i / bins, LINEAR) for i in range(1, bins)}
    edges = column_quantiles(df, columns, cuts).select(
        "feature", F.array(*cuts).alias("edges"))
    long = unpivot(df.where(F.col(target).isNotNull()), columns, [target])
    edge_map = _as_map(edges, "feature", F.col("edges"))
    binned = long.withColumn("_e", edge_map).select(
        "feature", F.col(target).alias("y"),
        F.size(F.filter(F.col("_e")[F.col("feature")], lambda e: e < F.col("_v")))
        .alias("b"))
    cells = binned.groupBy("feature", "b", "y").agg(F.count("*").alias("n"))
    w = lambda *k: F.sum("n").over(W.partitionBy("feature", *k))
    p = F.col("n") / w()
    term = p * F.ln(F.col("n") * w() / (w("b") * w("y")))
    return (cells.select("feature", term.alias("t")).groupBy("feature")
            .agg(F.sum("t").alias("mi")))


def digamma(n: Column) -> Column:
    """Digamma of whole numbers from 1, to about 1e-12: the recurrence up, then the asymptotic series."""
    up = n + F.lit(8.0)
    series = F.ln(up) - 1 / (2 * up) - 1 / (12 * up ** 2) + 1 / (120 * up ** 4) - 1 / (252 * up ** 6)
    return series - sum((1 / (n + F.lit(float(i))) for i in range(8)), F.lit(0.0))


def _nearest_bounds(k: int):
    """Of a block of one class in rising order, the open interval around each own row that holds less than its k-th neighbour."""
    def bounds(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        v, pos = rows["v"].to_numpy(), rows["pos"].to_numpy()
        n = int(rows["n"].iloc[0])
        near = min(k, n - 1)
        lo, hi, best = np.full(len(v), np.nan), np.full(len(v), np.nan), np.full(len(v), np.inf)
        for below in range(near + 1):  # so many of the nearest lie below the row
            first, last = np.arange(len(v)) - below, np.arange(len(v)) + near - below
            inside = (first >= 0) & (last < len(v))
            a, b = v[np.where(inside, first, 0)], v[np.where(inside, last, 0)]
            reach = np.where(inside, np.maximum(v - a, b - v), np.inf)
            closer = reach < best
            best = np.where(closer, reach, best)
            left = v - a >= b - v  # the farthest of them bounds its side exactly
            lo = np.where(closer, np.where(left, a, v - reach), lo)
            hi = np.where(closer, np.where(left, v + reach, b), hi)
        own = rows["home"].to_numpy()
        return pd.DataFrame({"feature": rows["feature"], "y": rows["y"], "pos": pos, "n": n, "near": near,
                             "lo": lo, "hi": hi, "same": best == 0})[own]
    return bounds


def neighbour_information(df: DataFrame, target: str, columns: list[str], k: int = 3,
                          block_rows: int = 10_000) -> DataFrame:
    """(feature, mi): mutual information with a class column, estimated from the k nearest neighbours within a class.

    psi(N) + mean of psi(k) - psi(rows of the class) - psi(rows of any class nearer than the k-th of
    the own), at least 0; rows whose class has no other are left out, and a class of at most k rows has
    fewer neighbours. Rows are dealt by ranges of value: a class is cut into blocks of its sorted rows with
    k more on either side, and nearer rows are counted as differences of ranks.
    """
    long = unpivot(df.where(F.col(target).isNotNull()), columns, [target]).select(
        "feature", F.col(target).cast("string").alias("y"), F.col("_v").alias("v"))
    classed = cut_lineage(_counted_up(long.withColumn("_one", F.lit(1).cast("long")), ["feature", "y"], ["v"]))
    own = classed.where(F.col("_n") > 1)
    at = F.floor((F.col("_upto") - 1) / block_rows)
    edge = (F.col("_upto") - 1) % block_rows
    homes = F.array_compact(F.array(at, F.when((edge < k) & (at > 0), at - 1), F.when(
        (edge >= block_rows - k) & ((at + 1) * block_rows < F.col("_n")), at + 1)))
    dealt = own.select("feature", "y", "v", F.col("_upto").alias("pos"), F.col("_n").alias("n"), at.alias("own"),
                       F.explode(homes).alias("block")).withColumn("home", F.col("own") == F.col("block"))
    bounds = cut_lineage(dealt.groupBy("feature", "y", "block").applyInPandas(
        _nearest_bounds(k), "feature string, y string, pos long, n long, near long, lo double, hi double, same boolean"))
    # Ends stand before or after equal values: an open interval leaves its ends out, an empty one holds its middle.
    ends = F.explode(F.array(
        F.struct(F.col("lo").alias("v"), F.when(F.col("same"), 0).otherwise(2).alias("ord"), F.lit(-1).alias("sign")),
        F.struct(F.col("hi").alias("v"), F.when(F.col("same"), 2).otherwise(0).alias("ord"), F.lit(1).alias("sign"))))
    probes = bounds.select("feature", "y", "pos", ends.alias("e")).select(
        "feature", "y", "pos", "e.v", "e.ord", "e.sign", F.lit(0).cast("long").alias("_one"))
    values = own.select("feature", "y", F.col("_upto").alias("pos"), "v", F.lit(1).alias("ord"), F.lit(0).alias("sign"),
                        F.lit(1).cast("long").alias("_one"))
    ranks = _counted_up(values.union(probes), ["feature"], ["v", "ord"])
    nearer = ranks.where("sign <> 0").groupBy("feature", "y", "pos").agg(
        F.sum(F.col("sign") * F.col("_upto")).alias("m"))
    terms = bounds.join(nearer, ["feature", "y", "pos"]).groupBy("feature").agg(
        F.count("*").alias("rows"),
        F.avg(digamma(F.col("near")) - digamma(F.col("n")) - digamma(F.col("m"))).alias("t"))
    return terms.select("feature", F.greatest(F.lit(0.0), digamma(F.col("rows")) + F.col("t")).alias("mi"))


def _counted_up(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds `_upto`, the sum of `_one` up to a row in its key's order, and `_n`, that of the whole key.

    Rows are dealt by ranges of key and order; sums of the ranges before are added to those within one.
    """
    ranged = cut_lineage(rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    whole = W.partitionBy(*keys)
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_one").alias("_c"))
    before = parts.select(*keys, "_part", F.sum("_c").over(whole).alias("_n"), (F.sum("_c").over(
        whole.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_c")).alias("_before"))
    inside = W.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (ranged.withColumn("_upto", F.sum("_one").over(inside)).join(before, [*keys, "_part"])
            .withColumn("_upto", F.col("_upto") + F.col("_before")).drop("_before", "_part", "_one"))


def select_k_best(df: DataFrame, scores: DataFrame, score: str, target: str, k: int = 20,
                  keys: tuple = ("user_id",)) -> DataFrame:
    """Keys, the k best columns (in table order) and the target. d scores reach the driver."""
    best = scores.orderBy(F.desc_nulls_last(score), "feature").limit(k).select("feature")
    chosen = {r[0] for r in best.collect()}
    return df.select(*keys, *[c for c in df.columns if c in chosen], target)


# -- projection -------------------------------------------------------------------------------

def centred_vectors(df: DataFrame, columns: list[str], out: str = "_vec") -> DataFrame:
    center = column_moments(df, columns).select("feature", F.col("mean").alias("_m"))
    return df.withColumn("_s", _as_map(center, "feature", F.col("_m"))).withColumn(
        out, array_to_vector(F.array(*[
            F.coalesce(F.col(c).cast("double") - F.col("_s").getItem(c), F.lit(0.0))
            for c in columns]))).drop("_s")


def fit_pca(df: DataFrame, columns: list[str], n_components: int | None = None,
            variance_threshold: float = 0.95):
    """A PCA model, the centred vectors and the number of components to keep.

    One fit yields all components; explained variance tells how many of them are wanted.
    """
    centred = centred_vectors(df, columns)
    model = PCA(k=n_components or len(columns), inputCol="_vec", outputCol="_pc").fit(centred)
    kept, total = 0, 0.0
    for ratio in model.explainedVariance:
        kept, total = kept + 1, total + ratio
        if n_components is None and total >= variance_threshold:
            break
    return model, centred, kept


def pca_reduce(df: DataFrame, columns: list[str], n_components: int | None = None,
               variance_threshold: float = 0.95, keys: tuple = ("user_id",)) -> DataFrame:
    """Keys and PC1..PCk."""
    model, centred, kept = fit_pca(df, columns, n_components, variance_threshold)
    scores = model.transform(centred).withColumn("_a", vector_to_array("_pc"))
    return scores.select(*keys, *[F.col("_a").getItem(i).alias(f"PC{i + 1}")
                                  for i in range(kept)])


# -- derived features -------------------------------------------------------------------------

def interaction_features(df: DataFrame) -> DataFrame:
    """Products and ratios of the key features that are present."""
    have = set(df.columns)
    keys = {"total_amount", "avg_transaction_amount", "total_transactions",
            "transaction_frequency", "age", "geographical_diversity"}
    if len(keys & have) < 2:
        return df
    product = lambda a, b: F.col(a) * F.col(b)
    wanted = {
        "amount_per_age": (["total_amount", "age"], product("total_amount", "age")),
        "amount_frequency_ratio": (["avg_transaction_amount", "transaction_frequency"],
                                   product("avg_transaction_amount", "transaction_frequency")),
        "transaction_geo_ratio": (["total_transactions", "geographical_diversity"],
                                  product("total_transactions", "geographical_diversity")),
        "amount_per_transaction": (["total_amount", "total_transactions"],
                                   F.col("total_amount") / (F.col("total_transactions") + 1)),
        "weekday_transaction_ratio": (["weekend_transaction_ratio"],
                                      F.lit(1.0) - F.col("weekend_transaction_ratio")),
    }
    new = {name: expr for name, (needs, expr) in wanted.items() if have.issuperset(needs)}
    return df.withColumns(new) if new else df


DEFAULT_STEPS = ("missing_values", "categorical_encoding", "interaction_features", "scaling")


def _kept(stats: DataFrame) -> DataFrame:
    """Statistics of a few columns as a local table, a row each."""
    return stats.sparkSession.createDataFrame(stats.collect(), stats.schema)


class FeatureSteps:
    """Impute, encode, interact, scale and optionally drop outliers, in this order.

    `fit` passes over the data several times, so it stores the data once, and the dictionary of
    the categories. Statistics are a row per column and stay with the steps; `apply` reuses them on
    other data. Outliers are dropped on the fitted data only.
    """

    def __init__(self, steps=DEFAULT_STEPS, scaling: str = "standard"):
        self.steps, self.scaling, self.stats = tuple(steps), scaling, {}

    def fit(self, df: DataFrame) -> DataFrame:
        df = cut_lineage(df)
        kinds = column_kinds(df)
        if "missing_values" in self.steps:
            self.stats["medians"] = _kept(fit_medians(df, kinds["numerical"]))
            if kinds["categorical"]:
                self.stats["modes"] = _kept(fit_modes(df, kinds["categorical"]))
            df = self._impute(df)
        if "categorical_encoding" in self.steps and kinds["categorical"]:
            self.stats["labels"] = cut_lineage(fit_labels(df, kinds["categorical"]))
        df = self._derive(df)
        if "scaling" in self.steps:
            self.stats["scaler"] = _kept(
                fit_scaler(df, column_kinds(df)["numerical"], self.scaling))
            df = self._scale(df)
        if "outlier_removal" in self.steps:
            df = remove_outliers(df, threshold=2.0)
        return df

    def apply(self, df: DataFrame) -> DataFrame:
        if "missing_values" in self.steps:
            df = self._impute(df)
        df = self._derive(df)
        return self._scale(df) if "scaling" in self.steps else df

    def _impute(self, df: DataFrame) -> DataFrame:
        kinds = column_kinds(df)
        df = impute_median(df, self.stats["medians"], kinds["numerical"])
        if kinds["categorical"]:
            df = impute_mode(df, self.stats["modes"], kinds["categorical"])
        return df

    def _derive(self, df: DataFrame) -> DataFrame:
        text = column_kinds(df)["categorical"]
        if "categorical_encoding" in self.steps and text:
            df = label_encode(df, self.stats["labels"], text)
        return interaction_features(df) if "interaction_features" in self.steps else df

    def _scale(self, df: DataFrame) -> DataFrame:
        return scale(df, self.stats["scaler"], column_kinds(df)["numerical"])


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, correlation) for the lower triangle, all in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}")
            for i, (a, b) in enumerate(pairs)]
    items = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                      F.col(f"_{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)]
    return df.agg(*aggs).select(F.inline(F.array(*items)))
