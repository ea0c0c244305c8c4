"""Anomaly scores, ground truth, evaluation and explanation.

Scored frames are (id, vec array<double>); a lower score is more anomalous.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.keyed import uniform
from ..functions.quantiles import LINEAR, column_quantiles
from ..functions.ranking import row_positions
from ..functions.scalar import join_labels
from ..functions.vectors import dot
from ..session import cut_lineage
from .relational import user_noise_ratio

#: Defaults of the isolation forest: trees, and rows that each of them draws.
TREES, ROWS_PER_TREE = 100, 256
#: Spark's limit; trees end earlier where their rows are of one class.
MAX_DEPTH = 30


# -- isolation forest -------------------------------------------------------------------------

def expected_depth(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n <= 2 else 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, depth, rows): heap numbering, a leaf has feature -1."""
    nodes, todo = [], [(1, x, 0)]
    while todo:
        node, part, depth = todo.pop()
        low, high = (part.min(0), part.max(0)) if len(part) else (None, None)
        open_dims = np.flatnonzero(high > low) if len(part) > 1 and depth < limit else []
        if not len(open_dims):
            nodes.append((node, -1, 0.0, depth + expected_depth(len(part)), len(part)))
            continue
        f = int(rng.choice(open_dims))
        cut = float(rng.uniform(low[f], high[f]))
        nodes.append((node, f, cut, float(depth), len(part)))
        left = part[:, f] <= cut
        todo += [(2 * node, part[left], depth + 1), (2 * node + 1, part[~left], depth + 1)]
    return nodes


def fit_isolation_forest(df: DataFrame, seed: int = 42, trees: int = TREES,
                         rows_per_tree: int = ROWS_PER_TREE) -> DataFrame:
    """Node table (tree, node, feature, threshold, depth, rows): at most trees * 2 * rows_per_tree rows.

    Every tree draws each row by its own key hash with one probability, about rows_per_tree rows
    in all, and grows in its own task. A forest sees at most about trees * rows_per_tree rows.
    """
    n = df.count()
    share = min(1.0, rows_per_tree / max(n, 1))
    draw = lambda tree: F.pmod(F.xxhash64("id", F.lit(seed), tree), F.lit(1 << 31)) / float(1 << 31)
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < share)
    picked = df.withColumn("tree", F.explode(drawn))
    limit = math.ceil(math.log2(max(rows_per_tree, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("id")["vec"].to_list()).astype(float)
        nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "depth", "rows"])
        out.insert(0, "tree", tree)
        return out

    return picked.select("tree", "id", "vec").groupBy("tree").applyInPandas(
        grow, "tree int, node long, feature int, threshold double, depth double, rows long")


def forest_score(df: DataFrame, forest: DataFrame, rows_per_tree: int = ROWS_PER_TREE,
                 vec: str = "vec") -> DataFrame:
    """Adds `raw_score` = -2^(-mean depth / expected depth), vectorised over all trees."""
    size = 2 ** (math.ceil(math.log2(max(rows_per_tree, 2))) + 1)
    nodes = forest.toPandas()
    names = sorted(nodes["tree"].unique())
    feature = np.full((len(names), size), -1, dtype=np.int32)
    cut, depth = np.zeros((len(names), size)), np.zeros((len(names), size))
    at = nodes["tree"].map({t: i for i, t in enumerate(names)}).to_numpy()
    where = (at, nodes["node"].to_numpy())
    feature[where], cut[where], depth[where] = nodes["feature"], nodes["threshold"], nodes["depth"]
    model = df.sparkSession.sparkContext.broadcast((feature, cut, depth))
    expected = expected_depth(rows_per_tree)

    @F.pandas_udf("double")
    def score(vecs: pd.Series) -> pd.Series:
        feat, thr, dep = model.value
        x = np.stack(vecs.to_list()).astype(float)
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        for t in range(len(feat)):
            node = np.ones(len(x), dtype=np.int64)
            while True:
                f = feat[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > thr[t, node]
                node = np.where(inner, 2 * node + right, node)
            total += dep[t, node]
        return pd.Series(-np.exp2(-(total / max(len(feat), 1)) / expected))

    return df.withColumn("raw_score", score(F.col(vec)))


def flag_lowest(scored: DataFrame, column: str, share: float) -> DataFrame:
    """Adds `is_anomaly` for scores below the exact `share` quantile (linear)."""
    q = column_quantiles(scored, [column], {"q": (share, LINEAR)}).select("q").scalar()
    return scored.withColumn("is_anomaly", F.col(column) < q)


def tree_rows(df: DataFrame, rows_per_tree: int = ROWS_PER_TREE) -> int:
    """Rows that a tree draws: no more than there are."""
    return min(rows_per_tree, df.count())


def isolation_forest(df: DataFrame, contamination: float = 0.1, seed: int = 42, trees: int = TREES,
                     rows_per_tree: int | None = None, forest: DataFrame | None = None) -> DataFrame:
    """(id, anomaly_score, is_anomaly): score relative to the contamination quantile.

    `forest` is one fitted before with the same `rows_per_tree`; else it is fitted here.
    """
    size = rows_per_tree or tree_rows(df)
    if forest is None:
        forest = fit_isolation_forest(df, seed, trees, size)
    scored = cut_lineage(forest_score(df, forest, size).select("id", "raw_score"))
    q = column_quantiles(scored, ["raw_score"], {"q": (contamination, LINEAR)}).select("q").scalar()
    shifted = scored.select("id", (F.col("raw_score") - q).alias("anomaly_score"))
    return shifted.withColumn("is_anomaly", F.col("anomaly_score") < 0)


# -- boundary score ---------------------------------------------------------------------------

def _hash_uniforms(salt: str, n: int) -> np.ndarray:
    """n uniforms of a parameter table, from the salt and the index."""
    return np.array([int.from_bytes(hashlib.sha256(f"{salt}:{i}".encode()).digest()[:4], "big")
                     for i in range(n)]) / 2 ** 32


def rbf_features(d: int, size: int = 32, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Directions (size x d standard normals) and phases of random Fourier features."""
    u = _hash_uniforms(f"rbf{seed}", 2 * size * d)
    normal = np.sqrt(-2 * np.log(1 - u[0::2])) * np.cos(2 * np.pi * u[1::2])
    return normal.reshape(size, d), 2 * np.pi * _hash_uniforms(f"phase{seed}", size)


def total_variance(df: DataFrame, d: int) -> DataFrame:
    """One row `v`: population variance over all entries of the vectors."""
    s = sum((F.col("vec").getItem(i) for i in range(d)), F.lit(0.0))
    ss = sum((F.col("vec").getItem(i) * F.col("vec").getItem(i) for i in range(d)), F.lit(0.0))
    m = F.avg(s) / d
    return df.agg((F.avg(ss) / d - m * m).alias("v"))


def rbf_boundary_score(df: DataFrame, d: int, nu: float = 0.1, size: int = 32,
                       seed: int = 42) -> DataFrame:
    """(id, anomaly_score, is_anomaly): likeness to the mean random-Fourier embedding.

    Directions scale with gamma = 1 / (d * variance). Two passes of expressions: the mean of
    `size` cosines, then a dot product per row; the lowest share nu is flagged.
    """
    df = cut_lineage(df.select("id", "vec"))
    w, b = rbf_features(d, size, seed)
    gamma = F.coalesce(F.try_divide(F.lit(1.0), F.lit(float(d)) * F.col("v")), F.lit(1.0))
    width = total_variance(df, d).select(F.sqrt(F.lit(2.0) * gamma).alias("g")).scalar()
    planes = F.lit([[float(x) for x in row] + [float(c)] for row, c in zip(w, b)])
    embedded = df.select("id", "vec", width.alias("_g")).select("id", F.transform(
        planes, lambda p: F.cos(F.col("_g") * dot(F.slice(p, 1, d), F.col("vec"))
                                + F.element_at(p, d + 1))).alias("z"))
    embedded = cut_lineage(embedded)
    mean = embedded.agg(F.array(*[F.avg(F.col("z").getItem(j)) for j in range(size)]).alias("m"))
    # Rounded, so that equal rows get equal scores whatever the order of the sums.
    scored = embedded.withColumn("_m", mean.scalar()).select("id", F.round(
        dot(F.col("z"), F.col("_m")) * F.lit(2.0 / size), 9).alias("anomaly_score"))
    return flag_lowest(scored, "anomaly_score", nu)


# -- supervised -------------------------------------------------------------------------------

def ground_truth(users: DataFrame, tx: DataFrame, share: float = 0.1) -> DataFrame:
    """(user_id, is_anomaly): more than `share` of the user's transactions are noise."""
    ratio = user_noise_ratio(tx).select("user_id", "noise_ratio")
    return users.select("user_id").join(ratio, "user_id", "left").select(
        "user_id", F.coalesce(F.col("noise_ratio") > share, F.lit(False)).alias("is_anomaly"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, cnt, weight): n / (2 * class size)."""
    counts = df.groupBy(label).agg(F.count("*").alias("cnt"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("weight", total / (F.lit(2.0) * F.col("cnt")))


def fit_supervised(df: DataFrame, trees: int = 100, seed: int = 42, min_positives: int = 5,
                   max_depth: int = MAX_DEPTH):
    """A class-balanced random forest on (id, vec, is_anomaly); None with too few positives."""
    n, pos = df.agg(F.count("*"), F.count_if("is_anomaly")).first()
    if pos < min_positives or pos == n:
        return None
    weight = F.when(F.col("is_anomaly"), F.lit(n / (2.0 * pos))).otherwise(
        F.lit(n / (2.0 * (n - pos))))
    data = df.select(array_to_vector("vec").alias("features"),
                     F.col("is_anomaly").cast("double").alias("label"), weight.alias("w"))
    return RandomForestClassifier(numTrees=trees, seed=seed, weightCol="w", maxDepth=max_depth,
                                  cacheNodeIds=True).fit(data)


def supervised_score(df: DataFrame, model, vec: str = "vec") -> DataFrame:
    """Adds `probability` of being anomalous and `predicted`."""
    out = model.transform(df.withColumn("features", array_to_vector(vec)))
    return out.withColumn("_p", vector_to_array("probability").getItem(1)).withColumn(
        "predicted", F.col("prediction") == 1.0).drop(
        "features", "rawPrediction", "probability", "prediction").withColumnRenamed(
        "_p", "probability")


def supervised_forest(df: DataFrame, seed: int = 42) -> DataFrame | None:
    """(id, anomaly_score, is_anomaly) on the training rows; None when skipped."""
    model = fit_supervised(df, seed=seed)
    if model is None:
        return None
    return supervised_score(df.select("id", "vec"), model).select(
        "id", F.col("probability").alias("anomaly_score"), F.col("predicted").alias("is_anomaly"))


# -- explanation ------------------------------------------------------------------------------

def shapley_contributions(rows: DataFrame, background: DataFrame, names: list[str], score,
                          permutations: int = 10) -> DataFrame:
    """(id, feature, contribution, base): sampled Shapley values of `score` for every given row.

    `score` maps a frame with `vec` to one with `score`. For each row and permutation a row is
    drawn from the whole background, and the features switch one by one from it to the row
    itself; a contribution is the mean change of the score at the switch of that feature. `base`
    is the mean score of the drawn rows: contributions and base add up to the row's score.
    """
    d = len(names)
    pool = row_positions(background.select("id", "vec"), ["id"], "_at").select(
        F.col("_at").alias("_draw"), F.col("vec").alias("b"))
    total = pool.agg(F.count("*")).scalar()
    key = F.concat_ws("/", F.col("id"), F.col("perm"))
    runs = (rows.select("id", F.col("vec").alias("x"))
            .withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
            .withColumn("_draw", (F.floor(uniform(key, "bg") * total) + 1).cast("bigint"))
            .join(pool, "_draw").drop("_draw")
            .withColumn("order", F.transform(F.array_sort(F.array(*[
                F.struct(uniform(key, f"f{i}").alias("u"), F.lit(i).alias("i"))
                for i in range(d)])), lambda s: s["i"])))
    steps = runs.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    mixed = F.transform(F.col("x"), lambda v, i: F.when(
        F.array_position("order", i) <= F.col("step"), v).otherwise(F.col("b")[i]))
    scored = score(steps.select("id", "perm", "order", "step", mixed.alias("vec")))
    gains = F.array(
        F.struct((F.col("step") - 1).alias("pos"), F.col("score").alias("g")),
        F.struct(F.col("step").alias("pos"), (-F.col("score")).alias("g")))
    parts = scored.select("id", "order", F.explode(gains).alias("_g"),
                          F.when(F.col("step") == 0, F.col("score")).alias("_base"))
    name_of = F.array(*[F.lit(n) for n in names])
    feature = F.when(F.col("_g.pos").between(0, d - 1), name_of[F.col("order")[F.col("_g.pos")]])
    # The first step's outer gain has no feature; its row carries the drawn row's score.
    sums = parts.groupBy("id", feature.alias("feature")).agg(
        (F.sum("_g.g") / F.lit(float(permutations))).alias("contribution"), F.avg("_base").alias("base"))
    bases = sums.where("feature IS NULL").select("id", "base")
    return sums.where("feature IS NOT NULL").drop("base").join(bases, "id")


def importance_ranking(contributions: DataFrame, top: int | None = None) -> DataFrame:
    """(feature, importance): mean absolute contribution, largest first; all features without `top`."""
    ranked = (contributions.groupBy("feature")
              .agg(F.avg(F.abs(F.col("contribution"))).alias("importance"))
              .orderBy(F.desc("importance"), "feature"))
    return ranked if top is None else ranked.limit(top)


# -- rules, evaluation, result rows -----------------------------------------------------------

def rule_flags(tx: DataFrame, age: Column | None = None) -> DataFrame:
    """The four noise patterns as detectors; stateless, for batch and stream alike."""
    age = F.col("age") if age is None else age
    young_big = (age < 25) & (F.col("amount") >= 5_000_000)
    outside = (F.col("amount") >= 30_000_000) | (F.col("amount") <= 800)
    flags = {"rule_location": F.col("city").isin(C.REMOTE_CITIES), "rule_age_amount": young_big,
             "rule_time": F.col("hour_of_day").between(2, 5), "rule_amount": outside}
    out = tx.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    return out.withColumn("rule_noise_type", join_labels(*[
        F.when(F.col(k), F.lit(label)) for k, label in zip(flags, C.NOISE_LABELS)]))


def detector_evaluation(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Confusion counts, precision, recall and F1 in one row."""
    p, a = F.col(predicted), F.col(actual)
    counts = df.agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"),
                    F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))
    zero = F.lit(0.0)
    return counts.withColumns({
        "precision": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), zero),
        "recall": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), zero),
        "f1": F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                         zero)})


def select_detector(results: DataFrame, supervised: str = "supervised") -> DataFrame:
    """The supervised method when present, otherwise the one with most flags."""
    flags = results.groupBy("anomaly_method").agg(F.count_if("is_anomaly").alias("n_flags"))
    order = F.struct((F.col("anomaly_method") != supervised).alias("a"), (-F.col("n_flags")).alias("b"),
                     F.col("anomaly_method").alias("m"))
    return flags.agg(F.min(order).alias("_o")).select(
        F.col("_o.m").alias("best_method"), (-F.col("_o.b")).alias("n_flags"))


def pattern_summary(results: DataFrame) -> DataFrame:
    """Per method: rows, flags, flag rate and mean score."""
    return results.groupBy("anomaly_method").agg(
        F.count("*").alias("total"), F.count_if("is_anomaly").alias("anomalies"),
        (F.count_if("is_anomaly") * 100.0 / F.count("*")).alias("anomaly_rate"),
        F.avg("anomaly_score").alias("mean_score"))


def method_stats(results: DataFrame) -> DataFrame:
    """Rows and mean score per method, most rows first."""
    return (results.groupBy("anomaly_method").agg(
        F.count("*").alias("cnt"), F.avg("anomaly_score").alias("avg_score"))
        .orderBy(F.desc("cnt"), "anomaly_method"))


def anomaly_result_rows(scored: DataFrame, method: str, contributions: DataFrame | None = None,
                        importance: DataFrame | None = None) -> DataFrame:
    """Result-table rows; contributions and importance become maps (one entry per feature)."""
    out = scored.select("user_id", F.lit(method).alias("anomaly_method"), "anomaly_score",
                        "is_anomaly")
    empty = F.lit(None).cast("map<string,double>")
    if contributions is None:
        out = out.withColumn("shap_values", empty)
    else:
        maps = contributions.groupBy("user_id").agg(F.map_from_entries(F.sort_array(F.collect_list(
            F.struct("feature", "contribution")))).alias("shap_values"))
        out = out.join(maps, "user_id", "left")
    if importance is None:
        return out.withColumn("feature_importance", empty)
    table = importance.agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("feature", "importance")))).alias("m")).scalar()
    return out.withColumn("feature_importance", table)


def as_json_columns(rows: DataFrame) -> DataFrame:
    """The map columns as JSON text, for sinks without maps."""
    return rows.withColumns({c: F.to_json(c) for c in ("shap_values", "feature_importance")})
