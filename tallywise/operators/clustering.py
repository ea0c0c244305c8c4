"""Clustering of feature vectors, cluster metrics and cluster profiles.

Frames are (id, vec array<double>); labels are (id, cluster_id).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.quantiles import unpivot
from ..functions.scalar import ratio_or_one
from ..functions.vectors import euclidean, squared_distance
from ..session import cut_lineage
from .density import dbscan
from .hierarchy import hdbscan
from .neighbours import dbscan as grid_dbscan
from .neighbours import sites
from .pivots import choose_pivots, differences, distances, matrix, stacked, with_cell
from .relational import best_by

NOISE = -1
#: Centres compared with each other in one task, on either side.
CENTER_BLOCK = 512
#: Widest vectors whose density clusters are looked up on a grid.
GRID_DIMS = 3
MAX_ITER = 300
#: Rows that k-means starts from, and Lloyd steps on them; a model stops when no centre moves further than TOLERANCE or
#: a step lowers its cost by less than the share LEAST_GAIN.
SAMPLE_ROWS, SAMPLE_STEPS, TOLERANCE, LEAST_GAIN = 32_768, 100, 1e-4, 1e-4
#: Tasks that share the models of a fit while they start.
MODEL_TASKS = 16
ROWS_AT_ONCE = 4_096
#: Features that Ward's hierarchy is built on.
WARD_FEATURES = 2_000


def _ml(df: DataFrame) -> DataFrame:
    return df.select("id", array_to_vector("vec").alias("features"))


# -- k-means ----------------------------------------------------------------------------------

def _seeded(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample: each further centre is drawn by the squared distance to those before."""
    chosen = [x[rng.integers(len(x))]]
    near = ((x - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        total = near.sum()
        at = rng.choice(len(x), p=near / total) if total > 0 else rng.integers(len(x))
        chosen.append(x[at])
        near = np.minimum(near, ((x - x[at]) ** 2).sum(1))
    return np.array(chosen)


def _settled(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Lloyd steps on the sample."""
    cost = np.inf
    for _ in range(SAMPLE_STEPS):
        gap = distances(x, centres)
        label = gap.argmin(1)
        size = np.bincount(label, minlength=len(centres))
        sums = (label[:, None] == np.arange(len(centres))).T.astype(float) @ x
        new = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        before, cost = cost, (gap.min(1) ** 2).sum()
        moved = np.abs(new - centres).max()
        centres = new
        if moved <= TOLERANCE or before - cost <= LEAST_GAIN * cost:
            break
    return centres


def _started(df: DataFrame, sample: np.ndarray, ks: list[int], seed: int) -> list[np.ndarray]:
    """Centres of every model after its steps on the sample, the models side by side."""
    shared = df.sparkSession.sparkContext.broadcast(sample)  # about SAMPLE_ROWS vectors

    def start(batches):
        sample = shared.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                found = _settled(sample, _seeded(sample, ks[i], np.random.default_rng([seed, ks[i], i])))
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([found.ravel().tolist()])], ["i", "c"])
    models = df.sparkSession.range(0, len(ks), 1, min(len(ks), MODEL_TASKS))
    rows = {r["i"]: r["c"] for r in models.mapInArrow(start, "i long, c array<double>").collect()}  # a row per model
    return [np.array(rows[i]).reshape(k, -1) for i, k in enumerate(ks)]


def _step(data: DataFrame, models: list[np.ndarray], d: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(sizes, sums, cost) of every model's clusters, all by one scan that adds up where the rows lie."""
    stacked_centres = np.concatenate(models)
    starts = np.cumsum([0, *map(len, models)])
    names = ["centre", "n", "cost", *[f"s{k}" for k in range(d)]]

    def scan(batches):
        total = np.zeros((len(stacked_centres), d + 2))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = matrix(batch.column(0).slice(at, ROWS_AT_ONCE))
                gap = distances(x, stacked_centres)
                for start, stop in zip(starts[:-1], starts[1:]):
                    own = gap[:, start:stop]
                    label = own.argmin(1)
                    hot = (label[:, None] == np.arange(stop - start)).T.astype(float)
                    total[start:stop, 0] += hot.sum(1)
                    total[start:stop, 1] += hot @ own.min(1) ** 2
                    total[start:stop, 2:] += hot @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int64()), *[pa.array(c) for c in total.T]], names)
    kind = "centre long, " + ", ".join(f"{n} double" for n in names[1:])
    rows = data.mapInArrow(scan, kind).groupBy("centre").agg(*[F.sum(n).alias(n) for n in names[1:]])
    total = np.zeros((len(stacked_centres), d + 2))
    for r in rows.collect():  # a row per centre
        total[r["centre"]] = r[1:]
    return [(total[a:b, 0], total[a:b, 2:], float(total[a:b, 1].sum())) for a, b in zip(starts[:-1], starts[1:])]


def fit_many(df: DataFrame, ks: list[int], seed: int = 42, max_iter: int = MAX_ITER) -> list[tuple[np.ndarray, float]]:
    """(centres, cost) of a k-means fit for every entry of `ks`, all carried by the same scans.

    Centres start from k-means++ and Lloyd steps on at most about SAMPLE_ROWS rows drawn by the hash of their
    id; then every scan of all rows is a step of all models, each of which stops on its own.
    """
    n = df.count()
    if not n:
        return [(np.zeros((0, 0)), 0.0) for _ in ks]
    share = min(1.0, SAMPLE_ROWS / n)
    drawn = df.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = drawn.select("id", "vec").collect() or df.select("id", "vec").limit(1).collect()
    sample = stacked([r["vec"] for r in sorted(rows, key=lambda r: r["id"])])
    centres = _started(df, sample, ks, seed)
    cost, open_ = [np.inf] * len(ks), list(range(len(ks)))
    data = df.select(F.col("vec").cast("array<double>")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(max_iter):
            found = _step(data, [centres[m] for m in open_], sample.shape[1])
            still = []
            for m, (size, sums, now) in zip(open_, found):
                gained, cost[m] = cost[m] - now, now
                new = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres[m])
                if np.abs(new - centres[m]).max() > TOLERANCE and gained > LEAST_GAIN * now:
                    centres[m] = new
                    still.append(m)
            open_ = still
            if not open_:
                break
    finally:
        data.unpersist()
    return list(zip(centres, cost))


def _labelled(df: DataFrame, centres: np.ndarray) -> DataFrame:
    """`df` with `cluster_id` and `distance_to_center`: the nearest centre, the first of equal ones."""
    kind = pa.struct([("i", pa.int32()), ("d", pa.float64())])

    def nearest(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], kind)
        gap = np.round(differences(matrix(vectors), centres) ** 2, 12)
        return pa.StructArray.from_arrays([pa.array(gap.argmin(1).astype(np.int32)), pa.array(np.sqrt(gap.min(1)))],
                                          fields=list(kind))
    return df.withColumn("_b", F.arrow_udf(nearest, "struct<i: int, d: double>")(
        F.col("vec").cast("array<double>"))).withColumns(
        {"cluster_id": F.col("_b.i"), "distance_to_center": F.col("_b.d")}).drop("_b")


def kmeans(df: DataFrame, k: int, restarts: int = 10, seed: int = 42, max_iter: int = MAX_ITER) -> DataFrame:
    """(id, cluster_id) of the cheapest of several k-means fits."""
    centres, _ = min(fit_many(df, [k] * restarts, seed, max_iter), key=lambda m: m[1])
    if not len(centres):
        return df.select("id", F.lit(0).alias("cluster_id"))
    return _labelled(df.select("id", "vec"), centres).select("id", "cluster_id")


def silhouettes(df: DataFrame, models: list[np.ndarray]) -> list[float]:
    """Mean squared-Euclidean silhouette under each model's nearest centres, all by two scans."""
    d = models[0].shape[1]
    data = df.select(F.col("vec").cast("array<double>"))
    found = _step(data, models, d)
    norms = _norms(data, models)

    def scan(batches):
        total, n = np.zeros(len(models)), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = matrix(batch.column(0).slice(at, ROWS_AT_ONCE))
                n += len(x)
                own = (x * x).sum(1)[:, None]
                for m, (centres, (size, sums, _), psi) in enumerate(zip(models, found, norms)):
                    label = distances(x, centres).argmin(1)
                    held = np.maximum(size, 1)[None, :]
                    far = np.maximum(own + psi[None, :] / held - 2 * (x @ sums.T) / held, 0)
                    rows = np.arange(len(x))
                    mine = size[label]
                    inner = far[rows, label] * mine / np.maximum(mine - 1, 1)
                    far[:, size == 0] = np.inf
                    far[rows, label] = np.inf
                    outer = far.min(1)
                    top = np.maximum(inner, outer)
                    total[m] += np.where((mine > 1) & (top > 0) & np.isfinite(outer), (outer - inner) / np.where(
                        (top > 0) & np.isfinite(top), top, 1), 0).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(models)), pa.int64()), pa.array(total),
                                          pa.array(np.full(len(models), n), pa.int64())], ["m", "total", "n"])
    rows = data.mapInArrow(scan, "m long, total double, n long").groupBy("m").agg(
        (F.sum("total") / F.sum("n")).alias("s")).collect()
    return [r["s"] for r in sorted(rows, key=lambda r: r["m"])]


def _norms(data: DataFrame, models: list[np.ndarray]) -> list[np.ndarray]:
    """Sum of the squared lengths in every cluster."""
    def scan(batches):
        total = [np.zeros(len(c)) for c in models]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = matrix(batch.column(0).slice(at, ROWS_AT_ONCE))
                for own, centres in zip(total, models):
                    own += np.bincount(distances(x, centres).argmin(1), (x * x).sum(1), len(centres))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sum(map(len, models))), pa.int64()),
                                          pa.array(np.concatenate(total))], ["centre", "total"])
    flat = np.zeros(sum(map(len, models)))
    for r in data.mapInArrow(scan, "centre long, total double").groupBy("centre").agg(F.sum("total").alias("t")).collect():
        flat[r["centre"]] = r["t"]
    return np.split(flat, np.cumsum([len(c) for c in models])[:-1])


def centroid_table(df: DataFrame, d: int) -> DataFrame:
    """(cluster_id, size, center) from a frame with vec and cluster_id."""
    means = [F.avg(F.col("vec").getItem(i)) for i in range(d)]
    return df.groupBy("cluster_id").agg(F.count("*").alias("size"), F.array(*means).alias("center"))


def kmeans_fixed_init(df: DataFrame, centroids: list[list[float]], steps: int) -> DataFrame:
    """Lloyd steps from given centroids; k*d numbers reach the driver per step."""
    df, centres = cut_lineage(df.select("id", "vec")), np.array(centroids, float)
    for _ in range(steps):
        for row in centroid_table(_labelled(df, centres), centres.shape[1]).collect():
            centres[row["cluster_id"]] = row["center"]
    return _labelled(df, centres).select("id", "cluster_id", "distance_to_center")


def choose_k(df: DataFrame, n: int, max_k: int = 10, restarts: int = 10,
             seed: int = 42, max_iter: int = MAX_ITER) -> DataFrame:
    """(k, inertia, silhouette, is_best) for the k range of the elbow search."""
    ks = list(range(2, min(max_k + 1, n // 2)))
    fits = fit_many(df, [k for k in ks for _ in range(restarts)], seed, max_iter)
    cheapest = [min(fits[i * restarts:(i + 1) * restarts], key=lambda m: m[1]) for i in range(len(ks))]
    values = silhouettes(df, [c for c, _ in cheapest]) if ks else []
    rows = [(k, cost, float(s)) for k, (_, cost), s in zip(ks, cheapest, values)]
    best = min(rows, key=lambda r: (-r[2], r[0]))[0] if rows else None
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, inertia double, silhouette double, is_best boolean")


def bisecting_kmeans(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Top-down hierarchical partition minimising the squared error."""
    model = BisectingKMeans(k=k, seed=seed).fit(_ml(df))
    return model.transform(_ml(df)).select("id", F.col("prediction").alias("cluster_id"))


def ward_merges(centres: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, float]]:
    """(a, b, rise in squared error) of all Ward merges of weighted centres, cheapest first.

    Chains of nearest neighbours: two that are nearest to each other merge whatever else does. A group
    keeps the smaller position of the two.
    """
    c, n = centres.astype(float).copy(), sizes.astype(float).copy()
    there, chain, out = np.ones(len(c), bool), [], []
    while there.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(there)[0]))
        top = chain[-1]
        apart = c - c[top]
        rise = n * n[top] / (n + n[top]) * np.einsum("nd,nd->n", apart, apart)
        rise[~there] = np.inf
        rise[top] = np.inf
        near = int(rise.argmin())
        if len(chain) > 1 and rise[chain[-2]] <= rise[near]:
            near = chain[-2]  # a tie goes back, so that the chain ends
            chain = chain[:-2]
            a, b = sorted((top, near))
            out.append((a, b, float(rise[near])))
            c[a] = (n[a] * c[a] + n[b] * c[b]) / (n[a] + n[b])
            n[a] += n[b]
            there[b] = False
        else:
            chain.append(near)
    return sorted(out, key=lambda m: m[2])


def ward(df: DataFrame, k: int = 5, features: int = WARD_FEATURES) -> DataFrame:
    """(id, cluster_id): Ward's hierarchy cut at `k` clusters, numbered by their smallest id.

    Rows add up to at most about `features` mergeable features (count, sum) around vectors drawn by the hash
    of their id; only these are merged one by one. Up to that many distinct vectors each is its own feature.
    """
    found = cut_lineage(sites(df, "id"))
    n = found.count()
    pivots = choose_pivots(found, "site", max(1, n), most=features)
    if not len(pivots):
        return df.select("id", F.lit(0).alias("cluster_id"))
    d = pivots.shape[1]
    located = cut_lineage(with_cell(found, pivots).select("site", "vec", "weight", "cell"))
    rows = located.groupBy("cell").agg(
        F.sum("weight").alias("n"), F.min("site").alias("first"),
        F.array(*[F.sum(F.col("weight") * F.col("vec").getItem(j)) for j in range(d)]).alias("s")).orderBy("cell").collect()
    sizes = np.array([r["n"] for r in rows], float)
    group = {i: [i] for i in range(len(rows))}
    for a, b, _ in ward_merges(np.array([r["s"] for r in rows]) / sizes[:, None], sizes)[:max(0, len(rows) - k)]:
        a, b = (next(g for g in group if x in group[g]) for x in (a, b))
        group[a] += group.pop(b)
    order = sorted(group.values(), key=lambda g: min(rows[i]["first"] for i in g))
    of = {rows[i]["cell"]: at for at, g in enumerate(order) for i in g}
    names = F.lit([of.get(c, -1) for c in range(len(pivots))])
    labels = located.select("vec", F.element_at(names, F.col("cell") + 1).alias("cluster_id"))
    return df.select("id", "vec").join(labels, "vec").select("id", "cluster_id")


def gaussian_mixture(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Soft clusters: (id, cluster_id, cluster_probability)."""
    model = GaussianMixture(k=k, seed=seed).fit(_ml(df))
    return model.transform(_ml(df)).select(
        "id", F.col("prediction").alias("cluster_id"),
        F.array_max(vector_to_array("probability")).alias("cluster_probability"))


# -- metrics ----------------------------------------------------------------------------------

def distance_to_center(df: DataFrame, d: int) -> DataFrame:
    """Distance of every labelled row to the mean of its cluster; noise has none."""
    centers = centroid_table(df.where(F.col("cluster_id") != NOISE), d).select(
        "cluster_id", "center")
    return df.join(centers, "cluster_id", "left").withColumn(
        "distance_to_center", euclidean(F.col("vec"), F.col("center"))).drop("center")


def cluster_metrics(df: DataFrame, d: int) -> DataFrame:
    """inertia, calinski_harabasz and davies_bouldin of a frame with vec and cluster_id.

    Two passes: means per cluster, then distances to them. What remains is k rows, whose centre
    distances are compared block by block, CENTER_BLOCK by CENTER_BLOCK. Noise rows are left out.
    """
    kept = df.where(F.col("cluster_id") != NOISE)
    spread = distance_to_center(kept, d).groupBy("cluster_id").agg(
        F.avg("distance_to_center").alias("scatter"),
        F.sum(F.col("distance_to_center") ** 2).alias("within"))
    per = centroid_table(kept, d).join(spread, "cluster_id")
    whole = F.struct(*[F.avg(F.col("vec").getItem(i)).alias(f"m{i}") for i in range(d)])
    overall = kept.agg(whole.alias("_m")).select(
        F.array(*[F.col(f"_m.m{i}") for i in range(d)]).alias("m"))
    stats = per.withColumn("_all", overall.scalar()).agg(
        F.count("*").alias("k"), F.sum("size").alias("n"), F.sum("within").alias("inertia"),
        F.sum(F.col("size") * squared_distance(F.col("center"), F.col("_all"))).alias("between"))
    blocks = F.ceil(per.agg(F.count("*")).scalar() / F.lit(CENTER_BLOCK)).cast("int")
    dealt = per.withColumn("_n", F.greatest(blocks, F.lit(1))).withColumn(
        "_b", F.pmod(F.xxhash64("cluster_id"), F.col("_n")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    one = dealt.select(F.col("_b").alias("p"), every.alias("q"), F.col("cluster_id").alias("i"),
                       F.col("center").alias("ci"), F.col("scatter").alias("si"))
    two = dealt.select(every.alias("p"), F.col("_b").alias("q"), F.col("cluster_id").alias("j"),
                       F.col("center").alias("cj"), F.col("scatter").alias("sj"))
    worst = (one.join(two, ["p", "q"]).where("i <> j")
             .groupBy("i").agg(F.max(F.try_divide(
                 F.col("si") + F.col("sj"), euclidean(F.col("ci"), F.col("cj")))).alias("r")))
    return stats.select(
        F.col("k").cast("int").alias("n_clusters"), "inertia",
        F.try_divide(F.try_divide("between", F.col("k") - 1),
                     F.try_divide("inertia", F.col("n") - F.col("k"))).alias("calinski_harabasz")
    ).withColumn("davies_bouldin", worst.agg(F.avg("r")).scalar())


def silhouette(df: DataFrame) -> float | None:
    """Squared-Euclidean silhouette without noise rows; None below two clusters."""
    kept = df.where(F.col("cluster_id") != NOISE).select(
        array_to_vector("vec").alias("features"), F.col("cluster_id").cast("double").alias("prediction"))
    if kept.select("prediction").distinct().limit(2).count() < 2:
        return None
    return float(ClusteringEvaluator().evaluate(kept))


def density_clusters(df: DataFrame, d: int, eps: float, min_samples: int) -> DataFrame:
    """(id, cluster_id, is_core), exact at any width; narrow vectors are looked up on a grid."""
    if d <= GRID_DIMS:
        return grid_dbscan(df, "id", eps, d, min_samples)
    return dbscan(df, "id", eps, min_samples)


def compare_methods(df: DataFrame, d: int, k: int = 5, eps: float = 0.5, min_samples: int = 5,
                    restarts: int = 10, hierarchy: bool = False) -> tuple[DataFrame, DataFrame, str]:
    """Run all methods, on request also the density hierarchy: (labels by method, metrics, best method).

    Labels carry the distance to the centre and, for soft clusters, the probability. A method
    that Spark cannot run on the data has its error beside its name; faults of the program itself
    are raised.
    """
    runs = {"kmeans": lambda: kmeans(df, k, restarts), "hierarchical": lambda: ward(df, k),
            "gaussian_mixture": lambda: gaussian_mixture(df, k),
            "dbscan": lambda: density_clusters(df, d, eps, min_samples)}
    if hierarchy:
        runs["hdbscan"] = lambda: hdbscan(df, "id", min_samples=min_samples)
    labels, rows = None, []
    for method, run in runs.items():
        try:
            found = run()
            if "cluster_probability" not in found.columns:
                found = found.withColumn("cluster_probability", F.lit(None).cast("double"))
            scored = cut_lineage(df.select("id", "vec").join(
                found.select("id", "cluster_id", "cluster_probability"), "id"))
            m = cluster_metrics(scored, d).first()
            rows.append((method, int(m["n_clusters"]), silhouette(scored), m["inertia"],
                         m["calinski_harabasz"], m["davies_bouldin"], None))
        except (PySparkException, ValueError) as error:
            rows.append((method, None, None, None, None, None, str(error)))
            continue
        found = distance_to_center(scored, d).select(
            "id", F.col("cluster_id").cast("bigint").alias("cluster_id"), F.lit(method).alias("cluster_method"),
            "distance_to_center", "cluster_probability")
        labels = found if labels is None else labels.unionByName(found)
    metrics = df.sparkSession.createDataFrame(
        rows, "cluster_method string, n_clusters int, silhouette double, inertia double, "
              "calinski_harabasz double, davies_bouldin double, error string")
    top = best_by(metrics, "cluster_method", "silhouette").first()
    return labels, metrics, top[0] if top else None


# -- profiles ---------------------------------------------------------------------------------

def cluster_profiles(df: DataFrame, columns: list[str], label: str = "cluster_id") -> DataFrame:
    """(cluster, size, percentage, feature, cluster_mean, overall_mean, difference_ratio).

    Noise has no profile, but its rows count in the overall mean and in the percentage base.
    """
    long = unpivot(df, columns, [label]).groupBy("feature", label).agg(
        F.sum("_v").alias("s"), F.count("*").alias("c"))
    overall = long.groupBy("feature").agg((F.sum("s") / F.sum("c")).alias("overall_mean"))
    sizes = df.groupBy(label).agg(F.count("*").alias("size"))
    total = df.agg(F.count("*")).scalar()
    return (long.where(F.col(label) != NOISE).join(overall, "feature").join(sizes, label)
            .withColumn("cluster_mean", F.col("s") / F.col("c"))
            .select(label, "size", (F.col("size") * 100.0 / total).alias("percentage"), "feature",
                    "cluster_mean", "overall_mean",
                    ratio_or_one(F.col("cluster_mean"), F.col("overall_mean"))
                    .alias("difference_ratio")))


def dominant_characteristics(profiles: DataFrame, margin: float = 0.3) -> DataFrame:
    """Features of a cluster that lie more than `margin` from the overall mean."""
    ratio = F.col("difference_ratio")
    return profiles.where(F.abs(ratio - 1.0) > margin).withColumn(
        "direction", F.when(ratio > 1, "high").otherwise("low"))


def characteristics_by_cluster(dominant: DataFrame, label: str = "cluster_id") -> DataFrame:
    """One row per cluster with its features as an array (at most one entry per column)."""
    return dominant.groupBy(label).agg(F.array_sort(F.collect_list(
        F.struct("feature", F.col("difference_ratio").alias("ratio"), "direction")))
        .alias("characteristics"))


def cluster_sizes(labels: DataFrame, label: str = "cluster_id") -> DataFrame:
    """Points per cluster without noise, and their percentage of all rows, noise included."""
    total = labels.agg(F.count("*")).scalar()
    return (labels.where(F.col(label) != NOISE).groupBy(label).agg(F.count("*").alias("cnt"))
            .withColumn("percentage", F.col("cnt") * 100.0 / total))
