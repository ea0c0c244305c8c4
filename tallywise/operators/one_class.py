"""One-class boundary with a radial kernel.

Rows become vectors whose dot products approximate the kernel (Nystroem features of landmark rows). The
boundary's normal is the shortest vector of the reduced convex hull: the means of all rows in which no row
weighs more than 1 / (nu n), which is the dual of the one-class support vector machine. Each scan finds the
mean of the share nu of rows that lies lowest along the normal, from counts and sums per bin of scores
that are added up where the rows lie; the normal becomes the shortest combination of the means found so
far. The offset is the exact nu quantile of the scores, so the share nu lies below it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import LINEAR, column_quantiles
from ..session import cut_lineage
from .pivots import choose_pivots, matrix

#: Landmark rows, bins of scores, most scans, and the gap (relative to the squared length) that ends them.
LANDMARKS, BINS, SCANS, GAP = 256, 128, 60, 1e-3
ROWS_AT_ONCE = 4_096


class Features:
    """Nystroem features: k(x, landmarks) times the inverse square root of k(landmarks, landmarks)."""

    def __init__(self, landmarks: np.ndarray, gamma: float):
        self.landmarks, self.gamma = landmarks, gamma
        value, vectors = np.linalg.eigh(self.kernel(landmarks))
        kept = value > 1e-10 * value.max()
        self.root = vectors[:, kept] / np.sqrt(value[kept])

    def kernel(self, x: np.ndarray) -> np.ndarray:
        gap = (x * x).sum(1)[:, None] + (self.landmarks ** 2).sum(1)[None, :] - 2 * x @ self.landmarks.T
        return np.exp(-self.gamma * np.maximum(gap, 0))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.root


def total_variance(data: DataFrame) -> tuple[int, float]:
    """Rows, and the population variance over all entries of the vectors."""
    each = F.explode("vec").alias("x")
    n, v = data.select(each).agg(F.count("*"), F.var_pop("x")).first()
    return n, v or 0.0


def shortest(points: np.ndarray) -> np.ndarray:
    """The shortest convex combination of a few points: weights by exact steps towards or away from one of them."""
    gram = points @ points.T
    weight = np.zeros(len(points))
    weight[gram.diagonal().argmin()] = 1.0
    for _ in range(20_000):
        slope = gram @ weight
        value = weight @ slope
        to, away = int(slope.argmin()), int(np.where(weight > 0, slope, -np.inf).argmax())
        if value - slope[to] <= 1e-10 * max(value, 1e-300):
            break
        move = -weight.copy()
        most = 1.0
        if value - slope[to] >= slope[away] - value:
            move[to] += 1
        else:
            move = -move
            move[away] -= 1
            most = weight[away] / (1 - weight[away]) if weight[away] < 1 else 1.0
        along, length = move @ slope, move @ gram @ move
        step = min(most, -along / length) if length > 0 else most
        weight = np.maximum(weight + step * move, 0)
        weight /= weight.sum()
    return weight @ points


def _lowest(data: DataFrame, features: Features, normal: np.ndarray, share: float, low: float, high: float):
    """Mean of the share of rows that scores lowest, a bin at the border in part; and the ends of the scores."""
    d = len(normal)

    def scan(batches):
        total, ends = np.zeros((BINS, d + 1)), [np.inf, -np.inf]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                z = features(matrix(batch.column(0).slice(at, ROWS_AT_ONCE)))
                score = z @ normal
                place = np.clip(((score - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
                hot = (place[:, None] == np.arange(BINS)).T.astype(float)
                total[:, 0] += hot.sum(1)
                total[:, 1:] += hot @ z
                ends = [min(ends[0], score.min()), max(ends[1], score.max())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BINS), pa.int64()), pa.array(np.full(BINS, ends[0])), pa.array(np.full(BINS, ends[1])),
             *[pa.array(c) for c in total.T]], names)
    names = ["bin", "low", "high", "n", *[f"z{k}" for k in range(d)]]
    kind = "bin long, " + ", ".join(f"{c} double" for c in names[1:])
    total, ends = np.zeros((BINS, d + 1)), [np.inf, -np.inf]
    for r in (data.mapInArrow(scan, kind).groupBy("bin").agg(F.min("low"), F.max("high"), *[
            F.sum(c) for c in names[3:]]).collect()):  # a row per bin
        total[r[0]] = r[3:]
        ends = [min(ends[0], r[1]), max(ends[1], r[2])]
    wanted = share * total[:, 0].sum()
    taken = np.clip(wanted - (np.cumsum(total[:, 0]) - total[:, 0]), 0, total[:, 0])
    part = np.divide(taken, total[:, 0], out=np.zeros(BINS), where=total[:, 0] > 0)
    return part @ total[:, 1:] / wanted, ends


def fit(df: DataFrame, nu: float = 0.1, landmarks: int = LANDMARKS) -> tuple[Features, np.ndarray] | None:
    """Features and normal of the boundary around rows (id, vec); None without rows."""
    data = df.select(F.col("vec").cast("array<double>").alias("vec"))
    entries, variance = total_variance(data)
    if not entries:
        return None
    n = df.count()
    drawn = choose_pivots(df, "id", n, most=landmarks)
    features = Features(drawn, 1.0 / (drawn.shape[1] * variance) if variance > 0 else 1.0)
    seen = [_lowest(data, features, np.zeros(features.root.shape[1]), 1.0, -1.0, 1.0)[0]]
    normal, low, high = seen[0], -1.0, 1.0
    for _ in range(SCANS):
        vertex, ends = _lowest(data, features, normal, nu, low, high)
        # The next scores move little: bins go where they were, with room.
        room = 0.05 * (ends[1] - ends[0]) + 1e-9
        low, high = ends[0] - room, ends[1] + room
        if normal @ (normal - vertex) <= GAP * (normal @ normal):
            break
        seen.append(vertex)
        normal = shortest(np.array(seen))
    return features, normal


def one_class_boundary(df: DataFrame, nu: float = 0.1, landmarks: int = LANDMARKS) -> DataFrame:
    """(id, anomaly_score, is_anomaly): distance beyond the boundary that leaves the share nu of all rows outside."""
    df = cut_lineage(df.select("id", "vec"))
    model = fit(df, nu, landmarks)
    if model is None:
        return df.select("id", F.lit(None).cast("double").alias("anomaly_score"), F.lit(False).alias("is_anomaly"))
    features, normal = model

    def score(vectors: pa.Array) -> pa.Array:
        # Rounded, so that equal rows score alike in any batch.
        return pa.array(np.round(features(matrix(vectors)) @ normal, 12) if len(vectors) else [], pa.float64())
    scored = cut_lineage(df.select("id", F.arrow_udf(score, "double")(F.col("vec").cast("array<double>")).alias("s")))
    q = column_quantiles(scored, ["s"], {"q": (nu, LINEAR)}).select("q").scalar()
    shifted = scored.select("id", (F.col("s") - q).alias("anomaly_score"))
    return shifted.withColumn("is_anomaly", F.col("anomaly_score") < 0)
