"""Whitening of embeddings by refined eigenvectors of their covariance.

An entry c becomes the whole number floor(64 * c). Sums and centred products of whole numbers are
exact, so the covariance does not depend on how the rows were dealt to tasks. Its eigenvectors
start in float32 and are corrected by Ogita-Aishima steps: matrix products in extended precision
measure how far the vectors are from orthogonal and from diagonalising, and one product corrects
them, which squares the error. Vectors whose eigenvalues lie too near for that are first rotated by
the eigenvectors of the covariance within their span, shifted by their mean eigenvalue.

Edge cases: null and empty vectors and those with a null or non-finite entry are not whitened.
Vectors of another width are fitted among themselves, with their own n and components. Components
without variance (fewer rows than dimensions, constant dimensions, one row, only equal rows) are
left out. Repeated ids and equal vectors count as often as they occur. Entries beyond 2^34 count as
2^34. A deviation that a long cannot hold is null. Of an empty table nothing is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
#: Whole numbers are held within +-2^40, so that their products fit 38 digits over 10^12 rows.
LIMIT = float(1 << 40)
COMPONENTS = 32
ROWS_AT_ONCE = 1_024
STEPS = 12

PARTIAL = "width int, i int, j int, n long, total decimal(38,0)"


def blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row positions, whole numbers as float64 rows) of the usable vectors, one width and slice at a time."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        part = column.slice(at, ROWS_AT_ONCE)
        starts = np.asarray(part.offsets)
        entries = part.values.cast(pa.float64())
        bad = ~np.isfinite(entries.to_numpy(zero_copy_only=False))  # nulls arrive as NaN
        wrong = np.concatenate([[0], np.cumsum(bad)])
        width = np.diff(starts)
        usable = np.asarray(part.is_valid()) & (width > 0) & (wrong[starts[1:]] == wrong[starts[:-1]])
        numbers = entries.to_numpy(zero_copy_only=False)
        for w in np.unique(width[usable]):
            rows = np.flatnonzero(usable & (width == w))
            whole = numbers[starts[rows][:, None] + np.arange(w)]
            with np.errstate(over="ignore"):
                yield rows + at, np.clip(np.floor(whole * SCALE), -LIMIT, LIMIT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    width, i, j, n, total = zip(*rows) if rows else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(width, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(n, pa.int64()),
         pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["width", "i", "j", "n", "total"])


def _sums(batches):
    """Of a task, for each width and dimension: rows and the sum of the whole numbers."""
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for _, whole in blocks(batch.column(0)):
            n, total = held.get(whole.shape[1], (0, 0))
            held[whole.shape[1]] = n + len(whole), total + whole.astype(np.int64).sum(0).astype(object)
    yield _batch([(w, i, 0, n, t) for w, (n, total) in held.items() for i, t in enumerate(total)])


def _products(centres: dict[int, np.ndarray]):
    """Of a task, for each width: exact sums of products of the centred whole numbers, above the diagonal."""
    def products(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, whole in blocks(batch.column(0)):
                off = whole - centres[whole.shape[1]]
                if len(off) * float(np.abs(off).max()) ** 2 < 2 ** 53:  # then float64 products are exact
                    square = (off.T @ off).astype(np.int64).astype(object)
                else:
                    exact = off.astype(np.int64).astype(object)
                    square = exact.T @ exact
                held[whole.shape[1]] = held.get(whole.shape[1], 0) + square
        yield _batch([(w, i, j, 0, square[i, j]) for w, square in held.items()
                      for i in range(w) for j in range(i, w)])
    return products


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in extended precision: both are parted into slices whose float64 products have no rounding."""
    bits = (53 - max(1, a.shape[1] - 1).bit_length()) // 2
    out = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    left, right = list(_slices(a, bits, 1)), list(_slices(b, bits, 0))
    for order in range(len(left) + len(right) - 2, -1, -1):  # small parts first
        for k in range(max(0, order - len(right) + 1), min(order + 1, len(left))):
            out += left[k] @ right[order - k]
    return out


def _slices(a: np.ndarray, bits: int, axis: int) -> Iterator[np.ndarray]:
    rest = a.astype(np.longdouble)
    for _ in range(-(-64 // bits) + 1):
        top = np.abs(rest).max(axis=axis, keepdims=True)
        if not top.any():
            return
        unit = np.ldexp(np.longdouble(1), np.frexp(top)[1] - bits)
        part = np.rint(rest / unit) * unit
        rest = rest - part
        yield part.astype(np.float64)


def refined_eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns) of a symmetric matrix, in extended precision."""
    a = matrix.astype(np.longdouble)
    norm = np.abs(a).sum(1).max()
    if not norm:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / norm
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    best = np.inf
    for step in range(STEPS):
        r = one - product(x.T, x)
        s = product(x.T, product(a, x))
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = np.abs(s - np.diag(value)).sum(1).max()
        near = 2 * (off + np.abs(r).sum(1).max())
        order = np.argsort(-value, kind="stable")
        x, r, s, value = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], value[order]
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        size = np.abs(e).max()
        x = x + product(x, e)
        clusters = np.split(np.arange(len(a)), np.flatnonzero(value[:-1] - value[1:] > near) + 1)
        turned = max([_sub_solve(a, x, c, value[c].mean()) for c in clusters if len(c) > 1], default=0.0)
        size = max(size, turned)
        if size < 2.0 ** -62 or size >= best and step >= 4:
            break
        best = min(best, size)
    x = product(x, 3 * one - product(x.T, x)) / 2  # what corrections of near eigenvalues left over
    value = np.diag(product(x.T, product(a, x)))
    order = np.argsort(-value, kind="stable")
    return value[order] * norm, x[:, order]


def _sub_solve(a: np.ndarray, x: np.ndarray, cluster: np.ndarray, shift) -> float:
    """Rotate the cluster's columns of x to eigenvectors within their span; how far they turned."""
    own = x[:, cluster]
    inside = product(own.T, product(a, own) - shift * own)
    inside = (inside + inside.T) / 2
    scale = np.abs(inside).max()
    if not scale or np.abs(inside - np.diag(np.diag(inside))).max() <= 2.0 ** -61:
        return 0.0
    turn = np.linalg.eigh((inside / scale).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
    turn = (3 * turn - product(turn, product(turn.T, turn))) / 2  # orthogonal in extended precision
    x[:, cluster] = product(own, turn)
    # Signs and the order of columns are no turn.
    return float(1 - np.abs(turn).max(0).min())


@dataclass
class Whitening:
    """One width: mean as a whole centre and a remainder, projection and what each component explains."""

    n: int
    centre: np.ndarray
    left_over: np.ndarray  # n * (mean - centre), whole numbers
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, whole: np.ndarray) -> np.ndarray:
        return (whole - self.centre - self.left_over / self.n) @ self.projection

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact, or None beyond a long."""
        off = whole - self.centre
        about = ((self.n * off - self.left_over) ** 2).sum(1)
        small = about < 2.0 ** 62
        # Where the sum fits, so does every term.
        exact = self.n * np.where(small[:, None], off, 0).astype(np.int64) - self.left_over.astype(np.int64)
        out = (exact * exact).sum(1).tolist()
        for k in np.flatnonzero(~small):
            total = sum((self.n * int(v) - int(d)) ** 2 for v, d in zip(off[k], self.left_over))
            out[k] = total if total < 1 << 63 else None
        return out


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each width, fitted on all usable vectors.

    The driver holds a covariance of width x width; rows are read three times and never gathered.
    """
    data = vectors.select(F.col(column).cast("array<double>").alias("v"))
    sums: dict[int, list] = {}
    for row in (data.mapInArrow(_sums, PARTIAL).groupBy("width", "i")
                .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("width", "i").collect()):
        sums.setdefault(row.width, []).append((row.n, int(row.total)))
    centres = {w: np.array([round(t / n) for n, t in s], np.float64) for w, s in sums.items()}
    squares = {w: np.zeros((w, w), object) for w in sums}
    for row in (data.mapInArrow(_products(centres), PARTIAL).groupBy("width", "i", "j")
                .agg(F.sum("total").alias("total")).collect() if sums else []):
        squares[row.width][row.i, row.j] = squares[row.width][row.j, row.i] = int(row.total)
    models = {w: _solved(s[0][0], [t for _, t in s], centres[w], squares[w], components) for w, s in sums.items()}
    for w, total in (_measured(data, models) if models else {}).items():
        n, k = models[w].n, len(models[w].explained)
        mean = total[k] / n
        spread = total[:k] / n - np.outer(mean, mean)
        models[w].identity_error = float(np.abs(spread - np.eye(k)).max())
    return models


def _solved(n: int, totals: list[int], centre: np.ndarray, squares: np.ndarray, components: int) -> Whitening:
    rest = np.array([t - n * int(c) for t, c in zip(totals, centre)], object)
    top = n * squares - np.outer(rest, rest)  # n^2 times the covariance, exact
    covariance = np.array([[np.longdouble(v) for v in row] for row in top]) / np.longdouble(n) / np.longdouble(n)
    value, vectors = refined_eigenvectors(covariance)
    rank = int((value > len(value) * np.finfo(np.float64).eps * max(value[0], 0)).sum())
    kept = min(rank, components)
    value, vectors = value[:kept], vectors[:, :kept]
    sign = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0)) if kept else 1
    trace = np.trace(covariance)
    return Whitening(n, centre, rest.astype(np.float64),
                     (vectors * sign / np.sqrt(value)).astype(np.float64),
                     (value / (trace or 1)).astype(np.float64))


def _measured(data: DataFrame, models: dict[int, Whitening]) -> dict[int, np.ndarray]:
    """By width, over all rows: sums of products of whitened values, and their sums as the last row."""
    def products(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, whole in blocks(batch.column(0)):
                z = models[whole.shape[1]].whitened(whole)
                held[whole.shape[1]] = held.get(whole.shape[1], 0) + np.vstack([z.T @ z, z.sum(0)])
        rows = [(w, i, j, t[i, j]) for w, t in held.items() for i in range(t.shape[0]) for j in range(t.shape[1])]
        columns = zip(*rows) if rows else ([],) * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["width", "i", "j", "total"])
    out = {w: np.zeros((len(m.explained) + 1, len(m.explained))) for w, m in models.items() if len(m.explained)}
    for row in (data.mapInArrow(products, "width int, i int, j int, total double")
                .groupBy("width", "i", "j").agg(F.sum("total").alias("total")).collect()):
        out[row.width][row.i, row.j] = row.total
    return out


def with_whitened(vectors: DataFrame, models: dict[int, Whitening], column: str = "embedding",
                  out: str = "whitening") -> DataFrame:
    """`vectors` with the struct `out`: n, deviation, identity_error, and the lists whitened and explained.

    `out` replaces a column of that name. It is null for vectors that are not whitened.
    """
    kinds = [("n", pa.int64()), ("deviation", pa.int64()), ("identity_error", pa.float64()),
             ("whitened", pa.list_(pa.float64())), ("explained", pa.list_(pa.float64()))]

    def rows(vectors: pa.Array) -> pa.Array:
        size = len(vectors)
        known: list[Whitening | None] = [None] * size
        deviation: list[int | None] = [None] * size
        values = [np.empty(0)] * size
        for at, whole in blocks(vectors):
            m = models[whole.shape[1]]
            for k, z, d in zip(at, m.whitened(whole), m.deviations(whole)):
                known[k], values[k], deviation[k] = m, z, d
        ends = pa.array(np.concatenate([[0], np.cumsum([len(v) for v in values])]), pa.int32())
        none = [np.empty(0)]
        columns = [pa.array([m and m.n for m in known], pa.int64()), pa.array(deviation, pa.int64()),
                   pa.array([m and m.identity_error for m in known], pa.float64()),
                   pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values + none))),
                   pa.ListArray.from_arrays(ends, pa.array(np.concatenate([m.explained for m in known if m] + none)))]
        return pa.StructArray.from_arrays(columns, fields=[pa.field(*k) for k in kinds],
                                          mask=pa.array([m is None for m in known], pa.bool_()))
    kind = ("struct<n: bigint, deviation: bigint, identity_error: double, whitened: array<double>, "
            "explained: array<double>>")
    return vectors.withColumn(out, F.arrow_udf(rows, kind)(F.col(column).cast("array<double>")))


def by_component(whitened: DataFrame, id_column: str = "vec_id", out: str = "whitening") -> DataFrame:
    """A row per whitened vector and component: id, component from 1, n, deviation, whitened, explained, identity_error."""
    w = F.col(out)
    listed = whitened.where(w.isNotNull()).select(
        id_column, w.n.alias("n"), w.deviation.alias("deviation"), w.identity_error.alias("identity_error"),
        F.posexplode(F.arrays_zip(w.whitened.alias("whitened"), w.explained.alias("explained"))).alias("at", "of"))
    return listed.select(id_column, (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                         F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"),
                         "identity_error")
