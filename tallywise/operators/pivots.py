"""Vectors of any width dealt to cells around pivots, and the cells that a distance can reach.

A vector belongs to its nearest pivot. By the triangle inequality a cell whose ball lies farther than
a distance, or beyond the plane half-way between two pivots by more than it, holds nothing within
that distance, so exact searches only visit the other cells. Pivots and what is known of their
cells are bounded by MOST_PIVOTS and MOST_NUMBERS; rows meet in blocks of bounded size.

Where a distance reaches many cells, copies of a row for each of them would outgrow any disk. So rows are
packed, a stored row per block of near cells, and blocks meet by a nested loop that reads them again
instead of shuffling them: whatever is reached, rows are stored once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Pivots, and the numbers they consist of, that are sent to the tasks: 32 MB at most.
MOST_PIVOTS, MOST_NUMBERS = 8_192, 4_000_000
#: Rows of either side that meet in one task.
BLOCK_ROWS = 2_000
#: Numbers in the vectors of a packed block, at most; files of packed blocks, so that many tasks share them.
BLOCK_NUMBERS, FEW_FILES, BLOCKS_A_FILE = 1 << 18, 16, 8
#: Rows of one side that are compared with a block at once.
AT_ONCE = 512


@dataclass
class Cells:
    """Pivots with the rows of their cells and the largest distance of one to its pivot."""

    pivots: np.ndarray
    rows: np.ndarray
    radius: np.ndarray


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def stacked(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in vectors])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances by one product; off by about 1e-8 of the vectors' lengths at most."""
    gap = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(gap, 0.0))


def exact_distances(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """As `distances`, but those near `limit` or zero by differences."""
    out = distances(a, b)
    slack = 1e-7 * (1.0 + np.sqrt((a * a).sum(1).max(initial=0.0) + (b * b).sum(1).max(initial=0.0)))
    i, j = np.nonzero((np.abs(out - limit) <= slack) | (out <= 1e3 * slack))
    for at in range(0, len(i), 1 << 16):
        p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        apart = a[p] - b[q]
        out[p, q] = np.sqrt(np.einsum("nd,nd->n", apart, apart))
    return out


def differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances by differences, a few rows of `a` at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 20) // max(1, b.size))
    for at in range(0, len(a), step):
        apart = (a[at:at + step, None, :] - b[None, :, :]).reshape(-1, b.shape[1])
        out[at:at + step] = np.sqrt(np.einsum("nd,nd->n", apart, apart)).reshape(-1, len(b))
    return out


def choose_pivots(points: DataFrame, id_col: str, n: int, vec: str = "vec", seed: int = 1,
                  most: int | None = None) -> np.ndarray:
    """About twice the square root of the rows, or `most`, drawn by the hash of their id; bounded as stated above."""
    width = points.select(F.size(vec)).first()
    if width is None:
        return np.zeros((0, 0))
    wanted = most or 2 * math.isqrt(n) + 1
    most = max(1, min(MOST_PIVOTS, MOST_NUMBERS // max(1, width[0])))
    share = min(1.0, min(most, wanted) / n)
    drawn = points.where(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = drawn.select(vec).limit(most).collect() or points.select(vec).limit(1).collect()
    return np.unique(stacked([r[0] for r in rows]), axis=0)


def _nearest(pivots: np.ndarray):
    kind = pa.struct([("cell", pa.int32()), ("gap", pa.float64())])

    def nearest(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], kind)
        gaps = distances(matrix(vectors), pivots)
        cell = gaps.argmin(1)
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), pa.array(gaps.min(1))], fields=list(kind))
    return nearest


def with_cell(points: DataFrame, pivots: np.ndarray, vec: str = "vec") -> DataFrame:
    """`points` with the `cell` of their nearest pivot and the `gap` to it."""
    found = F.arrow_udf(_nearest(pivots), "struct<cell: int, gap: double>")(F.col(vec))
    return points.withColumn("_c", found).select(*points.columns, "_c.cell", "_c.gap")


def cells_of(located: DataFrame, pivots: np.ndarray) -> Cells:
    """Rows and radius of every cell; a row per pivot comes to the driver."""
    rows, radius = np.zeros(len(pivots), np.int64), np.full(len(pivots), -np.inf)
    for r in located.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).collect():
        rows[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    return Cells(pivots, rows, radius)


def _may_hold(cells: Cells, x: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Which cells (columns) can hold a point within `reach` of a row of `x`."""
    pivots, radius = cells.pivots, cells.radius
    longest = math.sqrt((pivots * pivots).sum(1).max(initial=0.0))
    slack = 1e-7 * (1.0 + longest + np.sqrt((x * x).sum(1)))
    within = reach + slack
    gap = distances(x, pivots)
    own = gap.argmin(1)
    least = gap.min(1)
    homes, at = np.unique(own, return_inverse=True)
    between = distances(pivots[homes], pivots)[at]
    # Distance to the plane half-way between the own pivot and another one.
    beyond = gap ** 2 - least[:, None] ** 2 > 2.0 * (within + slack)[:, None] * between + slack[:, None] ** 2
    far = gap - radius[None, :] > within[:, None]
    return ~(beyond | far)


def in_blocks(left: DataFrame, right: DataFrame, compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
              kind: str, key: str, left_id: str, right_id: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """`compare` of every block of `left` with every block of `right` that has the same `key`.

    A key's rows are dealt to blocks of about `rows` by their ids, so a crowded key is many tasks.
    Both frames are counted first; store what is dear to compute.
    """
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias(name))

    grid = blocks(left, "_nl").join(blocks(right, "_nr"), key)
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - F.lit(1)))
    a = left.join(grid, key).withColumn("_li", part(left_id, "_nl")).withColumn("_ri", every("_nr"))
    b = right.join(grid, key).withColumn("_ri", part(right_id, "_nr")).withColumn("_li", every("_nl"))
    keys = [key, "_li", "_ri"]
    # Fresh aliases keep the two sides apart when both come from one frame.
    a, b = (side.select(*[F.col(c).alias(c) for c in keys + [c for c in df.columns if c != key]])
            for side, df in ((a, left), (b, right)))
    empty = pd.DataFrame({c: [] for c in (f.strip().split(" ")[0] for f in kind.split(","))})

    def met(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return compare(one, two) if len(one) and len(two) else empty
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(met, kind)


# -- packed blocks ----------------------------------------------------------------------------

@dataclass
class Blocks:
    """The first block of every cell, how many blocks share the cell, and the blocks in all."""

    first: np.ndarray
    parts: np.ndarray
    count: int

    def holding(self, cells: np.ndarray) -> np.ndarray:
        """The blocks with rows of these cells."""
        return np.unique(np.concatenate([np.zeros(0, np.int64), *[
            np.arange(self.first[c], self.first[c] + self.parts[c]) for c in cells]])).astype(np.int32)


def _along(x: np.ndarray) -> list[int]:
    """The rows of `x` in an order that keeps near ones together: halves along the widest coordinate, again and again."""
    order, todo = [], [np.arange(len(x))]
    while todo:
        part = todo.pop()
        if len(part) < 2:
            order.extend(part)
            continue
        part = part[np.argsort(x[part, np.ptp(x[part], 0).argmax()], kind="stable")]
        todo += [part[len(part) // 2:], part[:len(part) // 2]]
    return order


def blocks_of(cells: Cells, rows: int = BLOCK_ROWS) -> Blocks:
    """Near cells share a block of at most `rows` rows, less for wide vectors; a larger cell is several blocks."""
    rows = max(1, min(rows, BLOCK_NUMBERS // max(1, cells.pivots.shape[1])))
    first, parts = np.zeros(len(cells.rows), np.int64), np.ones(len(cells.rows), np.int64)
    goal = cells.rows.sum() / max(1, math.ceil(cells.rows.sum() / rows))  # so that no block is nearly empty
    at, filled = 0, 0
    for c in _along(cells.pivots):
        n = int(cells.rows[c])
        if filled and (filled >= goal or filled + n > rows):
            at, filled = at + 1, 0
        first[c], filled = at, filled + n
        if n > rows:
            parts[c] = -(-n // rows)
            at, filled = at + int(parts[c]), 0
    return Blocks(first, parts, at + 1)


def with_block(located: DataFrame, blocks: Blocks, id_col: str, name: str = "block") -> DataFrame:
    """`located` with the block of its `cell`; rows of a cell of several blocks are dealt by their id."""
    first, parts = blocks.first, blocks.parts

    def place(cell: pa.Array, key: pa.Array) -> pa.Array:
        at = cell.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array((first[at] + key.to_numpy(zero_copy_only=False) % parts[at]).astype(np.int32))
    return located.withColumn(name, F.arrow_udf(place, "int")(
        F.col("cell"), F.pmod(F.xxhash64(id_col), F.lit(1 << 30))))


def _as_bytes(vectors: pa.Array) -> pa.Array:
    if not len(vectors):
        return pa.array([], pa.binary())
    x = np.ascontiguousarray(matrix(vectors))
    ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * (8 * x.shape[1]))
    return pa.Array.from_buffers(pa.binary(), len(x), [None, ends.buffers()[1], pa.py_buffer(x)])


def packed(df: DataFrame, blocks: int, columns: list[str], there: Column | None = None) -> DataFrame:
    """A stored row per `block`: its `rows`, an array of structs of `columns` with `vec` as bytes.

    `there`, an array<int> of blocks to meet, may be told from `rows` or aggregate columns of `df`.
    """
    slim = df.withColumn("vec", F.arrow_udf(_as_bytes, "binary")("vec"))
    files = min(blocks, FEW_FILES + blocks // BLOCKS_A_FILE)
    dealt = slim.repartition(files, "block").groupBy("block")
    rows = F.collect_list(F.struct(*columns)).alias("rows")
    if there is None:
        out = dealt.agg(rows)
    else:
        out = dealt.agg(rows, F.collect_set(there).alias("there"))
    # As large in memory as on disk, so that what a task reads at once is bounded by the size of splits.
    return cut_lineage(out, compression="uncompressed")


def unpacked(rows: pa.Array) -> dict[str, np.ndarray]:
    """The columns of packed rows, `vec` as a matrix."""
    flat = rows.flatten()
    out = {}
    for field, column in zip(flat.type, flat.flatten()):
        if pa.types.is_binary(field.type):
            at = column.offset
            ends = np.frombuffer(column.buffers()[1], np.int32)[at:at + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
            out[field.name] = np.frombuffer(data.tobytes(), float).reshape(len(column), -1)
        else:
            out[field.name] = column.to_numpy(zero_copy_only=False)
    return out


def reaching(blocks_with: DataFrame, cells: Cells, blocks: Blocks,
             spots: Callable[[dict], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Packed blocks with `there`: the blocks that can hold a point in reach; `spots` tells points and reaches of rows."""
    def visits(rows: pa.Array) -> pa.Array:
        found = []
        for i in range(len(rows)):
            x, reach = spots(unpacked(rows.slice(i, 1)))
            hit = np.zeros(len(cells.pivots), bool)
            for at in range(0, len(x), AT_ONCE):
                if hit.all():
                    break
                hit |= _may_hold(cells, x[at:at + AT_ONCE], reach[at:at + AT_ONCE]).any(0)
            found.append(blocks.holding(np.flatnonzero(hit)))
        return pa.array(found, pa.list_(pa.int32()))
    return cut_lineage(blocks_with.select("block", "rows", F.arrow_udf(visits, "array<int>")("rows").alias("there")),
                       compression="uncompressed")


_KINDS = {"long": pa.int64(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def met(left: DataFrame, right: DataFrame, compare: Callable[[int, dict, Iterator[tuple[int, dict]]], Iterator[dict]],
        kind: str) -> DataFrame:
    """What `compare` finds for every block of `left` among the blocks of `right` that its `there` names.

    `compare` gets the number and rows of a block and, one after the other, numbers and rows of blocks it meets, and
    yields columns as `kind` names them. One left block comes once for each part of the right side.
    Blocks are read from the shared folder where they meet: none is shuffled.
    """
    fields = [f.strip().split(" ") for f in kind.split(",")]
    schema = pa.schema([(name, _KINDS[k]) for name, k in fields])
    a = left.select(F.col("block").alias("_a"), "there", F.col("rows").alias("_left"))
    b = right.select(F.col("block").alias("_b"), F.col("rows").alias("_right"))
    pairs = a.join(b.hint("shuffle_replicate_nl"), F.array_contains("there", F.col("_b"))).select(
        "_a", "_b", "_left", "_right")

    def run(batches):
        def each():
            for batch in batches:
                one, two = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                for i in range(batch.num_rows):
                    yield int(one[i]), int(two[i]), batch.column(2).slice(i, 1), batch.column(3).slice(i, 1)
        for block, group in itertools.groupby(each(), key=lambda p: p[0]):
            start = next(group)
            rights = ((p[1], unpacked(p[3])) for p in itertools.chain([start], group))
            for found in compare(block, unpacked(start[2]), rights):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[f.name], f.type, from_pandas=True) for f in schema], schema=schema)
    return pairs.mapInArrow(run, kind)


def tiles(x: np.ndarray, reach: np.ndarray, y: np.ndarray, cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of `x`, rows of `y`) that can be within `reach` of each other, by the balls around the cells of `y`.

    `reach` is read anew for every AT_ONCE rows, so it may shrink meanwhile.
    """
    order = np.argsort(cell, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(cell[order]) != 0])) if len(order) else np.zeros(0, int)
    size = np.diff([*starts, len(order)])
    centres = np.add.reduceat(y[order], starts, 0) / size[:, None]
    apart = y[order] - np.repeat(centres, size, 0)
    radius = np.sqrt(np.maximum.reduceat(np.einsum("nd,nd->n", apart, apart), starts))
    longest = np.sqrt((y * y).sum(1).max(initial=0.0))
    for at in range(0, len(x), AT_ONCE):
        rows = np.arange(at, min(at + AT_ONCE, len(x)))
        slack = 1e-7 * (1.0 + longest + np.sqrt((x[rows] * x[rows]).sum(1)))
        near = distances(x[rows], centres) - radius[None, :] <= (reach[rows] + slack)[:, None]
        if 2 * (near @ size).sum() >= len(rows) * len(y):
            yield rows, np.arange(len(y))
            continue
        for k in np.flatnonzero(near.any(0)):
            yield rows[near[:, k]], order[starts[k]:starts[k] + size[k]]


def forest(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of edges (a, b) that span each connected group of the nodes 0 to `nodes` - 1."""
    label, kept, open_ = np.arange(nodes), [], np.arange(len(a))
    while True:
        one, two = label[a[open_]], label[b[open_]]
        apart = one != two
        open_, one, two = open_[apart], one[apart], two[apart]
        if not len(open_):
            return np.concatenate(kept) if kept else np.zeros(0, np.int64)
        high, low = np.maximum(one, two), np.minimum(one, two)
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], np.diff(high[order]) > 0])]
        label[high[first]] = low[first]  # a group hangs on a smaller one, once
        kept.append(open_[first])
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
