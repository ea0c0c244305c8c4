"""Embedding near-duplicates through an inverted multi-index.

The two halves of the unit vectors have a codebook each; the pair of nearest codewords is a cell of
a product grid, and every vector is listed in its cell. A search visits the cells in the order of
the sum of their two half distances (the multi-sequence order) until the number of cells that
reached the target recall for a sample of queries compared with all rows. Every candidate is then
verified by its cosine in double precision.

The codebooks are fitted on a bounded sample; every row is indexed. Cells
are processed in blocks of at most `CELL_BLOCK` listed vectors by `QUERY_BLOCK` searching ones, so
a crowded cell becomes many tasks and no task holds more than one block of listed vectors. Only
counts and spanning edges leave a task, never the pairs.

Edge cases: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components have no links and are kept. Equal vectors are one site with a weight, so
copies are never paired out. Rows that repeat a vec_id count as further vectors with that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.session import cut_lineage, release

from .common import components
from .simhash import merge_labels

THRESHOLD = 0.9
TARGET_RECALL = 0.98
#: Bounds of the fit: vectors for the codebooks, and queries compared with all rows for the visits.
FIT_ROWS = 20_000
FIT_QUERIES = 1_000
#: Vectors per cell aimed at, and the most codewords of one half.
ROWS_PER_CELL = 8
MOST_CODEWORDS = 1_024
LEAST_VISITS, MOST_VISITS = 4, 64
#: Links among the sampled queries below which the visits also rest on perturbed queries.
ENOUGH_LINKS = 200
CELL_BLOCK = 2_048
QUERY_BLOCK = 16_384


def unit_vectors(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def kmeans(points: np.ndarray, k: int, steps: int = 12, seed: int = 1) -> np.ndarray:
    """`k` codewords at most; points are first drawn at random, empty codewords stay where they are."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centers = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(steps):
        nearest = np.concatenate([half_distances(p, centers).argmin(axis=1)
                                  for p in np.array_split(points, -(-len(points) // 4_096))])
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centers))
        filled = counts > 0
        centers[filled] = sums[filled] / counts[filled, None]
    return centers


def half_distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances between rows."""
    d = (points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)
    return np.maximum(d, 0)


def multi_sequence(left: np.ndarray, right: np.ndarray, visits: int) -> np.ndarray:
    """The `visits` cells nearest to each query, in the multi-sequence order of their distance sums.

    A cell at ranks (i, j) has (i + 1)(j + 1) - 1 cells before it, so only ranks with
    (i + 1)(j + 1) <= visits can be among them: the staircase that the traversal's queue walks.
    """
    width = right.shape[1]
    visits = min(visits, left.shape[1] * width)
    by_left = np.argsort(left, axis=1, kind="stable")[:, :visits]
    by_right = np.argsort(right, axis=1, kind="stable")[:, :visits]
    d_left = np.take_along_axis(left, by_left, axis=1)
    d_right = np.take_along_axis(right, by_right, axis=1)
    steps = [(i, j) for i in range(by_left.shape[1]) for j in range(by_right.shape[1])
             if (i + 1) * (j + 1) <= visits]
    i, j = (np.array(x) for x in zip(*steps))
    order = np.argsort(d_left[:, i] + d_right[:, j], axis=1, kind="stable")[:, :visits]
    return (np.take_along_axis(by_left[:, i], order, axis=1).astype(np.int64) * width
            + np.take_along_axis(by_right[:, j], order, axis=1))


class MultiIndex:
    """Two codebooks, and the number of cells that a search visits."""

    def __init__(self, sample: np.ndarray, rows: int):
        k = int(min(MOST_CODEWORDS, max(2, np.sqrt(rows / ROWS_PER_CELL))))
        self.half, self.visits, self.recall = sample.shape[1] // 2, LEAST_VISITS, None
        self.books = [kmeans(sample[:, :self.half], k, seed=1), kmeans(sample[:, self.half:], k, seed=2)]

    def cells(self, vectors: np.ndarray, visits: int) -> np.ndarray:
        """Cells to visit, nearest first; the first one is the vector's own."""
        return np.concatenate([multi_sequence(half_distances(part[:, :self.half], self.books[0]),
                                              half_distances(part[:, self.half:], self.books[1]), visits)
                               for part in np.array_split(vectors, -(-len(vectors) // 1_024))])

    def settle(self, reached: dict[int, int]) -> None:
        """Visit as many cells as reach the target recall; `reached` counts links by the rank of their cell."""
        total = sum(reached.values())
        if not total:
            return  # no link to go by
        ranks = sorted(reached)
        below = np.cumsum([reached[r] for r in ranks])
        need = ranks[int(np.searchsorted(below, TARGET_RECALL * total))]
        self.visits = min(max(need, LEAST_VISITS), MOST_VISITS)
        self.recall = sum(n for r, n in reached.items() if r <= self.visits) / total

    def perturbed(self, vectors: np.ndarray, threshold: float) -> dict[int, int]:
        """Made-up links at the threshold cosine, counted by the rank at which either side meets the other's cell."""
        noise = np.random.default_rng(3).normal(size=vectors.shape)
        noise -= (noise * vectors).sum(axis=1, keepdims=True) * vectors
        if vectors.shape[1] < 2 or not len(vectors):
            return {}
        partners = threshold * vectors + np.sqrt(max(0.0, 1 - threshold**2)) * unit_vectors(noise)
        orders = self.cells(vectors, MOST_VISITS), self.cells(partners, MOST_VISITS)
        ranks = []
        for order, other in (orders, orders[::-1]):
            met = order == other[:, :1]
            ranks.append(np.where(met.any(axis=1), met.argmax(axis=1) + 1, MOST_VISITS + 1))
        found, n = np.unique(np.minimum(*ranks), return_counts=True)
        return dict(zip(found.tolist(), n.tolist()))

    def compare_all(self) -> None:
        """One cell for all vectors: its blocks compare every pair."""
        self.books, self.visits, self.recall = [b[:1] for b in self.books], 1, 1.0


def sites(embeddings: DataFrame) -> DataFrame:
    """(site, embedding, copies): distinct usable vectors, `site` the smallest vec_id of each."""
    usable = F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND NOT exists(embedding, x -> x IS NULL "
                    "OR isnan(x) OR abs(x) = double('Infinity')) AND exists(embedding, x -> x <> 0)")
    return (embeddings.where(usable)
            .groupBy("embedding").agg(F.min("vec_id").alias("site"), F.count("*").alias("copies"))
            .where("site IS NOT NULL"))


def _ranks(index: MultiIndex, query_ids: np.ndarray, queries: np.ndarray, threshold: float):
    """(rank, n): links of the queries with the rows, counted by the rank at which the query meets their cell."""
    order = index.cells(queries, MOST_VISITS)

    def ranks(batches):
        counts = np.zeros(order.shape[1] + 2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("site").to_numpy()
            vectors = unit_vectors(np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)).astype(np.float64))
            own = index.cells(vectors, 1)[:, 0]
            for at in range(0, len(ids), 1_024):
                row, query = np.nonzero(vectors[at:at + 1_024] @ queries.T >= threshold)
                other = ids[at + row] != query_ids[query]
                met = own[at + row[other], None] == order[query[other]]
                counts += np.bincount(np.where(met.any(axis=1), met.argmax(axis=1) + 1, order.shape[1] + 1),
                                      minlength=len(counts))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["rank", "n"])
    return ranks


def fit_index(rows: DataFrame, n: int, threshold: float) -> MultiIndex | None:
    """Codebooks from about FIT_ROWS vectors; visits from FIT_QUERIES of them compared with all rows.

    The sample is drawn by a hash of the id. The queries' links with every row are found by brute
    force; only their number by rank comes back, so `recall` is that of the whole table.
    """
    share = min(1.0, FIT_ROWS / max(1, n))
    drawn = rows.where(F.pmod(F.xxhash64("site", F.lit("fit")), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = drawn.orderBy(F.xxhash64("site")).select("site", "embedding").collect()
    if not sample:
        return None
    ids = np.array([r.site for r in sample])
    vectors = unit_vectors(np.array([r.embedding for r in sample], dtype=np.float64))
    index = MultiIndex(vectors, n)
    counted = (rows.select("site", "embedding").mapInArrow(
        _ranks(index, ids[:FIT_QUERIES], vectors[:FIT_QUERIES], threshold), "rank long, n long")
        .groupBy("rank").agg(F.sum("n").alias("n")).collect())  # a row per rank
    reached = {r.rank: r.n for r in counted}
    index.settle(reached)
    if sum(reached.values()) < ENOUGH_LINKS:
        visits, recall = index.visits, index.recall
        index.settle(index.perturbed(vectors[:FIT_QUERIES], threshold))
        index.visits = max(visits, index.visits)
        index.recall = min((r for r in (recall, index.recall) if r is not None), default=None)
    if index.recall is not None and index.recall < TARGET_RECALL:
        index.compare_all()  # the most visits are not enough
    return index


def _listed(index: MultiIndex):
    """Each vector once as listed (role 0, own cell) and once per visited cell as searching (role 1)."""
    def listed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False))
            order = index.cells(unit_vectors(raw.astype(np.float64)), index.visits)
            n, visits = order.shape
            cell = np.concatenate([order[:, 0], order.ravel()])
            rows = np.concatenate([np.arange(n), np.repeat(np.arange(n), visits)])
            role = np.concatenate([np.zeros(n, np.int32), np.ones(n * visits, np.int32)])
            picked = batch.select(["site", "copies", "embedding"]).take(pa.array(rows))
            offsets = pa.array(np.arange(0, (n * visits + n) * visits + 1, visits, dtype=np.int32))
            ways = pa.ListArray.from_arrays(offsets, pa.array(order[rows].ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(role), *picked.columns, ways],
                ["cell", "role", "site", "copies", "embedding", "visited"])
    return listed


def _searched(threshold: float):
    """Per block: how many vectors each site is linked with, and edges that span the linked ones.

    Rows come sorted by block and role: the listed vectors of a block are held, then the searching
    ones pass in batches. A link that only one of the two sides visits counts for both at once; one
    that both visit counts for the side that is searching.
    """
    def searched(batches):
        block, held = None, []

        def results(kind, sites_, values):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sites_), kind, np.int32)), pa.array(sites_), pa.array(values)],
                ["kind", "site", "value"])

        def search(queries):
            base = [np.concatenate(c) for c in zip(*held)]
            cell = int(block[0])
            for lo in range(0, len(queries[0]), 1_024):
                q_site, q_copies, q_vec, q_visited, q_own = (c[lo:lo + 1_024] for c in queries)
                q, b = np.nonzero(q_vec @ base[2].T >= threshold)
                apart = q_site[q] != base[0][b]
                q, b = q[apart], b[apart]
                if not len(q):
                    continue
                # The listed side finds this link itself if it visits the searching side's own cell.
                mutual = (base[3][b] == q_own[q][:, None]).any(axis=1)
                counts = np.bincount(q, base[1][b], minlength=len(q_site)).astype(np.int64)
                back = np.bincount(b[~mutual], q_copies[q[~mutual]], minlength=len(base[0])).astype(np.int64)
                ids = np.concatenate([q_site, base[0]])
                labels = np.arange(len(ids))
                merge_labels(labels, q, b + len(q_site))
                linked = np.flatnonzero(labels != np.arange(len(ids)))
                yield results(0, q_site[counts > 0], counts[counts > 0])
                yield results(0, base[0][back > 0], back[back > 0])
                yield results(1, ids[linked], ids[labels[linked]])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "part", "turn")], axis=1)
            role = batch.column("role").to_numpy()
            vectors = unit_vectors(np.stack(
                batch.column("embedding").to_numpy(zero_copy_only=False)).astype(np.float64))
            visited = np.stack(batch.column("visited").to_numpy(zero_copy_only=False))
            columns = [batch.column("site").to_numpy(), batch.column("copies").to_numpy(), vectors, visited,
                       visited[:, 0]]
            change = np.any(keys[1:] != keys[:-1], axis=1) | (role[1:] != role[:-1])
            edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(role)]])
            for a, z in zip(edges[:-1], edges[1:]):
                if block is None or (keys[a] != block).any():
                    block, held = keys[a], []
                part = [c[a:z] for c in columns]
                if role[a] == 0:
                    held.append(part)
                elif held:
                    yield from search(part)
    return searched


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows dealt to blocks (cell, part of the listed, turn of the searching vectors) of bounded size."""
    sizes = rows.groupBy("cell").agg(
        F.sum(F.when(F.col("role") == 0, 1).otherwise(0)).alias("base"),
        F.sum("role").alias("queries")).where("base > 0").select(
        "cell", F.ceil(F.col("base") / CELL_BLOCK).cast("int").alias("parts"),
        F.ceil(F.col("queries") / QUERY_BLOCK).cast("int").alias("turns"))
    sized = rows.join(sizes, "cell")

    def own(count, salt):
        return F.array(F.pmod(F.xxhash64("site", F.lit(salt)), F.col(count)).cast("int"))

    def every(count):
        return F.sequence(F.lit(0), F.col(count) - 1)

    listed = F.col("role") == 0
    return (sized.withColumn("part", F.explode(F.when(listed, own("parts", "part")).otherwise(every("parts"))))
            .withColumn("turn", F.explode(F.when(listed, every("turns")).otherwise(own("turns", "turn"))))
            .drop("parts", "turns"))


def _found(rows: DataFrame, n: int, threshold: float, element: str) -> DataFrame:
    """(kind, site, value) of `_searched` for the vectors of one width."""
    index = fit_index(rows, n, threshold)
    spread = rows.select("site", "copies", "embedding").mapInArrow(
        _listed(index), f"cell long, role int, site long, copies long, embedding {element}, visited array<long>")
    stored = cut_lineage(spread)
    found = cut_lineage(
        _blocks(stored).repartition("cell", "part", "turn").sortWithinPartitions("cell", "part", "turn", "role")
        .mapInArrow(_searched(threshold), "kind int, site long, value long"))
    release(stored)
    return found


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `embeddings` (vec_id, embedding)."""
    rows = cut_lineage(sites(embeddings))
    element = embeddings.schema["embedding"].dataType.simpleString()
    found = embeddings.sparkSession.createDataFrame([], "kind int, site long, value long")
    # Vectors of different widths have no cosine; each width has an index of its own.
    for width in rows.groupBy(F.size("embedding").alias("w")).count().where("count > 1").orderBy("w").collect():
        found = found.union(_found(rows.where(F.size("embedding") == width.w), width["count"], threshold, element))
    counts = found.where("kind = 0").groupBy("site").agg(F.sum("value").alias("others"))
    groups = components(found.where("kind = 1").select(F.col("site").alias("a"), F.col("value").alias("b")))
    named = (rows.select("site", "copies", "embedding").join(counts, "site", "left")
             .join(groups.withColumnRenamed("node", "site"), "site", "left")
             .select("embedding", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "site").alias("component_id")))
    return (embeddings.select("vec_id", "embedding").join(named, "embedding", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
