"""Hierarchical density clusters of vectors of any width, exact.

The mutual reachability of two points is the largest of their distance and their core distances (to the
min_samples-th other point). A minimum spanning tree under it grows by Boruvka rounds: every
component but the largest takes its lightest edge out, which the stored nearest neighbours mostly
know; where they do not, the points that could have a lighter one visit the cells within reach that
hold other components. The tree's edges are then merged in bundles of rising weight, each
connected part of a bundle in one task, into clusters of at least min_cluster_size points with
their stability, and the most stable ones are chosen bottom-up on the way.

All merges at one distance count as one, so equal distances cannot change the result. Copies of a
point are one site with a weight.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .neighbours import connected_components, sites
from .pivots import (
    Blocks, blocks_of, cells_of, choose_pivots, distances, matrix, met, packed, reaching, tiles, with_block, with_cell)
from .similarity import EUCLIDEAN, knn

NOISE = -1
#: Distances are compared after rounding; density at distance 0 counts as at this one.
DIGITS, LEAST = 12, 1e-10
#: Neighbours of a site that are kept, besides those that its core distance takes.
LISTED = 4
#: Edges of the tree that are merged together.
BUNDLE_EDGES = 1_000_000

#: Pairs whose distances are computed in one array.
_PAIRS_AT_ONCE = 1 << 16
_EDGE = "comp long, w double, lo long, hi long, other long"


def _paired(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    apart = matrix(a) - matrix(b)
    return pa.array(np.sqrt(np.einsum("nd,nd->n", apart, apart)))


def core_distances(s: DataFrame, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """(site, core) and the listed neighbours (site, other, distance) of sites (site, vec, weight).

    `core` is the distance to the min_samples-th other point, null where there are fewer.
    """
    rows = s.select(F.col("site").alias("id"), "vec")
    hits = knn(rows, rows, min_samples + LISTED, EUCLIDEAN).select(
        F.col("query_id").alias("site"), F.col("similar_id").alias("other"))
    # Distances as blocks compute them, so that equal ones are equal wherever they come from.
    near = cut_lineage(hits.join(s.select("site", "vec"), "site").join(
        s.select(F.col("site").alias("other"), F.col("vec").alias("there")), "other").select(
        "site", "other", F.round(F.arrow_udf(_paired, "double")("vec", "there"), DIGITS).alias("distance")))
    weights = s.select(F.col("site").alias("other"), F.col("weight").alias("n"))
    own = s.select("site", F.lit(0.0).alias("distance"), (F.col("weight") - 1).alias("n"))
    steps = near.join(weights, "other").select("site", "distance", "n").union(own).groupBy("site").agg(
        F.array_sort(F.collect_list(F.struct("distance", "n"))).alias("steps"))
    # At most min_samples + LISTED + 1 steps per site.
    walk = F.aggregate("steps", F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d")),
                       lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), F.when(
                           a["d"].isNull() & (a["n"] + x["n"] >= min_samples), x["distance"]).otherwise(a["d"]).alias("d")))
    return steps.select("site", walk["d"].alias("core")), near


def _lightest(edges: DataFrame) -> DataFrame:
    """The lightest edge of every component, ties by the ends."""
    return edges.groupBy("comp").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e")).select("comp", "e.*")


def _outward():
    """Of the blocks met, the lightest edge from every asking component to another one."""
    def look(block: int, asks: dict, rights):
        x, site, core, reach = asks["vec"], asks["site"], asks["core"], asks["bound"].copy()
        names, comp = np.unique(asks["comp"], return_inverse=True)
        best: list[tuple | None] = [None] * len(names)
        for _, there in rights:
            y, there_comp = there["vec"], there["comp"]
            for rows, cols in tiles(x, reach, y, there["cell"]):
                same = names[comp[rows]][:, None] == there_comp[cols][None, :]
                if same.all():
                    continue
                w = np.maximum(distances(x[rows], y[cols]), np.maximum(core[rows][:, None], there["core"][cols][None, :]))
                w[same] = np.inf
                slack = 1e-7 * (1.0 + np.sqrt((x[rows] ** 2).sum(1) + (y[cols] ** 2).sum(1).max()))
                i, j = np.nonzero((w <= (np.minimum(w.min(1), reach[rows]) + slack)[:, None]) & np.isfinite(w))
                i, j = rows[i], cols[j]
                for at in range(0, len(i), _PAIRS_AT_ONCE):
                    p, q = i[at:at + _PAIRS_AT_ONCE], j[at:at + _PAIRS_AT_ONCE]
                    apart = x[p] - y[q]
                    gap = np.round(np.sqrt(np.einsum("nd,nd->n", apart, apart)), DIGITS)
                    exact = np.maximum(gap, np.maximum(core[p], there["core"][q]))
                    low, high = np.minimum(site[p], there["site"][q]), np.maximum(site[p], there["site"][q])
                    order = np.lexsort((high, low, exact, comp[p]))
                    first = order[np.concatenate([[True], np.diff(comp[p][order]) > 0])]
                    for e in first:
                        edge = (exact[e], low[e], high[e], there_comp[q[e]])
                        best[comp[p[e]]] = min(edge, best[comp[p[e]]] or edge)
            known = np.array([np.inf if e is None else e[0] for e in best])
            reach = np.minimum(reach, known[comp])
        found = [(n, *e) for n, e in zip(names, best) if e is not None]
        yield dict(zip(("comp", "w", "lo", "hi", "other"), zip(*found))) if found else {
            c: [] for c in ("comp", "w", "lo", "hi", "other")}
    return look


def spanning_tree(s: DataFrame, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """(u, v, w): a minimum spanning tree of the sites under mutual reachability; and (site, core, weight).

    Sites without a core distance (fewer than min_samples other points in all) have none and no edges.
    """
    cores, near = core_distances(s, min_samples)
    known = cut_lineage(s.join(cores, "site").where(F.col("core").isNotNull()).withColumn(
        "core", F.round("core", DIGITS)))
    n = known.count()
    pivots = choose_pivots(known, "site", max(1, n))
    if not len(pivots):
        return cut_lineage(known.selectExpr("site as u", "site as v", "core as w").limit(0)), known.select(
            "site", "core", "weight")
    dealt = cut_lineage(with_cell(known, pivots).select("site", "vec", "core", "cell", "gap"))
    cells = cells_of(dealt, pivots)
    blocks = blocks_of(cells)
    located = cut_lineage(with_block(dealt, blocks, "site"))
    release(dealt)
    core = located.select("site", "core")
    listed = cut_lineage(near.join(core, "site").join(core.toDF("other", "other_core"), "other").select(
        F.col("site").alias("a"), F.col("other").alias("b"),
        F.greatest("distance", "core", "other_core").alias("w")))
    # What is not listed is at least as far as the last that is; a site that lists all has no more to find.
    last = near.groupBy("site").agg(F.max("distance").alias("far"), F.count("*").alias("n_listed"))
    reach = cut_lineage(located.join(last, "site", "left").select("site", F.when(
        F.col("n_listed") >= n - 1, F.lit(float("inf"))).otherwise(
            F.greatest(F.coalesce("far", F.lit(0.0)), "core")).alias("unlisted")))
    comps = cut_lineage(located.select("site", F.col("site").alias("comp")))
    most_core = np.full(len(pivots), np.inf)
    for r in located.groupBy("cell").agg(F.max("core").alias("c")).collect():  # a row per pivot
        most_core[r["cell"]] = r["c"]
    tree: DataFrame | None = None
    old: list[DataFrame] = []
    while True:
        sizes = comps.groupBy("comp").agg(F.count("*").alias("n"))
        largest = sizes.orderBy(F.desc("n"), "comp").first()
        if largest["n"] == n:
            break
        asking = comps.where(F.col("comp") != largest["comp"])
        to = comps.select(F.col("site").alias("b"), F.col("comp").alias("other"))
        seen = cut_lineage(_lightest(
            listed.join(asking.withColumnRenamed("site", "a"), "a").join(to, "b").where("comp <> other").select(
                "comp", "w", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "other")))
        found = _lightest(seen.union(_searched(located, cells, blocks, most_core, comps, asking, seen, reach)))
        picked = cut_lineage(found)
        tree = picked.select("w", "lo", "hi") if tree is None else tree.union(picked.select("w", "lo", "hi"))
        joined = connected_components(picked.select(F.col("comp").alias("u"), F.col("other").alias("v")),
                                      sizes.select(F.col("comp").alias("node")))
        new = cut_lineage(comps.join(joined.withColumnRenamed("node", "comp"), "comp").select(
            "site", F.col("root").alias("comp")))
        release(comps, seen)
        comps = new
        old.append(picked)
    edges = cut_lineage(tree.distinct().select(F.col("lo").alias("u"), F.col("hi").alias("v"), "w") if tree is not None
                        else known.selectExpr("site as u", "site as v", "core as w").limit(0))
    release(comps, reach, listed, located, near, *old)
    return edges, known.select("site", "core", "weight")


def _searched(located: DataFrame, cells, blocks: Blocks, most_core: np.ndarray, comps: DataFrame, asking: DataFrame,
              seen: DataFrame, reach: DataFrame) -> DataFrame:
    """Lightest edges out of components by the sites whose unlisted neighbours could be as near as the edge seen."""
    here = cut_lineage(located.join(comps, "site"))
    # A cell that holds one component alone has nothing for that component; a row per cell.
    none = np.iinfo(np.int64).min
    pure = {r["cell"]: r["low"] for r in here.groupBy("cell").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high")).where("low = high").collect()}
    own = np.array([pure.get(c, none) for c in range(len(cells.pivots))])
    farthest = np.where(cells.rows > 0, np.maximum(cells.radius, 0), np.inf)

    def to_another(vec: pa.Array, core: pa.Array, comp: pa.Array) -> pa.Array:
        # Some site of another component is in each cell that is not the component's alone.
        if not len(vec):
            return pa.array([], pa.float64())
        bound = np.maximum(distances(matrix(vec), cells.pivots) + farthest[None, :], most_core[None, :])
        bound[comp.to_numpy()[:, None] == own[None, :]] = np.inf
        return pa.array(np.maximum(bound.min(1), core.to_numpy()) * (1 + 1e-9) + 1e-6)
    open_ = cut_lineage(
        here.join(asking.select("comp").distinct(), "comp", "left_semi").join(reach, "site")
        .join(seen.select("comp", F.col("w").alias("seen")), "comp", "left")
        .where((F.col("unlisted") < float("inf")) & (F.col("seen").isNull() | (F.col("unlisted") <= F.col("seen")))))
    by_cell = open_.where(F.col("seen").isNull()).select(
        "comp", F.arrow_udf(to_another, "double")("vec", "core", "comp").alias("b")).groupBy("comp").agg(F.min("b").alias("b"))
    bounded = open_.join(by_cell, "comp", "left").withColumn("bound", F.coalesce("seen", "b")).where(
        F.col("unlisted") <= F.col("bound"))
    asks = packed(bounded, blocks.count, ["site", "vec", "core", "comp", "bound"])
    there = packed(here, blocks.count, ["site", "vec", "core", "comp", "cell"])
    visits = reaching(asks, cells, blocks, lambda rows: (rows["vec"], rows["bound"]))
    out = cut_lineage(met(visits, there, _outward(), _EDGE))
    release(asks, there, visits, open_, here)
    return out


# -- condensed tree ---------------------------------------------------------------------------

_EVENT = "kind string, node long, size long, cluster string, parent string, exits double, kids double, chosen boolean"


def _merge(least: int):
    """Merge one connected part of a bundle, edges in rising weight, all of one weight at once.

    Rows out: the node that is left (its open cluster, what has left that, the worth of its
    children), the cluster that each small node without one falls into, and the clusters that end.
    """
    def merge(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        at = {n: k for k, n in enumerate(nodes["node"])}
        above = list(range(len(at)))
        size, cluster = nodes["size"].tolist(), [c if isinstance(c, str) else None for c in nodes["cluster"]]
        exits, kids = nodes["exits"].tolist(), nodes["kids"].tolist()
        names, least_name = nodes["node"].tolist(), nodes["node"].tolist()
        members = [[k] if cluster[k] is None else [] for k in range(len(at))]
        out: list[tuple] = []

        def find(k: int) -> int:
            while above[k] != k:
                above[k] = above[above[k]]
                k = above[k]
            return k

        def settle(parts: list[int], extra: int, w: float) -> None:
            density = 1.0 / max(w, LEAST)
            big = [p for p in parts if cluster[p] is not None]
            root, total = find(parts[0]), sum(size[p] for p in parts) + extra
            first = min(least_name[p] for p in parts)
            loose = [m for p in parts if cluster[p] is None for m in members[p]]
            falling = sum(size[p] for p in parts if cluster[p] is None) + extra
            name, out_mass, worth = None, 0.0, 0.0
            if len(big) == 1:
                name, out_mass, worth = cluster[big[0]], exits[big[0]] + falling * density, kids[big[0]]
            elif big or total >= least:
                name, out_mass = f"{first}@{w!r}", total * density
                for p in sorted(big, key=lambda p: least_name[p]):
                    own = exits[p] - size[p] * density
                    worth += max(own, kids[p])
                    out.append(("end", None, size[p], cluster[p], name, own, kids[p], own >= kids[p]))
            if name is not None:
                out.extend(("label", names[m], None, name, None, None, None, None) for m in loose)
                loose = []
            size[root], cluster[root], exits[root], kids[root] = total, name, out_mass, worth
            members[root], least_name[root] = loose, first

        edges = edges.sort_values("w", kind="stable")
        weights = edges["w"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(weights)) + 1, [len(weights)]])
        ends = [(at[u], at[v], int(x)) for u, v, x in zip(edges["u"], edges["v"], edges["extra"])]
        for start, stop in zip(bounds[:-1], bounds[1:]):
            parts: dict[int, list[int]] = {}
            extra: dict[int, int] = {}
            for u, v, more in ends[start:stop]:
                u, v = find(u), find(v)
                parts.setdefault(u, [u])
                extra[u] = extra.get(u, 0) + more
                if u != v:
                    parts.setdefault(v, [v])
                    above[v] = u
                    parts[u] += parts.pop(v)
                    extra[u] += extra.pop(v, 0)
            for root, own in parts.items():
                settle(own, extra[root], float(weights[start]))
        for k in range(len(at)):
            if find(k) == k:
                out.append(("node", int(nodes["root"].iloc[0]), size[k], cluster[k], None, exits[k], kids[k], None))
        return pd.DataFrame(out, columns=[c.strip().split(" ")[0] for c in _EVENT.split(",")])
    return merge


def condensed(edges: DataFrame, s: DataFrame, min_cluster_size: int) -> tuple[DataFrame, DataFrame]:
    """(site, cluster) and (cluster, parent, chosen) of a spanning tree (u, v, w) of sites (site, core, weight).

    `cluster` is the smallest cluster a site belongs to, null for none; the one all sites end in has no row.
    """
    copies = s.where("weight > 1").select(F.col("site").alias("u"), F.col("site").alias("v"), F.col("core").alias("w"),
                                          (F.col("weight") - 1).alias("extra"))
    every = cut_lineage(edges.select("u", "v", "w", F.lit(0).cast("long").alias("extra")).union(copies))
    n = every.count()
    bundles = max(1, -(-n // BUNDLE_EDGES))
    cuts = every.agg(F.percentile_approx("w", [k / bundles for k in range(1, bundles)], 10_000)).first()[0] if (
        bundles > 1) else []
    cuts = sorted(set(cuts))
    nodes = cut_lineage(s.select(F.col("site").alias("node"), F.lit(1).cast("long").alias("size"),
                                 F.lit(None).cast("string").alias("cluster"), F.lit(0.0).alias("exits"),
                                 F.lit(0.0).alias("kids")))
    owner = cut_lineage(s.select("site", F.col("site").alias("node"), F.lit(None).cast("string").alias("label")))
    ends: DataFrame | None = None
    for k in range(len(cuts) + 1):
        inside = F.lit(True)
        inside = inside & (F.col("w") > cuts[k - 1]) if k else inside
        inside = inside & (F.col("w") <= cuts[k]) if k < len(cuts) else inside
        to = owner.select(F.col("site").alias("_s"), "node")
        now = cut_lineage(every.where(inside).join(to.toDF("u", "nu"), "u").join(to.toDF("v", "nv"), "v").select(
            F.col("nu").alias("u"), F.col("nv").alias("v"), "w", "extra"))
        roots = connected_components(now.select("u", "v"), nodes.select("node"))
        touched = now.join(roots.withColumnRenamed("node", "u"), "u")
        touched = touched.select(F.col("root").alias("part"), "u", "v", "w", "extra")
        part = touched.select("part").distinct()
        placed = nodes.join(roots, "node")
        own = placed.join(part, F.col("root") == F.col("part"), "left_semi").select(
            "root", "node", "size", "cluster", "exits", "kids")
        events = cut_lineage(own.groupBy("root").cogroup(touched.groupBy("part")).applyInPandas(
            _merge(min_cluster_size), _EVENT))
        labels = events.where("kind = 'label'").select("node", F.col("cluster").alias("new"))
        moved = roots.select("node", "root")
        then = cut_lineage(owner.join(labels, "node", "left").join(moved, "node").select(
            "site", F.col("root").alias("node"), F.coalesce("label", "new").alias("label")))
        rest = placed.join(part, F.col("root") == F.col("part"), "left_anti").select(
            "node", "size", "cluster", "exits", "kids")
        left = cut_lineage(rest.union(events.where("kind = 'node'").select("node", "size", "cluster", "exits", "kids")))
        release(owner, nodes, now)
        owner, nodes = then, left
        over = events.where("kind = 'end'").select("cluster", "parent", "chosen")
        ends = over if ends is None else ends.union(over)
    release(every)
    return owner.select("site", F.col("label").alias("cluster")), ends


def topmost(clusters: DataFrame) -> DataFrame:
    """(cluster, top): the highest chosen cluster on the way up from each; ways are doubled each round."""
    now = cut_lineage(clusters.select("cluster", F.col("parent").alias("up"),
                                      F.when(F.col("chosen"), F.col("cluster")).alias("top")))
    while not now.where("up is not null").isEmpty():
        above = now.select(F.col("cluster").alias("up"), F.col("up").alias("further"), F.col("top").alias("higher"))
        then = cut_lineage(now.join(above, "up", "left").select(
            "cluster", F.col("further").alias("up"), F.coalesce("higher", "top").alias("top")))
        release(now)
        now = then
    return now.select("cluster", "top")


def hdbscan(points: DataFrame, id_col: str, min_cluster_size: int = 10, min_samples: int = 5,
            vec: str = "vec") -> DataFrame:
    """(id, cluster_id): the most stable density clusters, -1 = noise.

    A cluster is named by the smallest id of its points. Where no two clusters ever part, all points are noise.
    """
    found = cut_lineage(sites(points, id_col, vec))
    edges, rows = spanning_tree(found, min_samples)
    rows = cut_lineage(rows)
    member, clusters = condensed(edges, rows, min_cluster_size)
    named = member.join(topmost(clusters), "cluster").where("top is not null").select("site", "top")
    least = named.groupBy("top").agg(F.min("site").alias("cluster_id"))
    labels = cut_lineage(found.select("site", F.col("vec").alias(vec)).join(named.join(least, "top"), "site", "left").select(
        vec, F.coalesce("cluster_id", F.lit(NOISE)).cast("bigint").alias("cluster_id")))
    release(rows, edges, found)
    return points.select(id_col, vec).join(labels, vec).select(id_col, "cluster_id")
