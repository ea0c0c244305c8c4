"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints within two bits agree exactly in at least two of four 16-bit blocks, so each
fingerprint is indexed under the six masks that show two blocks. A mask's pattern is the upper node
all its fingerprints share. Below it they are sorted by Gray rank, where neighbours differ in few
bits, and runs of them become nodes that hold the bits common to the run (factored: only bits that
no upper node already holds). A search adds up the differing bits from the top and drops a whole
group once the sum exceeds the radius.

Edge cases: a null or empty text, or one of white space only, has fingerprint zero and is linked
like any other. Fewer than three words are one shingle. Rows that repeat a doc_id are fingerprinted
each on their own; a null doc_id joins its component but never names it unless all ids are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.session import cut_lineage

from .common import components, on_row_key, utf8, with_row_key

RADIUS = 2
BLOCKS = 4
FAN_OUT = 8
QUERIES_AT_ONCE = 2_048
FLUSH_ROWS = 200_000
#: For each byte value, its eight bits, least significant first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def text_fingerprint(text: bytes | None) -> int:
    """Majority bits of the XXH64 values (seed 42) of all three-word shingles, repeats included."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = (map(b"%b %b %b".__mod__, zip(words, words[1:], words[2:]))
                if len(words) > 2 else [b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64, max(1, len(words) - 2))
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ BYTE_BITS for k in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprint(texts: pa.Array) -> pa.Array:
    values = np.fromiter((text_fingerprint(t) for t in utf8(texts)), np.uint64, len(texts))
    return pa.array(values.view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` with the long `fingerprint`."""
    return docs.withColumn("fingerprint", F.arrow_udf(_fingerprint, "long")("text"))


def gray_rank(code: Column) -> Column:
    """Position of a 64-bit code in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _masked(prints: DataFrame) -> DataFrame:
    """A row per fingerprint and mask: the two shown blocks moved to the top, then the Gray rank."""
    width = 64 // BLOCKS
    fp = F.col("fingerprint")
    rows = []
    for m, shown in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS)):
        order = [*shown, *(b for b in range(BLOCKS) if b not in shown)]
        code = F.lit(0).cast("long")
        for place, block in enumerate(order):
            part = F.shiftrightunsigned(fp, width * block).bitwiseAND(F.lit((1 << width) - 1))
            code = code.bitwiseOR(F.shiftleft(part, width * (BLOCKS - 1 - place)))
        rows.append(F.struct(F.lit(m).cast("int").alias("mask"), code.alias("code")))
    spread = prints.select("fingerprint", F.explode(F.array(*rows)).alias("r"))
    ranked = spread.select("fingerprint", "r.mask", gray_rank(F.col("r.code")).alias("rank"))
    return ranked.withColumn("top", F.shiftrightunsigned("rank", 32))


class GrayTree:
    """Nodes over codes sorted by Gray rank; level 0 holds the codes, the last level the fewest nodes."""

    def __init__(self, codes: np.ndarray):
        full = np.uint64(2**64 - 1)
        self.levels = [(codes, np.full(len(codes), full))]
        while len(self.levels[-1][0]) > FAN_OUT:
            pattern, shared = self.levels[-1]
            starts = np.arange(0, len(pattern), FAN_OUT)
            first = np.repeat(pattern[starts], FAN_OUT)[:len(pattern)]
            varies = np.bitwise_or.reduceat(~shared | (pattern ^ first), starts)
            self.levels.append((pattern[starts], ~varies))
        # Each node keeps only the common bits that its parent does not hold.
        self.own = []
        for k, (_, shared) in enumerate(self.levels):
            if k + 1 < len(self.levels):
                above = np.repeat(self.levels[k + 1][1], FAN_OUT)[:len(shared)]
                self.own.append(shared & ~above)
            else:
                self.own.append(shared)

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, code position) of all codes within `radius` bits that agree in the top half."""
        top = len(self.levels) - 1
        roots = len(self.levels[top][0])
        q = np.repeat(np.arange(len(queries)), roots)
        node = np.tile(np.arange(roots), len(queries))
        spent = np.zeros(len(q), np.int64)
        for k in range(top, -1, -1):
            differs = (queries[q] ^ self.levels[k][0][node]) & self.own[k][node]
            spent = spent + np.bitwise_count(differs)
            near = (spent <= radius) & (differs >> np.uint64(32) == 0)
            q, node, spent = q[near], node[near], spent[near]
            if k:
                size = len(self.levels[k - 1][0])
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                q, spent = np.repeat(q, FAN_OUT), np.repeat(spent, FAN_OUT)
                inside = node < size
                q, node, spent = q[inside], node[inside], spent[inside]
        return q, node


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked positions one label, the smallest of their group; labels point to positions."""
    while True:
        root_a, root_b = labels[a], labels[b]
        apart = root_a != root_b
        if not apart.any():
            return
        a, b, root_a, root_b = a[apart], b[apart], root_a[apart], root_b[apart]
        np.minimum.at(labels, np.maximum(root_a, root_b), np.minimum(root_a, root_b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def _forest(mask: np.ndarray, rank: np.ndarray, prints: np.ndarray):
    """Edges that span each group of linked fingerprints; rows are sorted by mask and rank."""
    same = (mask[1:] == mask[:-1]) & (rank[1:] >> np.uint64(32) == rank[:-1] >> np.uint64(32))
    company = np.zeros(len(mask), bool)
    company[1:] |= same
    company[:-1] |= same
    for m in np.unique(mask[company]):
        rows = np.flatnonzero(company & (mask == m))
        codes = rank[rows] ^ (rank[rows] >> np.uint64(1))  # the code with this Gray rank
        tree, labels = GrayTree(codes), np.arange(len(rows))
        for at in range(0, len(rows), QUERIES_AT_ONCE):
            q, found = tree.search(codes[at:at + QUERIES_AT_ONCE], RADIUS)
            merge_labels(labels, q + at, found)
        linked = np.flatnonzero(labels != np.arange(len(rows)))
        yield prints[rows[linked]], prints[rows[labels[linked]]]


def _search_sorted(batches):
    """Read rows sorted by mask and Gray rank; search whenever enough whole patterns are at hand."""
    held: list[list[np.ndarray]] = []

    def searched(columns):
        mask, rank, prints = columns
        for a, b in _forest(mask, rank, prints):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        held.append([batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64),
                     batch.column(2).to_numpy()])
        if sum(len(h[0]) for h in held) >= FLUSH_ROWS:
            mask, rank, prints = (np.concatenate(c) for c in zip(*held))
            new = np.flatnonzero((mask[1:] != mask[:-1])
                                 | (rank[1:] >> np.uint64(32) != rank[:-1] >> np.uint64(32)))
            cut = int(new[-1]) + 1 if len(new) else 0
            if cut:
                yield from searched((mask[:cut], rank[:cut], prints[:cut]))
            held = [[mask[cut:], rank[cut:], prints[cut:]]]
    if held:
        yield from searched(tuple(np.concatenate(c) for c in zip(*held)))


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join exactly the groups linked at two bits or fewer.

    A task holds the fingerprints that agree in 32 bits; of a pattern only spanning edges leave it.
    """
    masked = _masked(prints.select("fingerprint").distinct())
    return (masked.repartition("mask", "top").sortWithinPartitions("mask", "top", "rank")
            .select("mask", "rank", "fingerprint").mapInArrow(_search_sorted, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, __text_key, fingerprint, component_id, keep_key) per row of `docs`.

    `component_id` is the smallest doc_id reachable, `keep_key` the __text_key of the row to keep.
    """
    prints = cut_lineage(fingerprints(with_row_key(docs)).select("doc_id", "__text_key", "fingerprint"))
    return _named(prints, "fingerprint", links(prints))


def _named(prints: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """`prints` with the component_id and keep_key of the group that `edges` put their `node` in."""
    groups = cut_lineage(prints.groupBy(node).agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "__text_key"))).alias("first"),
        F.min("__text_key").alias("any_key")))
    named = components(edges).withColumnRenamed("node", node)
    placed = groups.join(named, node, "left").withColumn("component", F.coalesce("component", node))
    heads = placed.groupBy("component").agg(F.min("first").alias("head"), F.min("any_key").alias("any_key"))
    # One row per node goes back to the documents; groups of any size are joined, not gathered.
    names = placed.select(node, "component").join(heads, "component").select(
        node, F.col("head.doc_id").alias("component_id"),
        F.coalesce("head.__text_key", "any_key").alias("keep_key"))
    return prints.join(names, node)


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with the first row of every component; of equal rows one stays."""
    keep = (near_duplicates(docs)
            .where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("__text_key") == F.col("keep_key")))
            .select("doc_id", "__text_key").distinct())
    joined = with_row_key(docs).alias("d").join(keep.alias("k"), on_row_key("d", "k"), "left_semi")
    return joined.dropDuplicates(["doc_id", "__text_key"]).drop("__text_key")
