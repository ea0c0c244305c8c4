"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask reads some of the tokens of a window and ignores the others, so a window still matches when
tokens at ignored places were substituted. Hashes of all masked windows of the benchmark meet those
of the documents in a hash join; around each hit the tokens left and right are compared one by one
along the same alignment. Matching positions closer than `MAX_GAP` form an overlap, which counts
when it is at least `MIN_TOKENS` long (or as long as the item) and `MIN_SHARE` of it matches.

Tokens are runs of letters and digits, in small letters. Items that are equal in tokens are one.
Items shorter than `SPAN` tokens cannot be told from common phrases and are not searched for.

Edge cases: null or empty texts have no tokens. Rows that repeat a doc_id are searched each; one
pair of document and item is reported per row. An empty benchmark finds nothing. Windows of fewer
than `MIN_DISTINCT` different tokens say nothing about an origin and are no seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import on_row_key, with_row_key

SPAN = 10
#: Places of a window that each mask reads; the others are ignored.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 7, 8), (0, 2, 3, 5, 8, 9), (0, 1, 4, 6, 7, 9))
#: Tokens compared on either side of a seed window.
MARGIN = 8
MIN_TOKENS = 13
MIN_SHARE = 0.8
MAX_GAP = 3
MIN_DISTINCT = 4
#: Seeds of one broadcast block: about 250 bytes each. A larger benchmark takes several passes.
SEEDS_PER_BLOCK = 200_000
CONTEXT = SPAN + 2 * MARGIN


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _marks(df: DataFrame) -> DataFrame:
    """`df` with `marks`: a 32-bit hash per token."""
    return df.withColumn("marks", F.transform(tokens(F.col("text")), lambda t: F.hash(t)))


def _windows(df: DataFrame) -> DataFrame:
    """A row per window and mask: `at` and `seed`; the marks stay beside them."""
    placed = df.where(F.size("marks") >= SPAN).withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.size("marks") - SPAN)))
    seeds = [F.xxhash64(F.lit(m), *[F.get("marks", F.col("at") + p) for p in mask])
             for m, mask in enumerate(MASKS)]
    return placed.withColumn("seed", F.explode(F.array(*seeds)))


def seed_table(benchmark: DataFrame) -> DataFrame:
    """(seed, item_id, item_at, context, item_tokens): distinct masked windows of the benchmark.

    `context` holds the marks of the window and MARGIN more on both sides, null beyond the item. Of
    a window that recurs within its item the first place is kept: every place of a document it
    matches is then still found, once.
    """
    # Rows equal in tokens are one item: copies would only repeat every hit.
    items = (_marks(benchmark.select("item_id", "text")).groupBy("marks")
             .agg(F.min("item_id").alias("item_id")))
    context = F.array(*[F.when(F.col("at") + k >= MARGIN, F.get("marks", F.col("at") + (k - MARGIN)))
                        for k in range(CONTEXT)])
    rows = _windows(items).select("seed", "item_id", F.col("at").alias("item_at"),
                                  context.alias("context"), F.size("marks").alias("item_tokens"))
    varied = F.size(F.array_distinct(F.slice("context", MARGIN + 1, SPAN))) >= MIN_DISTINCT
    return rows.where(varied).groupBy("seed", "item_id", "item_tokens").agg(
        F.min(F.struct("item_at", "context")).alias("s")).select(
        "seed", "item_id", "item_tokens", "s.item_at", "s.context")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps: doc_id, __text_key, item_id, start, end (tokens of the document), matched."""
    # Made anew for each block, which costs little beside the block's pass over the documents. Stored, it
    # would stay behind, since the result is not read yet, and on local disks each file starts a process.
    seeds = seed_table(benchmark)
    blocks = max(1, -(-seeds.count() // SEEDS_PER_BLOCK))
    marked = _windows(_marks(with_row_key(docs)).select("doc_id", "__text_key", "marks"))
    found = None
    for block in range(blocks):
        part = seeds.where(F.pmod("seed", F.lit(blocks)) == block)
        # At most about SEEDS_PER_BLOCK rows of a fixed width.
        hits = marked.join(F.broadcast(part), "seed")
        same = F.array(*[F.when(F.get("marks", F.col("at") + (k - MARGIN)) == F.get("context", F.lit(k)),
                                F.col("at") + (k - MARGIN)) for k in range(CONTEXT)])
        rows = hits.select("doc_id", "__text_key", "item_id", "item_tokens",
                           (F.col("at") - F.col("item_at")).alias("shift"),
                           F.explode(F.array_compact(same)).alias("token"))
        found = rows if found is None else found.union(rows)
    # A matched token counts once however many seeds reached it; bounded by the document's length.
    line = ["doc_id", "__text_key", "item_id", "item_tokens", "shift"]
    along = Window.partitionBy(*line).orderBy("token")
    matched = found.groupBy(*line, "token").agg(F.lit(1).alias("one"))
    parted = matched.withColumn("new", F.when(
        F.col("token") - F.lag("token").over(along) <= MAX_GAP, 0).otherwise(1))
    runs = (parted.withColumn("run", F.sum("new").over(along)).groupBy(*line, "run")
            .agg(F.min("token").alias("start"), (F.max("token") + 1).alias("end"),
                 F.count("*").alias("matched")))
    length = F.col("end") - F.col("start")
    verified = runs.where((length >= F.least(F.lit(MIN_TOKENS), "item_tokens"))
                          & (F.col("matched") >= length * MIN_SHARE))
    return verified.select("doc_id", "__text_key", "item_id", "start", "end", "matched")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, __text_key, item_id, n_overlaps, longest, matched): documents that hold part of an item."""
    return overlaps(docs, benchmark).groupBy("doc_id", "__text_key", "item_id").agg(
        F.count("*").alias("n_overlaps"), F.max(F.col("end") - F.col("start")).cast("long").alias("longest"),
        F.sum("matched").alias("matched"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows whose text overlaps a benchmark item."""
    bad = contaminated(docs, benchmark).select("doc_id", "__text_key").distinct()
    return (with_row_key(docs).alias("d").join(bad.alias("b"), on_row_key("d", "b"), "left_anti")
            .drop("__text_key"))
