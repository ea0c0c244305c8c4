"""Resharding by minimum-cost flow: the fewest bytes move from old shards into new capacities.

The flow runs on the shards alone (their number is a parameter, never the data): an arc from every
old shard to every new one, free where the number stays, one per byte where it changes. Its amounts
become ranges of bytes within each old shard, and a document follows the range that holds its middle.

Positions are prefix sums in two steps. Documents fall into blocks by a hash, blocks are summed,
their starts are running sums of block totals, and a document's place within its block is a
window over that block. So a shard with a third of all rows is spread over its blocks.

Edge cases: a null text has no bytes; every document adds `ROW_BYTES`. A null old shard counts as
shard 0. Rows that repeat a doc_id are placed each. An empty table gives an empty plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.session import cut_lineage, delete

ROW_BYTES = 16
#: Documents of a block, on average.
BLOCK_ROWS = 4_096


def sized(docs: DataFrame, old_shard) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard) of `docs`; `old_shard` is an integer column."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       F.coalesce(old_shard, F.lit(0)).cast("int").alias("old_shard"))


def even_capacities(total: int, shards: int) -> list[int]:
    """`total` split evenly, the larger parts first."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def min_cost_transfers(supply: dict[int, int], capacity: list[int]) -> list[tuple[int, int, int]]:
    """(old, new, bytes): the cheapest flow that empties `supply` into `capacity`.

    Successive cheapest paths with node potentials left out: the graph has one node per shard, and
    Bellman-Ford over its residual arcs finds the cheapest path; lower shard numbers win ties.
    """
    if sum(supply.values()) > sum(capacity):
        raise ValueError("the new capacities hold less than the old shards")
    olds, news = sorted(supply), range(len(capacity))
    left, room = dict(supply), list(capacity)
    flow: dict[tuple[int, int], int] = {}
    price = {(i, j): int(i != j) for i in olds for j in news}
    while any(left.values()):
        cost = {("old", i): (0 if left[i] else None) for i in olds} | {("new", j): None for j in news}
        came: dict = {}
        changed = True
        while changed:
            changed = False
            for (i, j), p in price.items():
                here, there = cost["old", i], cost["new", j]
                if here is not None and (there is None or here + p < there):
                    cost["new", j], came["new", j], changed = here + p, ("old", i), True
                elif there is not None and flow.get((i, j)) and (here is None or there - p < here):
                    cost["old", i], came["old", i], changed = there - p, ("new", j), True
        end = min((c, node[1]) for node, c in cost.items() if node[0] == "new" and c is not None
                  and room[node[1]])[1]
        path, node = [], ("new", end)
        while node in came:
            path.append((came[node], node))
            node = came[node]
        amount = min([left[node[1]], room[end]]
                     + [flow[b[1], a[1]] for a, b in path if a[0] == "new"])
        for a, b in path:
            arc = (a[1], b[1]) if a[0] == "old" else (b[1], a[1])
            flow[arc] = flow.get(arc, 0) + (amount if a[0] == "old" else -amount)
        left[node[1]] -= amount
        room[end] -= amount
    return [(i, j, n) for (i, j), n in sorted(flow.items()) if n]


def _with_starts(rows: DataFrame, totals: DataFrame, keys: list[str], by: list[str], amount: str,
                 name: str) -> DataFrame:
    """`rows` with `name`: the sum of `amount` over all blocks before theirs, within `by`."""
    before = Window.partitionBy(*by).orderBy(*[k for k in keys if k not in by]).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum(amount).over(before), F.lit(0)).alias(name))
    return rows.join(starts, keys)


def plan(documents: DataFrame, shards: int, capacities: list[int] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) for rows of `sized`.

    `capacities` (bytes of each new shard) default to equal parts; a shard then holds its part give
    or take the documents that straddle its ends. Slots count from 0 in each new shard.
    """
    rows = cut_lineage(documents)
    old = {r.old_shard: r for r in rows.groupBy("old_shard").agg(
        F.sum("size").alias("size"), F.count("*").alias("n")).collect()}  # a row per old shard
    supply = {k: r["size"] for k, r in old.items()}
    capacities = capacities or even_capacities(sum(supply.values()), shards)
    ranges, reached = [], {}
    for i, j, n in sorted(min_cost_transfers(supply, capacities), key=lambda t: (t[0], t[0] != t[1], t[1])):
        ranges.append((i, reached.get(i, 0), reached.get(i, 0) + n, j))
        reached[i] = reached.get(i, 0) + n
    spark = rows.sparkSession
    targets = spark.createDataFrame(ranges, "old_shard int, low long, high long, shard int")

    blocks = max(1, sum(r["n"] for r in old.values()) // BLOCK_ROWS)
    block = ["old_shard", "block"]
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("block")), F.lit(blocks)))
    within = Window.partitionBy(*block).orderBy("doc_id", "text_crc32", "size")
    placed = rows.withColumn("inner", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    totals = rows.groupBy(*block).agg(F.sum("size").alias("bytes"))
    placed = _with_starts(placed, totals, block, ["old_shard"], "bytes", "block_start")
    at = F.col("block_start") + F.coalesce("inner", F.lit(0)) + F.floor(F.col("size") / 2)
    # One row per transfer: at most old shards times new shards.
    dealt = (placed.withColumn("at", at).join(F.broadcast(targets), "old_shard")
             .where("at >= low AND at < high"))
    order = Window.partitionBy(*block, "shard").orderBy("doc_id", "text_crc32", "size")
    numbered = cut_lineage(dealt.withColumn("place", F.row_number().over(order) - 1).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard", "block", "place"))
    counts = numbered.groupBy("shard", *block).agg(F.count("*").alias("rows"))
    final = _with_starts(numbered, counts, ["shard", *block], ["shard"], "rows", "rows_before")
    return final.select("doc_id", "size", "text_crc32", "old_shard", "shard",
                        (F.col("rows_before") + F.col("place")).cast("long").alias("slot"))


def rewrite_affected(docs: DataFrame, moves: DataFrame, folder: str) -> None:
    """Write anew only the shards of `folder` (a table partitioned by `shard`) that gain or lose rows.

    `docs` carries `old_shard`; `moves` is a plan. Untouched shards keep their files; the folder of a
    shard that ends up empty is deleted. Of rows equal in doc_id, text and old shard, the plan's first
    goes with the first of the documents, so each row of the plan is one row written or left in place.
    """
    spark = docs.sparkSession
    changed = (moves.where("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("shard"))
               .distinct())
    old = (docs.drop("shard").withColumn("old_shard", F.coalesce("old_shard", F.lit(0)).cast("int"))
           .withColumn("__crc32", F.crc32(F.coalesce("text", F.lit("")))))
    # Rows with equal keys are few unless a table repeats one document: those alone share a task.
    old = old.withColumn("__nth", F.row_number().over(
        Window.partitionBy("doc_id", "__crc32", "old_shard").orderBy("text")))
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_crc32", "old_shard").orderBy("shard", "slot"))
    to = moves.withColumn("__nth", nth).join(F.broadcast(changed), "shard", "left_semi")
    moved = old.alias("d").join(
        to.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))
        & (F.col("d.__crc32") == F.col("t.text_crc32")) & (F.col("d.old_shard") == F.col("t.old_shard"))
        & (F.col("d.__nth") == F.col("t.__nth"))).select(
        *[F.col(f"d.`{c}`") for c in docs.columns if c not in ("old_shard", "shard")], "t.shard")
    stored = cut_lineage(moved)
    emptied = [r.shard for r in changed.join(to.select("shard").distinct(), "shard", "left_anti").collect()]
    (stored.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("shard").parquet(folder))
    for shard in emptied:  # at most one per old shard
        delete(spark, f"{folder.rstrip('/')}/shard={shard}")
