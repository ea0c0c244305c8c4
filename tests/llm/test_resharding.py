"""Cheapest flow, placement, slots, rewriting of affected shards."""

import itertools
import random
import zlib

from pyspark.sql import functions as F

from tallywise.llm import queries
from tallywise.llm import resharding as R


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(1)
    for _ in range(40):
        supply = {i: rng.choice([0, rng.randrange(1, 90)]) for i in range(rng.randrange(1, 6))}
        capacity = R.even_capacities(sum(supply.values()), rng.randrange(1, 7))
        flow = R.min_cost_transfers(supply, capacity)
        for i, n in supply.items():
            assert sum(x for a, _, x in flow if a == i) == n
        for j, n in enumerate(capacity):
            assert sum(x for _, b, x in flow if b == j) == n
        stay = sum(min(n, capacity[i]) for i, n in supply.items() if i < len(capacity))
        assert sum(x for a, b, x in flow if a != b) == sum(supply.values()) - stay


def test_query_law(spark, folder):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op3_flow_resharding(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        raw = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    got.sort(key=lambda r: (r.shard, r.slot))
    loads, largest = [], max(r.size for r in got)
    for _, rows in itertools.groupby(got, key=lambda r: r.shard):
        rows = list(rows)
        assert [r.slot for r in rows] == list(range(len(rows)))
        loads.append(sum(r.size for r in rows))
    mean = sum(r.size for r in got) / 40
    # An old shard gives at most a few ranges, and each end of a range is off by one document at most.
    assert all(abs(x - mean) <= 3 * largest for x in loads)


def test_blocks_change_nothing_but_order(spark, folder, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ROWS", 7)
    test_query_law(spark, folder)


def test_unmoved_shards_stay(spark):
    rows = [(k, "x" * 84, k % 4) for k in range(40)]
    docs = R.sized(spark.createDataFrame(rows, "doc_id long, text string, old int"), F.col("old"))
    assert R.plan(docs, 4).where("shard <> old_shard").count() == 0
    assert R.plan(docs, 5).where("shard <> old_shard").count() == 8


def test_edges(spark):
    rows = [(1, None, 0), (1, None, 0), (None, "é", None), (2, "", 9), (3, "long " * 20000, 1)]
    docs = R.sized(spark.createDataFrame(rows, "doc_id long, text string, shard int"), F.col("shard"))
    got = R.plan(docs, 3).collect()
    assert sorted(r["size"] for r in got) == [16, 16, 16, 18, 100016]
    assert sorted(r.text_crc32 for r in got if r["size"] == 16) == [0, 0, 0]
    assert R.plan(docs.limit(0), 3).count() == 0


def test_rewrites_only_affected_files(spark, tmp_path):
    rows = [(k, f"text {k} " + "x" * (300 if k < 4 else 20), k % 4) for k in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old_shard int")
    target = str(tmp_path / "shards")
    docs.withColumnRenamed("old_shard", "shard").repartition("shard").write.partitionBy("shard").parquet(target)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "shards").rglob("*.parquet")}
    moves = R.plan(R.sized(docs, F.col("old_shard")), 5)
    R.rewrite_affected(docs, moves, target)
    want = {r.doc_id: r.shard for r in moves.collect()}
    after = spark.read.parquet(target).collect()
    assert {r.doc_id: r.shard for r in after} == want and len(after) == 24
    assert {r.text for r in after} == {t for _, t, _ in rows}
    changed = {s for r in moves.where("shard <> old_shard").collect() for s in (r.shard, r.old_shard)}
    for path, stamp in before.items():
        if int(path.parent.name.split("=")[1]) not in changed:
            assert path.stat().st_mtime_ns == stamp
