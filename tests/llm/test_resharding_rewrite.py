"""Rewriting when shards are merged and when rows repeat: the folder holds every row of the plan once."""

import collections

import pytest
from pyspark.sql import functions as F

from tallywise.llm import resharding as R


def rewritten(spark, tmp_path, rows, shards):
    docs = spark.createDataFrame(rows, "doc_id long, text string, old_shard int")
    target = str(tmp_path / "shards")
    docs.withColumnRenamed("old_shard", "shard").repartition("shard").write.partitionBy("shard").parquet(target)
    moves = R.cut_lineage(R.plan(R.sized(docs, F.col("old_shard")), shards))
    R.rewrite_affected(docs, moves, target)
    planned = collections.Counter((r.doc_id, r.text_crc32, r.shard) for r in moves.collect())
    after = spark.read.parquet(target).withColumn("crc", F.crc32(F.coalesce("text", F.lit("")))).collect()
    assert collections.Counter((r.doc_id, r.crc, r.shard) for r in after) == planned
    assert collections.Counter((r.doc_id, r.text) for r in after) == collections.Counter(r[:2] for r in rows)
    return tmp_path / "shards"


@pytest.mark.parametrize("shards", [1, 3])
def test_fewer_shards(spark, tmp_path, shards):
    folder = rewritten(spark, tmp_path, [(k, f"text {k:03d}", k % 5) for k in range(60)], shards)
    assert {p.name for p in folder.glob("shard=*")} == {f"shard={k}" for k in range(shards)}


def test_repeated_rows(spark, tmp_path):
    """Copies of a row lie in a shard that stays as it is (0) and in one that is parted (1)."""
    rows = ([(7, "same text", 0)] * 20 + [(7, "same text", 1)] * 30 + [(8, "same text", 1)] * 10
            + [(None, None, 1)] * 12)
    rewritten(spark, tmp_path, rows, 3)
