"""Columns of the user that are named like something the operators add stay what they are."""

import corpus_pipeline as C
import pytest

from tallywise.llm import decontamination, line_windows, queries, resharding, simhash, unit_dedup
from tallywise.session import work_path

NAMES = ["text_key", "language", "nth", "text_crc32", "fingerprint", "component_id", "keep_key", "covered", "marks",
         "item_id", "matched", "spans", "start", "end", "shift"]


@pytest.fixture(scope="module")
def docs(spark):
    lines = "\n".join(f"a line of some words number {k}" for k in range(8))
    rows = [(k, t, "en", "s", len(t)) + tuple(f"{n} {k}" for n in NAMES) for k, t in enumerate(
        [lines, lines, "another text about the weather of the last days", "one more text that stands here alone", ""])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{n}` string" for n in NAMES))


def untouched(rows):
    assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in NAMES)


def test_operators(spark, docs, folder):
    benchmark = queries.table(spark, folder, "benchmark")
    untouched(line_windows.without_repeats(docs).collect())
    untouched(unit_dedup.without_repeats(docs).collect())
    untouched(simhash.one_of_each(docs).collect())
    untouched(decontamination.without_contaminated(docs, benchmark).collect())


def test_pipeline_stages(spark, docs, folder):
    now = docs
    for _, stage in C.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns
        untouched(now.collect())


def test_rewriting_shards(spark, docs):
    folder = work_path(spark, "shards")
    old = docs.selectExpr("*", "cast(doc_id % 2 as int) as old_shard")
    old.withColumnRenamed("old_shard", "shard").write.partitionBy("shard").parquet(folder)
    moves = resharding.plan(resharding.sized(old, resharding.F.col("old_shard")), 3)
    resharding.rewrite_affected(old, moves, folder)
    there = spark.read.parquet(folder)
    assert there.count() == 5
    untouched(there.collect())
