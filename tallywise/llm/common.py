"""Helpers of the corpus operators: reading, row keys, Arrow text, stored tables, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.session import cut_lineage, release

#: Rows of an Arrow batch that are turned into Python objects together.
AT_ONCE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_row_key(docs: DataFrame) -> DataFrame:
    """Add `__text_key`, XXH64 of the text, so that rows repeating a doc_id with another text stay apart."""
    return docs.withColumn("__text_key", F.xxhash64("text"))


def on_row_key(left: str, right: str):
    """Join condition on (doc_id, __text_key) that also matches null ids."""
    return (F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
            & (F.col(f"{left}.__text_key") == F.col(f"{right}.__text_key")))


def in_fold(id_column: str, folds: int, fold: int):
    """Whether crc32 of the id as text leaves `fold` modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds == fold


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of AT_ONCE, which bounds what Python holds of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def values(column: pa.Array) -> Iterator:
    """The values of a column, AT_ONCE of them in Python at a time."""
    for at in range(0, len(column), AT_ONCE):
        yield from column.slice(at, AT_ONCE).to_pylist()


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return values(column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()))


def kept(name: str, make: Callable[[], object]):
    """What `make` returned for this name in this Python worker, which serves many tasks."""
    store = sys.modules.setdefault("_kept_by_tasks", types.ModuleType("_kept_by_tasks")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def as_long(value: int) -> int:
    """An unsigned 64-bit number as Spark's signed long."""
    return value - (1 << 64) if value >> 63 else value


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected `edges` (a, b), both long.

    Alternating large-star and small-star rounds. Every round is written to the shared folder and
    the one before it is deleted. A node's neighbours are only ever aggregated to their minimum,
    so a hub is pre-aggregated before its shuffle and its edges are never gathered in one task.
    """
    now = cut_lineage(_oriented(edges).distinct())
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = _star(_oriented(large))
        small = (small.select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(small.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        then = cut_lineage(_oriented(small).distinct())
        release(now)
        now, before, state = then, state, _state(then)
        if state == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))


def _star(edges: DataFrame) -> DataFrame:
    """(u, v, m) for each edge (u, v): m is the least of u and its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (edges.alias("e").join(least.alias("s"), F.col("e.a") == F.col("s.a"))
            .select(F.col("e.a").alias("u"), F.col("e.b").alias("v"), "m"))


def _state(edges: DataFrame) -> tuple:
    """Equal for two rounds only if their edges are equal, but for a collision of 64-bit hashes."""
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                    F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(row)
