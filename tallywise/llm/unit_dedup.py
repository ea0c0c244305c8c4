"""Substring dedup by unit hashing: the earliest ranked occurrence of a passage stays.

A unit is a line of a text or a sentence in it, normalised to small letters and single spaces.
Lines alone miss passages that stand within a line, so lines are parted at the blank behind a full
stop, question or exclamation mark. Units of at least `MIN_UNIT_WORDS` words are hashed to 128 bits
and grouped over all documents; the earliest occurrence by (doc_id, __text_key, start) stays. Later
ones are removed where they follow each other for `min_words` words or more; shorter units between
two of them go along. Spans are code point offsets in the original text.

Edge cases: null and empty texts have no units. Rows equal in doc_id and text share one rank: the
earliest of them all keep the unit. A null doc_id ranks first. A unit that repeats within one text
is removed there too.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.session import cut_lineage

from .common import as_long, on_row_key, slices, values, with_row_key

#: Shorter runs recur by nature (titles, licence lines) and stay.
MIN_WORDS = 20
MIN_UNIT_WORDS = 4
BLANKS = " \t\r\x0b\x0c"
BLANK_RUN = re.compile(f"[{BLANKS}]+")
SENTENCE_END = re.compile(r"([.!?])[ \t]")
UNIT_TYPE = ("doc_id long, __text_key long, unit int, start long, end long, n_words int, "
             "high long, low long")


def _units(batches):
    for batch in slices(batches):
        rows = []
        for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            start, unit = 0, 0
            # One blank becomes one line break, so that offsets stay those of the text.
            for line in SENTENCE_END.sub("\\1\n", text or "").split("\n"):
                end = start + len(line)
                # A line of n words has n - 1 blanks between them at least.
                if len(line) >= 2 * MIN_UNIT_WORDS - 1:
                    words = BLANK_RUN.sub(" ", line.strip(BLANKS).lower())
                    n = words.count(" ") + 1
                    if n >= MIN_UNIT_WORDS:
                        value = xxhash.xxh3_128_intdigest(words.encode("utf-8", "replace"))
                        rows.append((doc, key, unit, start, end, n, as_long(value >> 64),
                                     as_long(value & (1 << 64) - 1)))
                        unit += 1
                start = end + 1
        columns = list(zip(*rows)) if rows else [[]] * 8
        kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [
            "doc_id", "__text_key", "unit", "start", "end", "n_words", "high", "low"])


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Each removed run: doc_id, __text_key, start, end, n_units, n_words, first_doc_id, first_start.

    The last two are the earliest place of the run's first unit. Ranks are minima pre-aggregated
    before the shuffle, so a passage that a third of the documents share is one row; the join that
    brings its earliest place back can be split by AQE.
    """
    units = cut_lineage(with_row_key(docs).select("doc_id", "__text_key", "text").mapInArrow(_units, UNIT_TYPE))
    place = F.struct("doc_id", "__text_key", "start")
    groups = (units.groupBy("high", "low").agg(F.min(place).alias("first"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    later = units.join(groups, ["high", "low"]).where(place > F.col("first")).drop("high", "low")
    # Units of one text, so no more rows than it has lines and sentences; rows equal in all count once.
    text = ["doc_id", "__text_key"]
    runs = (later.distinct().withColumn("run", F.col("unit") - F.row_number().over(
        Window.partitionBy(*text).orderBy("unit")))
        .groupBy(*text, "run").agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_units"),
            F.sum("n_words").alias("n_words"), F.min(F.struct("start", "first")).alias("head")))
    return runs.where(F.col("n_words") >= min_words).select(
        *text, "start", "end", "n_units", "n_words", F.col("head.first.doc_id").alias("first_doc_id"),
        F.col("head.first.start").alias("first_start"))


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, cuts in zip(values(texts), values(spans)):
        if cuts:
            kept, at = [], 0
            for span in cuts:
                kept.append(text[at:span["start"]])
                at = span["end"] + 1  # the break behind goes along
            text = "".join(kept) + text[at:]
        out.append(text)
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` without the repeated units, and with the `removed` spans (null if none)."""
    spans = (repeated_units(docs, min_words).groupBy("doc_id", "__text_key")
             .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed")))
    marked = with_row_key(docs).alias("d").join(spans.alias("s"), on_row_key("d", "s"), "left")
    cut = F.arrow_udf(_cut, "string")
    return marked.select(
        *[cut(F.col("d.text"), F.col("s.removed")).alias("text") if c == "text" else F.col(f"d.`{c}`")
          for c in docs.columns if c != "removed"], F.col("s.removed").alias("removed"))
