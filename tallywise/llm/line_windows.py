"""Line dedup by overlapping three-line windows.

Every run of three consecutive lines (trimmed, at least one of them not blank) is hashed to 128
bits. The first occurrence of a window, in the order of (doc_id, __text_key, line), stays; the lines
that later occurrences cover are merged and removed.

Edge cases: null and empty texts and texts of fewer than three lines have no window and stay as
they are. Rows equal in doc_id and text share one place in the order, so the earliest of them all
keep their lines. A null doc_id sorts first. Further columns are carried along. A text that loses
all its lines becomes empty.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.session import cut_lineage

from .common import as_long, on_row_key, slices, utf8, values, with_row_key

WINDOW = 3
BLANKS = b" \t\r\x0b\x0c"


def _windows(batches):
    """(doc_id, __text_key, line, high, low) for each window of each text."""
    digest = xxhash.xxh3_128_digest
    for batch in slices(batches):
        ids, lines, high, low, keys = [], [], [], [], []
        for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  utf8(batch.column(2))):
            trimmed = [line.strip(BLANKS) for line in (text or b"").split(b"\n")]
            if len(trimmed) < WINDOW:
                continue
            marks = [digest(line) for line in trimmed]
            for at in range(len(trimmed) - WINDOW + 1):
                if any(trimmed[at:at + WINDOW]):
                    value = xxhash.xxh3_128_intdigest(b"".join(marks[at:at + WINDOW]))
                    ids.append(doc), keys.append(key), lines.append(at)
                    high.append(as_long(value >> 64)), low.append(as_long(value & (1 << 64) - 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(lines, pa.int32()),
             pa.array(high, pa.int64()), pa.array(low, pa.int64())],
            ["doc_id", "__text_key", "line", "high", "low"])


def later_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, __text_key, covered): the sorted lines that later occurrences of windows cover.

    First places are minima, pre-aggregated before the shuffle; a window that a third of all texts
    share is one row there, and the join that finds its later occurrences can be split by AQE.
    """
    windows = cut_lineage(with_row_key(docs).select("doc_id", "__text_key", "text").mapInArrow(
        _windows, "doc_id long, __text_key long, line int, high long, low long"))
    place = F.struct("doc_id", "__text_key", "line")
    repeated = (windows.groupBy("high", "low").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                .where("n > 1").drop("n"))
    later = windows.join(repeated, ["high", "low"]).where(place > F.col("first"))
    lines = later.select("doc_id", "__text_key", F.explode(
        F.sequence("line", F.col("line") + WINDOW - 1)).alias("line"))
    # Bounded by one text: a row holds at most as many numbers as its text has lines.
    return lines.groupBy("doc_id", "__text_key").agg(F.sort_array(F.collect_set("line")).alias("covered"))


def _without(texts: pa.Array, covered: pa.Array) -> pa.Array:
    out, sizes, gone = [], [], []
    for text, lines in zip(values(texts), values(covered)):
        split = text.split("\n") if text is not None else []
        if lines:
            drop = set(lines)
            text = "\n".join(line for k, line in enumerate(split) if k not in drop)
        out.append(text), sizes.append(len(split)), gone.append(len(lines or ()))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())],
        ["text", "n_lines", "n_removed"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with repeated windows cut from `text`, and with `n_lines` before and `n_removed`."""
    cut_lines = F.arrow_udf(_without, "struct<text:string,n_lines:long,n_removed:long>").asNondeterministic()
    marked = with_row_key(docs).alias("d").join(later_lines(docs).alias("c"), on_row_key("d", "c"), "left")
    cut = marked.select(*[F.col(f"d.`{c}`") for c in docs.columns],
                        cut_lines(F.col("d.text"), F.col("c.covered")).alias("__cut"))
    return cut.select(
        *[F.col("__cut.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns
          if c not in ("n_lines", "n_removed")], "__cut.n_lines", "__cut.n_removed")
