"""Packing of tokenized documents into sequences of fixed length.

A document's ids are cut into pieces of at most `length`. Pieces are dealt to groups by a hash of
their key and a seed, and each group packs its own by first-fit decreasing: a tournament tree over
the room left in each bin finds the first bin that still fits in logarithmic time.

Edge cases: a null text counts as empty; an empty text is the end id alone. Rows that repeat a
doc_id are documents of their own, packed each. Very long texts give many pieces.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.session import cut_lineage

from .common import kept, slices

LENGTH = 4_096
END_ID = 2
#: Pieces a group packs on its own; the last, emptier bins of a group are what small groups waste.
PIECES_PER_GROUP = 4_096
#: Distinct chunks, and words, whose ids a Python worker remembers from task to task; as many older ones are at hand.
REMEMBERED = 300_000
#: Latin-1 letters, and marks that no tokenizer of this kind parts or names.
LATIN = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
MARKS = ".,;:!?%&$#*+()/-"
PROBES = ["a", "The", "word,", "Ünïted.", "straßeÀ!!", "éèçôÿ", "x%%&", "ÞÐøå(-)", "antidisestablishmentarianism?!", "."]
#: Byte-level models name a byte by a character: a printable one by itself, the n-th other by 256 + n.
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(
    b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}


class ChunkTokenizer(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes; the mapping remembers chunks.

    For tokenizers that split at white space and drop it: no token then spans an ASCII space or line
    break, so the ids of a text are those of its chunks in turn. A chunk of Latin-1 letters and
    then punctuation goes to the model directly, if that gives the probes the ids of a full call,
    which first normalises and splits its text.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model, self.words, self.direct = self.whole.model, {}, True
        self.older: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.direct = all(self[w] == self._any(w) for w in PROBES)
        self.clear()

    def _any(self, chunk: str) -> bytes:
        return _packed(self.whole.encode(chunk, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """Ids of letters alone, small or capital."""
        word = word.lower()
        found = self.words.get(word)
        if found is None:
            found = self.older_words.get(word)
            if found is None:
                plain = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
                found = _packed([t.id for t in self.model.tokenize(plain)])
            if len(self.words) >= REMEMBERED:
                self.older_words, self.words = self.words, {}
            self.words[word] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        found = self.older.get(chunk)
        if found is not None:
            self[chunk] = found
            return found
        word = chunk.rstrip(MARKS)
        if self.direct and word and (word.isascii() and word.isalpha() or LATIN.fullmatch(word)):
            found = self._word(word)
            if len(word) < len(chunk):
                found += self[chunk[len(word):]]
        else:
            found = self._any(chunk)
        self[chunk] = found
        return found

    def ids(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for text in texts:
            yield b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _pieces(path: str, length: int, with_ids: bool):
    end = END_ID.to_bytes(4, "little")

    def pieces(batches):
        tokenizer = kept(f"chunks {path}", lambda: ChunkTokenizer(path))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
        kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
        for batch in slices(batches):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), tokenizer.ids(batch.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start:4 * (start + length)]
                    row = (doc, start, len(part) // 4, zlib.crc32(part), total)
                    rows.append((*row, part) if with_ids else row)
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    return pieces


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size; sizes are given in falling order and none exceeds the capacity.

    Inner node k of the tree holds the most room in the bins below it, so walking down to the left
    wherever enough room is left ends at the first bin that fits.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        out.append((at - leaves, capacity - room[at]))
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return out


def _pack_group(length: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"],
                                ascending=[False, True, True, True], ignore_index=True)
        placed = first_fit_decreasing(rows["length"].tolist(), length)
        rows["bin"] = [b for b, _ in placed]
        rows["offset"] = [o for _, o in placed]
        return rows
    return pack


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, seed: int = 7,
         with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `sequence_id` is unique, not gapless: group * 2^32 + bin. With `with_ids` the pieces carry
    their ids (little-endian unsigned 32-bit), else only the check sum moves through the shuffle.
    """
    pieces = cut_lineage(docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer_path, length, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids))
    groups = max(1, -(-pieces.count() // PIECES_PER_GROUP))
    # The check sum spreads rows that repeat a doc_id with other texts.
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.lit(seed)),
                                              F.lit(groups)).cast("long"))
    kinds = ", ".join(f"{n} {t}" for n, t in dealt.dtypes) + ", bin long, offset long"
    packed = dealt.groupBy("group").applyInPandas(_pack_group(length), kinds)
    return packed.withColumn("sequence_id", F.shiftleft("group", 32) + F.col("bin")).drop("group", "bin")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): whole sequences from pieces packed with their ids."""
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", "n_tokens", F.expr(
            "aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))").alias("ids"))
