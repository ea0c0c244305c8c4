"""Collocations of two to four words by counted partitions of sorted suffixes.

Texts are cut into pieces and words. Every place where two or more words stand is a suffix of its
piece, read to four words at most. Each task collapses equal suffixes and sends them, in blocks with
the words they need, to the task of their two leading words; there a multikey three-way quicksort
parts the suffixes word by word, so that the size of a part of equal prefixes is the count of that
phrase, and parts too small to hold a frequent phrase are left unsorted. A second and third key word
deals out phrases that lead too many suffixes for one task; the counts of their beginnings are then
sums over tasks. Words that are rare everywhere end a suffix, as no frequent phrase holds one: a Bloom filter
of fixed size knows the frequent words, and a rare word it mistakes for one costs time only.

Scores are whole numbers from exact decimals. Edge cases: a null text has no words, a null lang is
`und`. Rows that repeat count as often as they occur. Ties are ordered by phrase, so ranks are unique.
Texts of any length are read whole; very frequent phrases never meet in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywise.session import cut_lineage, release

from .common import slices, utf8

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
#: Percent of a phrase's count at which a longer one takes its place.
COVERED = 80
MOST = 2_000
#: Words of a task that are counted together.
FLUSH_WORDS = 2_500_000
#: Suffixes a task of the second stage gets on average.
SUFFIXES_PER_TASK = 2_500_000
#: A phrase that leads one in HOT of all words is dealt by one word more; so there are at most HOT of each length.
HOT = 20_000
#: What occurs less often in a task is not looked at for that.
FEW = 8
FILTER_BITS = 1 << 24
FILTER_HASHES = 3
#: Parts of at most this many suffixes are finished by stable sorts.
SMALL = 8_192

#: A-Z in small letters, marks that end a piece as line feeds, tabs as blanks.
LETTERS = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")
CODEC = "zstd"
#: Codes that no word has.
END, NOTHING = 0, 1


class Words(dict):
    """Codes of words in the order they are met; 0 ends a piece."""

    def __init__(self):
        super().__init__({b"\n": END, b"": NOTHING})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code

    def codes(self, text: bytes) -> np.ndarray:
        """The words of a text, an END after each piece."""
        found = text.translate(LETTERS).replace(b"\n", b" \n ").split(b" ")
        found.append(b"\n")
        codes = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
        return codes[codes != NOTHING]


def _by_language(batches):
    """(lang, words, codes) of at most about FLUSH_WORDS words, a long text more."""
    held: dict[str, tuple[Words, list[np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for part in slices([batch]):
            for lang, text in zip(part.column(0).to_pylist(), utf8(part.column(1))):
                words, codes = held.setdefault(lang, (Words(), []))
                codes.append(words.codes(text or b""))
                size += len(codes[-1])
                if size >= FLUSH_WORDS:
                    yield from ((at, w, np.concatenate(c)) for at, (w, c) in held.items())
                    held, size = {}, 0
    yield from ((at, w, np.concatenate(c)) for at, (w, c) in held.items())


def _count_words(batches):
    """(lang, size, phrase, count): all words, and phrases of two and three words that lead many suffixes here."""
    for lang, words, codes in _by_language(batches):
        names = list(words)
        counts = np.bincount(codes, minlength=len(names))
        listed = np.flatnonzero(counts[2:]) + 2
        sizes, phrases, totals = [1] * len(listed), [names[k] for k in listed], [counts[listed]]
        many = max(FEW, len(codes) // HOT)
        # A phrase that occurs often holds only words that do, and begins with such a phrase.
        often = np.where(counts >= many, np.arange(len(counts)), 0)
        often[:2] = 0
        often = np.concatenate([often[codes], np.zeros(LONGEST, np.int64)])
        where = np.flatnonzero(often)
        lead = often[where]
        for size in (2, 3):
            follows = often[where + size - 1]
            where, lead, follows = where[follows > 0], lead[follows > 0], follows[follows > 0]
            _, first, at, total = np.unique(lead * len(names) + follows, return_index=True, return_inverse=True,
                                            return_counts=True)
            hot = total >= many
            phrases += [b" ".join(names[c] for c in codes[p:p + size]) for p in where[first[hot]]]
            sizes += [size] * int(hot.sum())
            totals.append(total[hot])
            lead = np.where(hot, np.cumsum(hot), 0)[at]
            where, lead = where[lead > 0], lead[lead > 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(sizes), pa.string()), pa.array(sizes, pa.int32()),
             pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(np.concatenate(totals), pa.int64())],
            ["lang", "size", "phrase", "count"])


def _places(word: Column) -> list[Column]:
    """Bits of a word in the filter: stretches of its hash."""
    return [F.shiftrightunsigned(F.xxhash64(word), 20 * k).bitwiseAND(F.lit(FILTER_BITS - 1))
            for k in range(FILTER_HASHES)]


def _filter(frequent: DataFrame) -> np.ndarray:
    """Bits of the frequent words; FILTER_BITS of them, however many the words."""
    bits = frequent.select(F.explode(F.array(*_places(F.col("phrase")))).alias("bit"))
    rows = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[np.asarray(rows["at"])] = np.asarray(rows["bits"])
    return out.view(np.uint64)


def _holds(bits: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Whether the filter holds each word."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))
    known = np.ones(len(words), bool)
    for k in range(FILTER_HASHES):
        at = hashes >> np.uint64(20 * k) & np.uint64(FILTER_BITS - 1)
        known &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return known


def _suffixes(bits: np.ndarray, hot: dict[str, list[set[bytes]]], tasks: int):
    """Blocks of n distinct suffixes with their counts: (task, lang, depth, n, size, words, suffixes).

    `depth` is the number of leading words by which a suffix is dealt: 2, or more after hot phrases.
    """
    def blocks(batches):
        for lang, words, codes in _by_language(batches):
            names = list(words)
            known = _holds(bits, names)
            known[:2] = False
            codes = np.concatenate([np.where(known[codes], codes, 0), np.zeros(LONGEST, np.int32)])
            start = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
            rows = np.zeros((len(start), LONGEST), np.int64)
            for k in range(LONGEST):  # nothing follows the end of a suffix
                rows[:, k] = codes[start + k] if k < 2 else np.where(rows[:, k - 1] > 0, codes[start + k], 0)
            if not len(rows):
                continue
            rows, count = _collapsed(rows, len(names))
            depth = _depths(rows, names, hot.get(lang, [set(), set()]))
            spread = np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in names), np.uint64, len(names))
            dealt = np.full(len(rows), xxhash.xxh64_intdigest(lang, 7), np.uint64)
            for k in range(LONGEST):
                mixed = (dealt ^ (dealt >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + spread[rows[:, k]]
                dealt = np.where(k < depth, mixed, dealt)
            task = ((dealt ^ (dealt >> np.uint64(32))) % np.uint64(tasks)).astype(np.int64)
            order = np.lexsort((depth, task))
            bounds = np.flatnonzero(np.diff(task[order] * 8 + depth[order])) + 1
            for part in np.split(order, bounds):
                used, at = np.unique(rows[part], return_inverse=True)
                listed = b" ".join(names[c] for c in used[used > 0])
                at = at.reshape(-1, LONGEST).astype(np.int32)
                if used[0]:  # code 0 stands for no word
                    at = at + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(task[part[0]])], pa.int64()), pa.array([lang], pa.string()),
                     pa.array([int(depth[part[0]])], pa.int32()), pa.array([len(part)], pa.int64()),
                     pa.array([len(listed)], pa.int64()), pa.array([pa.compress(listed, CODEC, asbytes=True)], pa.binary()),
                     pa.array([_packed(at, count[part])], pa.binary())],
                    ["task", "lang", "depth", "n", "size", "words", "suffixes"])
    return blocks


def _packed(rows: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted rows and their counts, compressed: steps of the first word, bytes of one weight side by side."""
    columns = [np.diff(rows[:, 0], prepend=0), *rows[:, 1:].T, count]
    planes = b"".join(c.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return pa.compress(planes, CODEC, asbytes=True)


def _unpacked(packed: bytes, n: int) -> list[np.ndarray]:
    """The columns of `_packed`: the words of the suffixes, then their counts."""
    planes = np.frombuffer(pa.decompress(packed, 8 * n * (LONGEST + 1), CODEC), np.uint8).reshape(LONGEST + 1, 8, n)
    first, *others = (np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes)
    return [np.cumsum(first), *others]


def _collapsed(rows: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and how often each occurs."""
    bits = max(1, int(codes).bit_length())
    if bits * LONGEST <= 63:
        key = rows[:, 0]
        for k in range(1, LONGEST):
            key = key << bits | rows[:, k]
        key, count = np.unique(key, return_counts=True)
        columns = [key >> (bits * (LONGEST - 1 - k)) & ((1 << bits) - 1) for k in range(LONGEST)]
        return np.stack(columns, 1), count
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return rows[first], np.diff(np.append(first, len(rows)))


def _depths(rows: np.ndarray, names: list[bytes], hot: list[set[bytes]]) -> np.ndarray:
    depth = np.full(len(rows), 2, np.int64)
    for size, phrases in ((2, hot[0]), (3, hot[1])):
        if not phrases:
            break
        may = depth == size
        for k in range(size):  # the hot phrases' own words, as few as they are
            own = {p.split(b" ")[k] for p in phrases}
            may &= np.fromiter((n in own for n in names), bool, len(names))[rows[:, k]]
        at = np.flatnonzero(may)
        found = [b" ".join(names[c] for c in row) in phrases for row in rows[at, :size].tolist()]
        depth[at[np.array(found, bool)]] = size + 1
    return depth


def counted_prefixes(columns: list[np.ndarray], weight: np.ndarray, least: int, complete: int = 2):
    """(size, position of a suffix, count) of the prefixes of two or more words that occur `least` times.

    Multikey three-way quicksort of the positions. A part holds suffixes that agree in their first
    `size` words; its weights add up to the count of that phrase. Parts of fewer than `least` are
    abandoned. Prefixes shorter than `complete` may go on in other tasks, so they are listed whatever their count.
    """
    def may_matter(size: int, count: int) -> bool:
        return size + 1 < complete or count >= least

    parts = [(np.arange(len(weight)), 0)]
    while parts:
        at, size = parts.pop()
        if size == len(columns) or not may_matter(size, weight[at].sum()):
            continue
        if len(at) <= SMALL:
            yield from _finish(columns, weight, at, size, least, complete)
            continue
        key = columns[size][at]
        pivot = np.sort(key[[0, len(key) // 4, len(key) // 2, 3 * len(key) // 4, -1]])[2]
        below, equal = key < pivot, key == pivot
        parts += [(at[below], size), (at[~(below | equal)], size)]
        if pivot > 0:  # else they end here
            same = at[equal]
            count = int(weight[same].sum())
            if size and (size + 1 < complete or count >= least):
                yield size + 1, int(same[0]), count
            parts.append((same, size + 1))


def _finish(columns, weight, at, size, least, complete):
    """The frequent prefixes of a small part, one word after the other by stable sorts."""
    group = np.zeros(len(at), np.int64)
    for k in range(size, len(columns)):
        go_on = columns[k][at] > 0
        at, group = at[go_on], group[go_on]
        if not len(at):
            return
        key = group * (int(columns[k][at].max()) + 1) + columns[k][at]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.add.reduceat(weight[at], first)
        if k:
            listed = (count >= least) | (k + 1 < complete)
            yield from zip([k + 1] * int(listed.sum()), at[first[listed]].tolist(), count[listed].tolist())
        group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        stays = ((count >= least) | (k + 2 < complete))[group]
        at, group = at[stays], group[stays]


def _count_group(rows: pa.Table) -> pa.Table:
    """(lang, size, phrase, count) of the frequent phrases among a task's suffixes."""
    sizes: list[int] = []
    langs: list[str] = []
    phrases: list[bytes] = []
    counts: list[int] = []
    blocks: dict[tuple, list[dict]] = {}
    for row in rows.to_pylist():
        blocks.setdefault((row["lang"], row["depth"]), []).append(row)
    for (lang, depth), own in blocks.items():
        words: dict[bytes, int] = {b"\n": 0}
        parts = []
        for row in own:
            names = pa.decompress(row["words"], row["size"], CODEC, asbytes=True).split(b" ")
            code = np.fromiter((words.setdefault(w, len(words)) for w in names), np.int64, len(names))
            code = np.concatenate([[0], code])
            *words_of, count = _unpacked(row["suffixes"], row["n"])
            parts.append([code[w] for w in words_of] + [count])
        *columns, weight = (np.concatenate(c) for c in zip(*parts))
        names = list(words)
        for size, at, count in counted_prefixes(columns, weight, LEAST, depth):
            langs.append(lang)
            sizes.append(size)
            phrases.append(b" ".join(names[columns[k][at]] for k in range(size)))
            counts.append(count)
    return pa.table({"lang": pa.array(langs, pa.string()), "size": pa.array(sizes, pa.int32()),
                     "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                     "count": pa.array(counts, pa.int64())})


COUNTS = "lang string, size int, phrase string, count long"


def phrase_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leads, phrases): counts by lang of all words, as phrases of size 1, and of the phrases that occur LEAST times.

    Both are stored. Phrases of size 2 and 3 in `leads` only serve to deal out work.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    leads = cut_lineage(texts.mapInArrow(_count_words, COUNTS).groupBy("lang", "size", "phrase").agg(
        F.sum("count").alias("count")))
    words = leads.where("size = 1").drop("size")
    total = words.agg(F.sum("count")).first()[0] or 0
    hot: dict[str, list[set[bytes]]] = {}
    for row in leads.where((F.col("size") > 1) & (F.col("count") * HOT >= total)).collect():
        hot.setdefault(row.lang, [set(), set()])[row.size - 2].add(row.phrase.encode())
    tasks = max(1, -(-total // SUFFIXES_PER_TASK))
    bits = _filter(words.where(F.col("count") >= LEAST).select("phrase").distinct())
    blocks = texts.mapInArrow(
        _suffixes(bits, hot, tasks),
        "task long, lang string, depth int, n long, size long, words binary, suffixes binary")
    found = blocks.groupBy("task").applyInArrow(_count_group, COUNTS)
    # Phrases of one task come once, beginnings of hot ones from several.
    phrases = cut_lineage(found.groupBy("lang", "size", "phrase").agg(F.sum("count").alias("count"))
                          .where(F.col("count") >= LEAST))
    return leads, phrases


def collocations(docs: DataFrame, most: int | None = MOST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `most` best phrases of each lang, or all for None."""
    leads, phrases = phrase_counts(docs)
    words = leads.where("size = 1")
    n = words.groupBy("lang").agg(F.sum("count").alias("n"))
    known = phrases.select("lang", "phrase", "count").union(
        words.where(F.col("count") >= LEAST).select("lang", "phrase", "count"))
    split = phrases.select("lang", "phrase", "size", F.col("count").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = split.select("lang", "phrase", "a", "w", "size",
                        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest"))
    scored = (cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l")), ["lang", "first"])
              .join(known.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r")), ["lang", "rest"])
              .withColumn("score", F.expr(f"CAST({SCALE} AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0)) "
                                          "DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))").cast("long")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every phrase of fewer words within a longer one, with the most that such a longer one occurs.
    inner = split.where("size > 2").select("lang", "a", "w", "size", F.explode(F.sequence(
        F.lit(2), F.col("size") - 1)).alias("m")).select("lang", "a", "w", "m", F.explode(F.sequence(
            F.lit(1), F.col("size") - F.col("m") + 1)).alias("from"))
    longer = inner.groupBy("lang", F.concat_ws(" ", F.slice("w", F.col("from"), F.col("m"))).alias("phrase")).agg(
        F.max("a").alias("within"))
    left = (best.join(longer, ["lang", "phrase"], "left")
            .where(F.col("within").isNull() | (F.col("within").cast("decimal(19,0)") * 100
                                               < F.col("a").cast("decimal(19,0)") * COVERED)))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", place)
    if most is not None:
        rows = rows.where(F.col("rank") <= most)
    found = cut_lineage(rows.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
    release(leads, phrases)
    return found
