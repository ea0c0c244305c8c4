"""Byte-level BPE encoding and decoding in linear time.

A text is split by the pattern of its vocabulary; each match is encoded alone. Bytes stand as
Latin-1 characters, over which an automaton of all tokens gives the longest token from every
position. The ids of a match are those tokens, left to right, of which each next pair is one that the merges
themselves would leave side by side. Where the longest token does not fit its left neighbour the
next shorter one that begins it is tried, and where none fits the last token is taken back; a
position found hopeless is never entered again. Whether two tokens can be neighbours is decided by
undoing their merges from the latest to the earliest, and remembered.

Edge cases: a null text counts as empty and has no ids. Rows that repeat a doc_id are encoded each.
A match of any length takes time in proportion to it; texts are read in pieces of about a million
characters that end where the pattern cannot match across.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, slices, utf8

#: Distinct matches whose ids a Python worker remembers, twice; longer ones are encoded each time.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 64
COMPATIBLE = 1_000_000
PIECE = 1 << 20


def ranks_of(path: str) -> dict[bytes, int]:
    """The rank of each token of a file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens with the two tokens that the merges make each from; a rank is an id."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary has no token for {len(missing)} bytes")
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.id_of = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.bytes_of):
            if self._learn(rank, token := self.bytes_of[rank].decode("latin-1")):
                self.automaton.add_word(token, rank)
        self.known.clear()  # pairs judged before later merges were known
        self.shorter = {rank: next(self._begin(rank), None) for rank in self.bytes_of}
        self.automaton.make_automaton()

    def _begin(self, rank: int) -> Iterator[int]:
        """Tokens of the merges that a token begins with, the longest first."""
        token = self.bytes_of[rank].decode("latin-1")
        found = (self.id_of.get(token[:n]) for n in range(len(token) - 1, 0, -1))
        return (k for k in found if k in self.parts)

    def _learn(self, rank: int, token: str) -> bool:
        """Find how `token` is merged; one that no earlier tokens make only stands for a whole match."""
        if len(token) == 1:
            self.parts[rank] = (rank, rank)
            return True
        for a in self._begin(rank):
            b = self.id_of.get(token[self.length[a]:])
            if b in self.parts and self.neighbours(a, b):
                self.parts[rank] = (a, b)
                self.merged[a, b] = rank
                return True
        splits = ((self.id_of.get(token[:n]), self.id_of.get(token[n:])) for n in range(1, len(token)))
        if any(a is not None and b is not None and max(a, b) > rank for a, b in splits):
            raise ValueError(f"the token of rank {rank} is made of later ones: the ranks are not those of merges")
        return False

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the merges leave `a` and `b` side by side in the text of both."""
        known = self.known.get((a, b))
        if known is None:
            if len(self.known) >= COMPATIBLE:
                self.known.clear()
            known = self.known[a, b] = self._side_by_side(a, b)
        return known

    def _side_by_side(self, a: int, b: int) -> bool:
        # A merge across the border would have come before whichever merge has been undone last.
        before = sys.maxsize
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < before:
                return False
            whole_a, whole_b = self.parts[a][0] == a, self.parts[b][0] == b
            if whole_a and whole_b:
                return True
            # The later merge is undone first; of two equal ones the right, as the left comes first.
            if not whole_a and (whole_b or a > b):
                before, a = a, self.parts[a][1]
            else:
                before, b = b + 1, self.parts[b][0]

    def encode(self, match: str) -> array:
        """Ids of one match of the pattern, given as Latin-1 characters."""
        whole = self.id_of.get(match)
        if whole is not None:
            return array("I", [whole])
        size, length = len(match), self.length
        longest = array("I", bytes(4 * size))
        for last, token in self.automaton.iter(match):  # of tokens from one position the longest comes last
            longest[last - length[token] + 1] = token
        open_ = bytearray(b"\1") * (size + 1)
        out, at = array("I"), 0
        token: int | None = longest[0]
        while True:
            left = out[-1] if out else None
            while token is not None and not (open_[at + length[token]]
                                             and (left is None or self.neighbours(left, token))):
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                at += length[token]
                if at == size:
                    return out
                token = longest[at]
            else:
                open_[at] = 0
                token = out.pop()
                at -= length[token]


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes; the mapping remembers matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        super().__init__()
        self.vocabulary, self.find, self.older = Vocabulary(ranks), regex.compile(pattern).findall, {}

    def __missing__(self, match: str) -> bytes:
        found = self.older.get(match)
        if found is None:
            ids = self.vocabulary.encode(match.encode().decode("latin-1"))
            if sys.byteorder == "big":
                ids.byteswap()
            found = ids.tobytes()
        if len(match) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[match] = found
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, self.find(part))) for part in parts(text))

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, numbers))


def parts(text: str) -> Iterator[str]:
    """`text` in order, cut before single blanks between other characters, beyond every PIECE characters.

    No match of a pattern that takes at most a leading blank with a word spans such a place.
    """
    start, size = 0, len(text)
    while size - start > PIECE:
        cut = text.find(" ", start + PIECE)
        while 0 <= cut and (cut + 1 >= size or text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def with_ids(docs: DataFrame, ranks: dict[bytes, int], pattern: str, column: str = "text",
             out: str = "ids") -> DataFrame:
    """`docs` with the binary `out`: ids of the text as little-endian unsigned 32-bit integers."""
    name = _name(ranks, pattern)

    def encoded(texts: pa.Array) -> pa.Array:
        encoder = kept(name, lambda: Encoder(ranks, pattern))
        return pa.array([encoder.encode(t.decode("utf-8", "replace") if t else "") for t in utf8(texts)], pa.binary())
    return docs.withColumn(out, F.arrow_udf(encoded, "binary")(F.col(column)))


def with_text(docs: DataFrame, ranks: dict[bytes, int], pattern: str, ids: str = "ids",
              out: str = "decoded") -> DataFrame:
    """`docs` with the binary `out`: the bytes that the ids stand for; null for null."""
    name = _name(ranks, pattern)

    def decoded(column: pa.Array) -> pa.Array:
        encoder = kept(name, lambda: Encoder(ranks, pattern))
        return pa.array([None if i is None else encoder.decode(i) for i in utf8(column)], pa.binary())
    return docs.withColumn(out, F.arrow_udf(decoded, "binary")(F.col(ids)))


def round_trips(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text; ids and texts stay in their task."""
    name = _name(ranks, pattern)

    def digests(batches):
        encoder = kept(name, lambda: Encoder(ranks, pattern))
        for batch in slices(batches):
            n, of_ids, of_text = [], [], []
            for text in utf8(batch.column(1)):
                ids = encoder.encode(text.decode("utf-8", "replace") if text else "")
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _name(ranks: dict[bytes, int], pattern: str) -> str:
    listed = b"\n".join(b"%b %d" % (base64.b64encode(t), r) for t, r in sorted(ranks.items()))
    return "byte_bpe " + hashlib.sha256(listed + pattern.encode()).hexdigest()
