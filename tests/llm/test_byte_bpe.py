"""Ids against the tiktoken library, and back."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from tallywise.llm import byte_bpe, queries

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    ranks = byte_bpe.ranks_of(public_tokenizers.path(request.param))
    return (byte_bpe.Encoder(ranks, public_tokenizers.PATTERN),
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


def same(pair, text):
    ids = pair[0].encode(text)
    return array("I", ids).tolist() == pair[1].encode_ordinary(text) and pair[0].decode(ids) == text.encode()


def test_random_texts(pair):
    rng = random.Random(8)
    tokens = list(pair[0].vocabulary.bytes_of.values())
    for k in range(3000):
        n = rng.randint(1, 30)
        text = [lambda: "".join(rng.choice("abe") for _ in range(n)),
                lambda: "".join(rng.choice("aA -_=\n\t'") for _ in range(n)),
                lambda: "".join(chr(rng.choice([rng.randint(32, 591), rng.randint(0x400, 0xd7ff),
                                                rng.randint(0x1f300, 0x1f6ff)])) for _ in range(n)),
                lambda: b"".join(rng.choice(tokens) for _ in range(6)).decode("utf-8", "replace"),
                lambda: "".join(rng.choice(tokens).decode("utf-8", "ignore").strip() for _ in range(8))][k % 5]()
        assert same(pair, text), text


def test_every_token(pair):
    for token in pair[0].vocabulary.bytes_of.values():
        text = token.decode("utf-8", "ignore")
        assert same(pair, text), text


@pytest.mark.parametrize("text", ["a" * 60_000, " " * 60_000, "ab" * 30_000, "=-" * 30_000 + "\n" * 9, "é" * 20_001])
def test_long_matches(pair, text):
    assert same(pair, text)


def test_texts_read_in_parts(pair, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE", 20)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["word", "it's", " ", " ", "  ", "\n", " ", "12", "!!", " "])
                       for _ in range(80))
        assert "".join(byte_bpe.parts(text)) == text and same(pair, text), text


def test_remembered_matches_are_bounded(pair, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    encoder = pair[0]
    encoder.clear()
    encoder.older = {}
    for k in range(400):
        assert same(pair, f"w{k} again {k % 7}")
    assert len(encoder) <= 50 and len(encoder.older) <= 51


def test_tokens_that_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"zz": 257, b"zzzz": 258}
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "xabc", "abcabc", "bc", "abbc", "zzzzz", "z" * 9):
        assert array("I", encoder.encode(text)).tolist() == plain.encode_ordinary(text)
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257})


def test_query(spark, folder):
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.RANKS))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in queries.table(spark, folder, "documents").collect():
        ids = plain.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    found = queries.op12_backtracking_bpe(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_columns_and_odd_rows(spark):
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.RANKS))
    rows = [(1, None, "x"), (1, "", "x"), (None, "a text", "x"), (1, "a text", "x"), (2, "no blanks " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    for some in (docs, docs.limit(0)):
        there = byte_bpe.with_ids(some, ranks, public_tokenizers.PATTERN)
        back = byte_bpe.with_text(there, ranks, public_tokenizers.PATTERN, out="again").collect()
        assert [bytes(r.again).decode() for r in back] == [r.text or "" for r in back]
        assert len(back) == some.count() and all(r.decoded == "x" for r in back)
        assert byte_bpe.round_trips(some, ranks, public_tokenizers.PATTERN).count() == some.count()
