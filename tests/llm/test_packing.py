"""Ids as the tokenizer gives them, bins as plain first-fit decreasing, round trip, edge cases."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallywise.llm import packing as P
from tallywise.llm import queries

PATH = public_tokenizers.path(queries.TOKENIZER)
ODD = [None, "", " ", "\n\n", "It's we'll  don't\tx y z", "a\x1cb\x85c", "ÀÉ é ño ́x ΑΣ ΑΣ. İ",
       "<|endoftext|> a<|startoftext|>b", "12 3.45% &c", "字 🙂🙂 ‍", "x" * 9000, "\r\nline\r\n", "STRASSE Straße, ÅØÞ! ÿ× ÷a a\u00ad\xa0b ª º µ", "don't. 's x're (end). a--b"]


def plain_ids(texts):
    model = Tokenizer.from_file(PATH)
    return [model.encode(t or "", add_special_tokens=False).ids + [P.END_ID] for t in texts]


def test_ids_as_of_whole_texts(spark, folder):
    texts = ODD + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = list(P.ChunkTokenizer(PATH).ids(texts))
    assert [np.frombuffer(g, "<u4").tolist() + [P.END_ID] for g in got] == plain_ids(texts)


def test_direct_words_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 3)
    tokenizer = P.ChunkTokenizer(PATH)
    assert tokenizer.direct
    texts = ["Äpfel, und Öl! one TWO three four. five; six (seven) éè", *ODD]
    got = [np.frombuffer(g, "<u4").tolist() + [P.END_ID] for g in tokenizer.ids(texts)]
    tokenizer.direct = False
    again = [np.frombuffer(g, "<u4").tolist() + [P.END_ID] for g in tokenizer.ids(texts)]
    assert got == again == plain_ids(texts) and len(tokenizer) <= 3


def test_tree_as_plain_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 200):
        sizes = sorted((rng.randrange(1, 101) for _ in range(n)), reverse=True)
        room, want = [], []
        for s in sizes:
            k = next((k for k, r in enumerate(room) if r >= s), len(room))
            if k == len(room):
                room.append(100)
            want.append((k, 100 - room[k]))
            room[k] -= s
        assert P.first_fit_decreasing(sizes, 100) == want


def test_query(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = dict(zip(docs, plain_ids(docs.values())))
    got = sorted(queries.op5_first_fit_packing(spark, folder).collect(), key=lambda r: (r.doc_id, r.start))
    for doc, rows in itertools.groupby(got, key=lambda r: r.doc_id):
        at = 0
        for r in rows:
            part = ids[doc][r.start:r.start + r.length]
            assert r.start == at and len(part) == r.length > 0 and r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(ids.pop(doc))
    assert not ids
    got.sort(key=lambda r: (r.sequence_id, r.offset))
    bins = [list(rows) for _, rows in itertools.groupby(got, key=lambda r: r.sequence_id)]
    for rows in bins:
        assert [r.offset for r in rows] == list(itertools.accumulate([r.length for r in rows[:-1]], initial=0))
        assert sum(r.length for r in rows) <= P.LENGTH
    used = sum(r.length for r in got)
    assert len(bins) * P.LENGTH <= 1.05 * used + P.LENGTH


def test_round_trip_in_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECES_PER_GROUP", 3)
    rows = [(k if k != 3 else None, t, "x") for k, t in enumerate(ODD)] + [(0, "again", "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    pieces = P.pack(docs, PATH, length=64, with_ids=True)
    got = pieces.collect()
    assert sum(r.length for r in got) == sum(map(len, plain_ids([t for _, t, _ in rows])))
    whole = {r.sequence_id: bytes(r.ids) for r in P.sequences(pieces).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    assert max(map(len, whole.values())) <= 4 * 64
    assert P.pack(docs.limit(0), PATH).count() == 0
