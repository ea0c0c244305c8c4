"""Fingerprints bit by bit, links against all pairs, components, edge cases."""

import random
import re

import numpy as np
import xxhash

from tallywise.llm import simhash as S


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(pairs):
    """(id, fingerprint) -> id -> smallest id linked."""
    ids = [d for d, _ in pairs]
    prints = np.array([f for _, f in pairs], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= S.RADIUS
    label = {}
    for k in np.argsort(ids):
        if k in label:
            continue
        stack = [k]
        label[k] = ids[k]
        while stack:
            for j in np.flatnonzero(near[stack.pop()]):
                if j not in label:
                    label[j] = ids[k]
                    stack.append(j)
    return {ids[k]: v for k, v in label.items()}


def test_fingerprints():
    texts = [None, "", " \n\t", "One", "one two", "a b c", "Äpfel ÄPFEL z\x0by\x0cx\xa0w 字 " * 40, "x " * 3000]
    assert [S.text_fingerprint(t and t.encode()) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_query_as_all_pairs(spark, folder):
    from tallywise.llm import queries
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = queries.op2_simhash_near_dedup(spark, folder).collect()
    assert len(got) == len(docs)
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert prints == {r.doc_id: slow_fingerprint(r.text) for r in docs}
    assert {r.doc_id: r.component_id for r in got} == slow_components(sorted(prints.items()))


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    codes = np.unique(np.concatenate([
        [centre ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 32, (300, 2))],
        (centre & ~np.uint64(2**32 - 1)) | rng.integers(0, 2**32, 500, dtype=np.uint64)]))
    ranks = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(s)
    codes = codes[np.argsort(ranks)]
    q, found = S.GrayTree(codes).search(codes, S.RADIUS)
    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= S.RADIUS
    assert set(zip(q.tolist(), found.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_dense_groups_and_chains(spark, monkeypatch):
    monkeypatch.setattr(S, "FLUSH_ROWS", 50)
    rng = random.Random(2)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)}
        for _ in range(60):  # a chain of single steps
            centre ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(centre)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    from tallywise.llm.common import components
    got = components(S.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"))).collect()
    want = slow_components([(p, p & 2**64 - 1) for p in signed])
    assert {r.node: r.component for r in got} | {
        p: p for p in signed if p not in {r.node for r in got}} == want


def test_edges(spark):
    text = "some words that are repeated here in full"
    rows = [(5, text, "a"), (3, text, "a"), (3, text, "a"), (None, text, "a"), (7, None, None), (6, "", "b"),
            (8, "quite another text " * 50, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(map(tuple, S.near_duplicates(docs).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (None, 3), (7, 6), (6, 6), (8, 8)], key=str)
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 8]
    assert S.near_duplicates(docs.limit(0)).count() == 0
    alone = S.one_of_each(docs.where("doc_id IS NULL")).collect()
    assert [tuple(r) for r in alone] == [(None, text, "a")]
