"""Overlaps with benchmark items: planted passages, brute force, edge cases."""

import random
import re
from pathlib import Path

import pytest

from tallywise.llm import decontamination as D
from tallywise.session import shared_dir

WORDS = [f"w{k}x" for k in range(400)]


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def brute(docs, items):
    """Pairs whose texts have an alignment with an overlap that counts; every shift is compared."""
    found = set()
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    for item_id, item in items:
        b = split(item)
        for doc_id, text in docs:
            a = split(text)
            for shift in range(-len(b), len(a)):
                at = [p for p in range(len(a)) if 0 <= p - shift < len(b) and a[p] == b[p - shift]]
                run = []
                for p in [*at, 10**9]:
                    if run and p - run[-1] > D.MAX_GAP:
                        length = run[-1] + 1 - run[0]
                        if length >= min(D.MIN_TOKENS, len(b)) and len(run) >= D.MIN_SHARE * length:
                            found.add((doc_id, item_id))
                        run = []
                    run.append(p)
    return found


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, 15 + 4 * k))) for k in range(8)]
    docs = []
    for k in range(40):
        body = words(rng, 60)
        item = items[k % 8][1].split()
        if k < 8:
            body[20:20] = item
        elif k < 16:
            body[20:20] = [w if j % 7 != 3 else "swapped" for j, w in enumerate(item)]
        elif k < 24:
            body[10:10] = item[1:15]
        docs.append((k, " ".join(body).upper() if k % 2 else ", ".join(body)))
    return docs, items


def test_as_brute_force(spark, planted):
    docs, items = planted
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"))
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert pairs == brute(docs, items)
    assert {d for d, _ in pairs} >= set(range(16)) and not {d for d, _ in pairs} & set(range(24, 40))


def test_several_blocks_give_the_same(spark, planted, monkeypatch):
    docs, items = planted
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"))
    once = D.contaminated(*frames).collect()
    monkeypatch.setattr(D, "SEEDS_PER_BLOCK", 300)
    assert sorted(map(tuple, D.contaminated(*frames).collect())) == sorted(map(tuple, once))


def test_leaves_no_tables_behind(spark, planted):
    docs, items = planted
    stored = lambda: sorted(Path(shared_dir(spark)).rglob("*.parquet"))
    before = stored()
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"))
    assert found.count() and stored() == before


def test_edges(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, item, "x"), (1, "other text", "x"), (None, item, "x"), (2, None, None), (3, "", "x"),
            (4, "so " * 5000, "x"), (5, "a b " * 5000 + item, "x"), (1, item, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, item), (8, item + "."), (9, None), (10, ""), (11, "so so " * 40)],
                                  "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert found == {(1, 7), (None, 7), (5, 7)}
    left = [tuple(r) for r in D.without_contaminated(docs, bench).select("doc_id", "item_id").collect()]
    assert sorted(left, key=str) == sorted([(1, "x"), (2, None), (3, "x"), (4, "x")], key=str)
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.contaminated(docs, bench.limit(0)).count() == 0
