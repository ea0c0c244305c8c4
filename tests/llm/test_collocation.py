"""Counts and ranks against brute force, also where hot phrases are dealt out by more words."""

import collections
import random
import re

import numpy as np
import pytest

from tallywise.llm import collocation, queries


def brute(rows, most=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]", piece) if w]
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    counts["und" if lang is None else lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if c >= 30 and len(p) > 1}
        covered = collections.Counter()
        for p, c in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i:i + m]] = max(covered[p[i:i + m]], c)
        found = []
        for p, a in often.items():
            if 100 * covered[p] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame([(k % 3, t, lang, "mine", 1) for k, (t, lang) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, rank int")
    return sorted(map(tuple, collocation.collocations(df.repartition(5), **more).collect()))


def texts(seed, n, words):
    rng = random.Random(seed)
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "; "]
    return [("".join(rng.choice(words)[:9] + rng.choice(marks) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "de", None, ""])) for _ in range(n)]


WORDS = ["the", "The", "of", "house", "straße", "Ärger", "ärger", "x", "don't", "a-b", "日本", " y", "z\x1c", "\x00"]


@pytest.mark.parametrize("hot, tasks", [(20_000, 10**9), (8, 500), (3, 500)])
def test_equals_brute_force(spark, monkeypatch, hot, tasks):
    monkeypatch.setattr(collocation, "HOT", hot)
    monkeypatch.setattr(collocation, "FEW", 2)
    monkeypatch.setattr(collocation, "SUFFIXES_PER_TASK", tasks)
    monkeypatch.setattr(collocation, "FLUSH_WORDS", 300)
    rows = texts(4, 700, WORDS) + [("one very common line of many words", "en")] * 200
    assert got(spark, rows) == brute(rows)


def test_given_documents(spark, folder):
    rows = [(r.text, r.lang) for r in queries.table(spark, folder, "documents").collect()]
    found = sorted(map(tuple, queries.op13_suffix_collocations(spark, folder).collect()))
    assert found and found == brute(rows)


def test_edges(spark):
    assert got(spark, []) == []
    rows = [(None, None), ("", "en"), (" ,. \n", "en"), ("word", "en"), ("a b", None), ("a b", None)]
    assert got(spark, rows) == []
    assert got(spark, [("a b c", "en")] * 29) == []
    assert got(spark, [("A b\tc", "en")] * 30) == [("en", 1, "a b c", 30, 30, 30, 90, 1_000_000)]
    long = [("a b " * 50_000 + "c", None), (None, "en")]
    assert got(spark, long) == brute(long)
    ties = [(w, "en") for w in ("b c", "a d", "ä e", "z f") for _ in range(40)]
    assert got(spark, ties, most=3) == brute(ties, 3) and [r[2] for r in got(spark, ties)] == ["a d", "b c", "z f", "ä e"]


def test_counted_prefixes(monkeypatch):
    monkeypatch.setattr(collocation, "SMALL", 16)
    rng = np.random.default_rng(6)
    for complete in (2, 3, 4):
        rows = np.minimum(rng.geometric(0.2, size=(4000, 4)), 12) - 1
        rows[:, 0] += 1
        for k in range(1, 4):
            rows[rows[:, k - 1] == 0, k] = 0
        weight = rng.integers(1, 4, len(rows))
        want = collections.Counter()
        for row, w in zip(rows.tolist(), weight.tolist()):
            for size in (2, 3, 4):
                if row[size - 1] > 0:
                    want[tuple(row[:size])] += w
        want = {p: c for p, c in want.items() if c >= 30 or len(p) < complete}
        found = [(tuple(rows[at, :size].tolist()), c) for size, at, c in
                 collocation.counted_prefixes(list(rows.T), weight, 30, complete)]
        assert len(found) == len(want) and dict(found) == want


def test_filter_holds_the_frequent_words(spark):
    words = ["der", "straße", "日本", "x"]
    bits = collocation._filter(spark.createDataFrame([(w,) for w in words], "phrase string"))
    assert collocation._holds(bits, [w.encode() for w in words]).all()
    assert not collocation._holds(bits, [b"other", b"words"]).any()
