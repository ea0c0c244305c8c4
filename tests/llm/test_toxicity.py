"""Held-out accuracy, edge cases."""

import random

import pytest

from tallywise.llm import toxicity as T


def corpus(n, seed):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ba", "do", "ki", "lu") for b in ("ren", "tos", "mal", "vi", "nu")]
    rows = []
    for k in range(n):
        toxic = int(rng.random() < 0.2)
        words = rng.choices(plain, k=rng.randrange(30, 90))
        if toxic:
            for w in rng.sample(["vile", "nasty", "awful", "rotten"], 2):
                words.insert(rng.randrange(len(words)), w.title())
        rows.append((k, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.createDataFrame(corpus(1200, 1), "doc_id long, text string, toxic int")
    return T.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))


def test_held_out(spark, fitted):
    rows = spark.createDataFrame(corpus(400, 2), "doc_id long, text string, label int")
    got = T.with_toxicity(rows, fitted).collect()
    right = sum((r.toxicity >= T.THRESHOLD) == bool(r.label) for r in got)
    assert right >= 0.98 * len(got)
    assert 0 < (fitted.weights != 0).sum() < 5000


def test_one_class_alone_counts_by_evidence(spark):
    rows = spark.createDataFrame([(k, "same words here", 0) for k in range(50)], "doc_id long, text string, toxic int")
    model = T.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert T.with_toxicity(rows, model).first().toxicity < T.THRESHOLD


def test_edges(spark, fitted):
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "vile nasty " * 30000, "c"), (None, "字 🙂", "d")],
                                 "doc_id long, text string, toxicity string")
    got = [r.toxicity for r in T.with_toxicity(rows, fitted).collect()]
    assert all(0 <= x <= 1 for x in got) and got[0] == got[1] < T.THRESHOLD < got[2]
    empty = rows.limit(0)
    assert T.with_toxicity(empty, fitted).count() == 0
    none = T.fit(rows.select("doc_id", "text"), spark.createDataFrame([(9, None)], "doc_id long, toxic int"))
    assert {r.toxicity for r in T.with_toxicity(rows, none).collect()} == {0.0}


def test_repeated_labels_take_the_largest(spark):
    docs = spark.createDataFrame([(k, "vile" if k % 2 else "kind") for k in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0) for k in range(80)] + [(k, 1) for k in range(1, 80, 2)],
                                   "doc_id long, toxic int")
    got = T.with_toxicity(docs, T.fit(docs, labels)).collect()
    assert all((r.toxicity > 0.5) == (r.text == "vile") for r in got)
