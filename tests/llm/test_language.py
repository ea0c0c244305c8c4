"""Held-out accuracy, mixtures, edge cases."""

import random

import pytest

from tallywise.llm import language as L
from tallywise.llm import queries

SYLLABLES = {"aa": "ka to mi re no shi".split(), "bb": "schw ung eit ver lich ge".split(),
             "cc": "tion eau que les ent aux".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(k, text(rng, lang, 60), lang) for k in range(60) for lang in SYLLABLES]
    return L.fit(spark.createDataFrame(rows + [(1, None, "aa"), (2, "x", None)], "doc_id long, text string, lang string"))


def test_mixtures(model):
    rng = random.Random(2)
    for a, b in (("aa", "bb"), ("bb", "cc"), ("cc", "aa")):
        alone = L.infer(model, text(rng, a, 50))
        assert [lang for lang, _ in alone] == [a] and alone[0][1] == pytest.approx(1)
        both = dict(L.infer(model, text(rng, a, 90) + ". " + text(rng, b, 45)))
        assert set(both) == {a, b} and sum(both.values()) == pytest.approx(1) and both[a] > both[b] > 0.15
    assert len(L.infer(model, " ".join(text(rng, x, 80) for x in SYLLABLES))) == 3


def test_held_out_documents(spark, folder):
    got = queries.op10_mixture_language_id(spark, folder).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    right = sum(r.lang_pred == lang[r.doc_id] for r in held)
    assert right >= 0.97 * len(held) and len(got) == len(lang)


def test_edges(spark, model):
    rows = [(1, None, "x"), (1, "", "x"), (2, "12 %% \n", "x"), (None, text(random.Random(3), "bb", 20000), "x"),
            (3, "字", "x"), (4, "É", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, language string")
    got = [(r.language.lang_pred, r.language.score) for r in L.with_language(docs, model).collect()]
    assert got[:3] == [(L.UNKNOWN, 0.0)] * 3 and got[3] == ("bb", 1.0)
    assert all(p in SYLLABLES and 0 <= s <= 1 for p, s in got[4:])
    assert L.with_language(docs.limit(0), model).count() == 0
    none = L.fit(docs.withColumn("lang", docs.language).where("doc_id < 0"))
    assert {r.language.lang_pred for r in L.with_language(docs, none).collect()} == {L.UNKNOWN}
