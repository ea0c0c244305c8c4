"""Each stage against what it must keep, the whole against the stages one by one."""

import collections

import corpus_pipeline as C
import numpy as np
import pytest

from tallywise.llm import decontamination, language, line_windows, packing, queries, simhash
from test_line_windows_plain import plain_windows  # noqa: I001

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, kept = queries.table(spark, folder, "documents"), []
    kept.append(docs.collect())
    for _, stage in C.STAGES:
        docs = C.cut_lineage(stage(spark, docs, folder))
        kept.append(docs.collect())
    return kept


def test_names_and_columns(spark, folder, stages):
    assert len(C.STAGES) == 5 and C.ORACLE_SQL is None
    assert all(list(rows[0].asDict()) == COLUMNS for rows in stages[:5])


def test_language_keeps_all_with_letters(stages):
    before, after = stages[0], stages[1]
    lettered = {r.doc_id: r.text for r in before if r.text and any(map(str.isalpha, r.text))}
    assert {r.doc_id: r.text for r in after} == lettered


def test_lines(stages):
    want = {d: t for d, t in plain_windows([(r.doc_id, r.text) for r in stages[1]]).items() if t.strip()}
    assert {r.doc_id: r.text for r in stages[2]} == want
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_one_of_each_group(stages):
    prints = {r.doc_id: simhash.text_fingerprint(r.text.encode()) for r in stages[2]}
    kept = {r.doc_id for r in stages[3]}
    ids = sorted(prints)
    values = np.array([prints[d] for d in ids], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None]) <= simhash.RADIUS
    seen, heads = set(), set()
    for k, d in enumerate(ids):
        if d in seen:
            continue
        heads.add(d)
        queue = collections.deque([k])
        seen.add(d)
        while queue:
            for j in np.flatnonzero(near[queue.popleft()]):
                if ids[j] not in seen:
                    seen.add(ids[j])
                    queue.append(j)
    assert kept == heads


def test_leaks_go_and_clean_documents_stay(spark, folder, stages):
    items = [" ".join(r.text.lower().split()) for r in queries.table(spark, folder, "benchmark").collect()]
    holds = {r.doc_id for r in stages[3] if any(i in " ".join(r.text.lower().split()) for i in items)}
    kept = {r.doc_id for r in stages[4]}
    assert not holds & kept and len(kept) >= 0.98 * (len(stages[3]) - len(holds))


def test_packing_covers_the_last_documents(stages):
    tokens = collections.Counter()
    for r in stages[5]:
        tokens[r.doc_id] += r.length
    assert set(tokens) == {r.doc_id for r in stages[4]}
    ids = packing.ChunkTokenizer(queries.public_tokenizers.path(queries.TOKENIZER))
    assert all(tokens[r.doc_id] == len(next(ids.ids([r.text]))) // 4 + 1 for r in stages[4])


def test_run_is_the_last_stage(spark, folder, stages):
    assert sorted(map(tuple, C.run(spark, folder).collect())) == sorted(map(tuple, stages[5]))


def test_empty_and_odd_documents(spark, folder):
    rows = [(1, None, None, None, None), (None, "same words in both of these", "en", "s", 1),
            (2, "same words in both of these", "en", "s", 1), (2, "same words in both of these", "en", "s", 1),
            (3, "12 !", "en", "s", 1), (4, "", "en", "s", 1), (5, "very long text " * 40000, "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        now = some
        for _, stage in C.STAGES:
            now = stage(spark, now, folder)
        got = now.collect()
        assert {r.doc_id for r in got} == ({2, 5} if some is docs else set())


def test_stage_modules_are_the_operators():
    assert all(m.__name__.startswith("tallywise.llm.") for m in (language, line_windows, simhash, decontamination,
                                                                  packing))
