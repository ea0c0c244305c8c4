"""Links and components against brute force, recall of the index, edge cases."""

import numpy as np

from tallywise.llm import multi_index as M


def brute(ids, vectors):
    u = M.unit_vectors(np.asarray(vectors, np.float64))
    near = u @ u.T >= M.THRESHOLD
    np.fill_diagonal(near, False)
    label = {}
    for k in np.argsort(ids):
        if k in label:
            continue
        label[k], stack = ids[k], [k]
        while stack:
            for j in np.flatnonzero(near[stack.pop()]):
                if j not in label:
                    label[j] = ids[k]
                    stack.append(j)
    return {ids[k]: (int(near[k].sum()), label[k]) for k in range(len(ids))}


def test_multi_sequence_is_the_order_of_sums():
    rng = np.random.default_rng(0)
    left, right = rng.random((20, 9)), rng.random((20, 7))
    for visits in (1, 5, 20, 63, 99):
        got = M.multi_sequence(left, right, visits)
        want = np.argsort((left[:, :, None] + right[:, None, :]).reshape(20, -1), axis=1)[:, :visits]
        assert (got == want).all()


def test_groups_chains_and_copies(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL_BLOCK", 16)
    monkeypatch.setattr(M, "QUERY_BLOCK", 32)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 16))
    dense = base[0] + rng.normal(size=(120, 16)) * 0.25
    pairs = base[20:60] + rng.normal(size=(40, 16)) * 0.08
    vectors = np.concatenate([base, dense, pairs, np.repeat(base[1:3], 30, axis=0)])
    ids = rng.permutation(len(vectors)).tolist()
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors)]
    got = {r.vec_id: r for r in M.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = brute(ids, vectors)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.95 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_is_that_of_the_whole_table(spark, monkeypatch):
    """The codebooks see a small part of the rows; the queries' links are counted over all of them."""
    monkeypatch.setattr(M, "FIT_ROWS", 60)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 16))
    vectors = np.concatenate([base, base + rng.normal(size=base.shape) * 0.1])
    rows = spark.createDataFrame([(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)],
                                 "site long, embedding array<double>, copies long")
    index = M.fit_index(rows, len(vectors), M.THRESHOLD)
    assert 0.9 <= index.recall <= 1 and M.LEAST_VISITS <= index.visits <= M.MOST_VISITS


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0, 1.0], 5), (2, [2.0, 0.0, 0.0, 2.0], 5), (3, None, 5), (4, [], 5), (5, [0.0] * 4, 5),
            (6, [nan, 1.0, 0.0, 0.0], 5), (7, [inf, 1.0, 0.0, 0.0], 5), (8, [None, 1.0, 0.0, 0.0], 5),
            (9, [1.0, 0.0], 5), (10, [0.0, 1.0, 0.0, 0.0], 5), (0, [1.0, -0.0, 0.0, 1.0], 5), (12, [0.0] * 4, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in M.near_duplicates(frame).collect()}
    want = {k: (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 12)} | {
        0: (2, 0, True), 1: (2, 0, False), 2: (2, 0, False)}
    assert got == want
    assert M.near_duplicates(frame.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in M.near_duplicates(same).collect()] == [(1, 1, 1, True)] * 2


def test_each_width_is_compared_with_itself(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(5)] + [(k, [1.0, 0.5]) for k in range(10, 12)] + [
        (20, [2.0, 4.0, 6.0]), (21, [0.0, 1.0, 0.0]), (22, [2.0, 1.1]), (30, [1.0]), (31, [2.0]), (32, [-1.0]), (33, [1.0] * 5)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in M.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[k][:2] == (5, 0) for k in (0, 1, 2, 3, 4, 20)) and got[21] == (0, 21, True)
    assert all(got[k][:2] == (2, 10) for k in (10, 11, 22))
    assert got[30][:2] == (1, 30) and got[31] == (1, 30, False) and got[32] == (0, 32, True) and got[33] == (0, 33, True)
