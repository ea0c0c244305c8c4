"""Repeated windows and units: edge cases; whole tables are compared with SQL in test_oracles."""

from tallywise.llm import line_windows, unit_dedup

A, B, C, X = "first line", "second line", "third line", "only here"


def test_later_windows_go(spark):
    docs = spark.createDataFrame(
        [(2, "\n".join([X, A, B, " " + C + " ", "end"]), 1), (1, "\n".join([A, B, C]), 2),
         (3, "\n".join([A, B]), 3), (4, None, 4), (5, "", 5), (6, "\n\n\n\n", 6), (7, "\n".join([A, B, C] * 3), 7),
         (7, "another text", 8), (None, "\n".join([X, X, X, X]), 9)],
        "doc_id long, text string, covered int")
    got = {r.covered: (r.doc_id, r.text, r.n_lines, r.n_removed)
           for r in line_windows.without_repeats(docs).collect()}
    assert got == {
        1: (2, f"{X}\nend", 5, 3), 2: (1, f"{A}\n{B}\n{C}", 3, 0), 3: (3, f"{A}\n{B}", 2, 0), 4: (4, None, 0, 0),
        5: (5, "", 1, 0), 6: (6, "\n\n\n\n", 5, 0),
        # The windows (B, C, A) and (C, A, B) first occur here, the lines of later ones go.
        7: (7, "", 9, 9), 8: (7, "another text", 1, 0), 9: (None, X, 4, 3)}
    assert line_windows.without_repeats(docs.limit(0)).count() == 0


def test_rows_equal_in_all_stay(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc")] * 2, "doc_id long, text string")
    assert [r.n_removed for r in line_windows.without_repeats(docs).collect()] == [0, 0]


def test_units(spark):
    long = " ".join(f"Word{k}" for k in range(60))
    other = " ".join(f"term{k}" for k in range(25))
    rows = [(9, f"é head\n{long}\ntail"), (4, f"{long.lower().replace(' ', '  ')}\nown words"), (5, None), (6, ""),
            (7, "short\nshort"), (8, f"{other}\n{other}"), (None, "x")]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, removed string")
    spans = {(r.doc_id, r.start, r.end, r.first_doc_id, r.first_start)
             for r in unit_dedup.repeated_units(docs).collect()}
    n = len(other)
    assert spans == {(9, 7, 7 + len(long), 4, 0), (8, n + 1, 2 * n + 1, 8, 0)}
    texts = {r.doc_id: r.text for r in unit_dedup.without_repeats(docs).collect()}
    assert texts[9] == "é head\ntail" and texts[8] == other + "\n" and texts[5] is None and texts[6] == ""
    assert unit_dedup.repeated_units(docs.limit(0)).count() == 0


def test_passages_within_lines(spark):
    passage = ("It starts here with some words. Then it goes on for quite a while! No. "
               "Was that all there is to say about it? At last the passage ends in this sentence.")
    rows = [(1, f"Own words before it {passage} own words behind it."), (2, f"other words {passage} more of them."),
            (3, f"A text of its own. {passage}"), (4, "At last the passage ends in this sentence."),
            (5, "No. Then it goes on for quite a while! And so on and on.")]
    got = {r.doc_id: r for r in unit_dedup.repeated_units(
        spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()}
    assert set(got) == {2, 3}
    for doc, text in rows[1:3]:
        assert text[got[doc].start:got[doc].end] == passage[passage.index("Then"):]
        assert got[doc].first_doc_id == 1 and got[doc].n_units == 3


def test_equal_rows_keep_their_units(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (2, text)], "doc_id long, text string")
    assert sorted(r.doc_id for r in unit_dedup.without_repeats(docs).where("removed IS NULL").collect()) == [1, 1]
    assert [r.doc_id for r in unit_dedup.repeated_units(docs).collect()] == [2]
