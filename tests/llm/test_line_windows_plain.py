"""Line windows of the given documents against a plain version."""

from tallywise.llm import line_windows

BLANKS = " \t\r\x0b\x0c"


def plain_windows(rows):
    """doc_id -> text without the lines of later windows; rows are (doc_id, text), ids distinct."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        lines = text.split("\n")
        plain = [x.strip(BLANKS) for x in lines]
        gone = set()
        for k in range(len(lines) - 2):
            key = tuple(plain[k:k + 3])
            if any(key) and first.setdefault(key, (doc, k)) != (doc, k):
                gone |= {k, k + 1, k + 2}
        out[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_as_plain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r.text for r in line_windows.without_repeats(docs).collect()}
    assert got == plain_windows([(r.doc_id, r.text) for r in docs.collect()])
