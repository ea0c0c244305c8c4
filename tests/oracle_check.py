"""Compare every registered query with its SQL twin: python tests/oracle_check.py [sf] [names]."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _norm(v)) for k, v in value.items()))
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str:
    """'' when equal, otherwise what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    kinds = {d[0]: str(d[1]) for d in res.description}
    expect = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for field in df.schema.fields:
        want = KINDS.get(field.dataType.simpleString())
        if want and want != kinds[field.name]:
            return f"type of {field.name}: {want} != {kinds[field.name]}"
    got = df.collect()
    if len(got) != len(expect):
        return f"rows {len(got)} != {len(expect)}"
    for a, b in zip(_rows(df.columns, got), _rows(names, expect)):
        if a != b:
            return f"first difference (columns {sorted(names)})\n  spark {a}\n  sql   {b}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from tallywise.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problem = compare(df, con, oracle[name]) if name in oracle else ""
            note = "ok" if name in oracle else f"rows {df.count()}"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
            if only:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{name}: {problem or note} ({time.time() - start:.1f}s)", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
