"""What a sink leaves behind after repeated, empty and conflicting writes."""

import pytest
from pyspark.sql import functions as F

from tallywise.session import work_path
from tallywise.sources import sinks


def test_replace_by_an_empty_result(spark):
    path = work_path(spark, "t-replace")
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "user_id int, method string")
    sinks.replace_by_method(rows, path, "method", ["a", "b"])
    sinks.replace_by_method(rows.where("false"), path, "method", ["a"])
    assert [r.user_id for r in spark.read.parquet(path).collect()] == [3]
    with pytest.raises(ValueError, match="not among"):
        sinks.replace_by_method(rows, path, "method", ["a"])
    sinks.replace_all(rows.where("method = 'a'"), path, "method")
    assert {r.user_id for r in spark.read.parquet(path).collect()} == {1, 2}


def test_ids_go_on(spark):
    path = work_path(spark, "t-ids")
    for part in ([(7, "x"), (5, "y")], [(1, "z")], []):
        sinks.append_transactions(spark.createDataFrame(part, "user_id int, city string"), path)
    got = {r.city: r.transaction_id for r in spark.read.parquet(path).collect()}
    assert got == {"y": 1, "x": 2, "z": 3}


def test_upsert_takes_the_last_write(spark):
    old = spark.createDataFrame([(1, "z", {"k": 1}), (2, "keep", None)], "id int, v string, m map<string,int>")
    new = spark.createDataFrame([(1, "b", {"k": 2}, 2), (1, "y", None, 1), (3, None, None, 5)],
                                "id int, v string, m map<string,int>, at int")
    got = {r.id: (r.v, r.m) for r in sinks.upsert(old, new, ["id"], "at").collect()}
    assert got == {1: ("b", {"k": 2}), 2: ("keep", None), 3: (None, None)}
    with pytest.raises(Exception, match="share a place"):
        sinks.upsert(old, new.withColumn("at", F.lit(1)), ["id"], "at").collect()
