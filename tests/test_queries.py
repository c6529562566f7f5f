"""Every query against its SQL on the smallest tables, and the load patterns' odd cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strandline.operators import patterns
from strandline.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data, name):
    found = QUERIES[name](spark, data)
    cols = sorted(found.columns)
    d = duck.execute(SQL[name])
    names = [x[0] for x in d.description]
    assert sorted(names) == cols
    assert sorted(repr([r[c] for c in cols]) for r in found.collect()) == sorted(repr([r[names.index(c)] for c in cols]) for r in d.fetchall())


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["ultimate_source", "ultimate_target", "hops"]


def test_not_in_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    with_null = spark.createDataFrame([(1,), (None,)], "b int")
    assert patterns.not_in(left, "a", with_null).collect() == []
    assert [r[0] for r in patterns.not_in(left, "a", with_null.filter("b = 1")).collect()] == [2]
    assert patterns.not_in(left, "a", with_null.filter("b > 9")).count() == 3


def test_top_with_ties_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("k", 3), ("k", 3), ("n", None)], "k string, v int")
    assert sorted(map(repr, patterns.top_with_ties(df, ["k"], "v").collect())) == sorted(map(repr, df.filter("v = 2 or k is not null").collect()))


def test_upsert_and_update(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert sorted((r.k, r.v) for r in patterns.update_from(t, s, ["k"], {"v": F.col("s.v")}).collect()) == [(1, "a"), (2, None)]
    assert sorted((r.k, r.v) for r in patterns.upsert(t, s, ["k"]).collect()) == [(1, "a"), (2, None), (3, "c")]
    for twice in (lambda: patterns.update_from(t, s.union(s), ["k"], {"v": F.col("s.v")}), lambda: patterns.upsert(t, s.union(s), ["k"])):
        with pytest.raises(Exception, match="a key stands twice"):
            twice().collect()


def test_older(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("a", 1, 2), ("a", 0, 9), ("b", 5, 5)], "k string, x int, y int")
    assert sorted((r.k, r.x, r.y, r.older) for r in patterns.older(rows, ["k"], ["x", "y"]).collect()) == [("a", 0, 9, 0), ("a", 1, 1, 1), ("a", 1, 1, 1), ("a", 1, 2, 3), ("b", 5, 5, 0)]
