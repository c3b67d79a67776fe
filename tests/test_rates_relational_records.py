"""Rates, composition, prefix caps, latest-per-group, record maintenance."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from edulens.operators.rates import grouped_rate, guarded_ratio, share_of_group, weighted_mean
from edulens.operators.records import append_with_keys, constraint_report, delete_cascade, lookup, update_rows
from edulens.operators.relational import latest_per_group, members, prefix_by_key


def test_guarded_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(guarded_ratio("a", "b", 100.0)).collect()] == [None, None, 25.0, None]


def test_grouped_rate_and_weighted_mean(spark):
    df = spark.createDataFrame([("s1", 3.0, 10.0), ("s1", 1.0, 10.0), ("s2", 0.0, 0.0)], "k string, p double, t double")
    got = {r["k"]: r["rate"] for r in grouped_rate(df, ["k"], "p", "t", 100.0).collect()}
    assert got == {"s1": 20.0, "s2": None}
    att = spark.createDataFrame([("s", 10.0, 1.0), ("s", 20.0, 3.0), ("z", 5.0, 0.0)], "k string, x double, w double")
    got = {r["k"]: (r["wmean"], r["att"]) for r in weighted_mean(att, ["k"], "x", "w", complement=100.0,
                                                                 complement_name="att").collect()}
    assert got["s"] == (pytest.approx(17.5), pytest.approx(82.5)) and got["z"] == (None, None)


def test_share_of_group(spark):
    df = spark.createDataFrame([("s", "a", 1), ("s", "b", 3), ("t", "a", 0)], "k string, g string, n bigint")
    got = {(r["k"], r["g"]): r["share"] for r in share_of_group(df, ["k"], "n").collect()}
    assert got == {("s", "a"): 0.25, ("s", "b"): 0.75, ("t", "a"): None}


def test_prefix_is_exactly_n_rows(spark):
    df = spark.range(0, 30000).withColumn("k", (F.col("id") * 7) % 30011)
    assert sorted(r["k"] for r in prefix_by_key(df, 5, ["k"]).collect()) == [0, 1, 2, 3, 4]
    ks = sorted(r["k"] for r in prefix_by_key(df, 10_007, ["k"]).collect())
    assert ks == sorted(r["k"] for r in df.orderBy("k").limit(10_007).collect())
    assert prefix_by_key(df, 40000, ["k"]).count() == 30000 and prefix_by_key(df, 0, ["k"]).count() == 0


def test_prefix_with_null_keys_ties_and_no_job(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (None, 2), ("k1", 1), ("k2", 1)], "k string, v int")
    assert rows(prefix_by_key(df, 2, ["k"])) == [(None, 1), (None, 2)]
    assert rows(prefix_by_key(df, 4, ["k"])) == [("k1", 1), (None, 1), (None, 2), (None, 3)]
    tied = spark.range(50).selectExpr("'a' AS k", "id")
    spark.sparkContext.setJobGroup("prefix", "building")
    five = prefix_by_key(tied, 5, ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("prefix")
    assert sorted(r["id"] for r in five.collect()) == [0, 1, 2, 3, 4]


def test_latest_per_group_ties_prefer_higher_id(spark):
    t = dt.datetime(2025, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(1, t, "q", "1"), (2, t, "q", "1"), (3, t - dt.timedelta(seconds=5), "q", "1"),
                                (4, t, "r", "1")], "launch_id bigint, timestamp timestamp, query_name string, "
                                                   "query_version string")
    got = rows(latest_per_group(df, ["query_name", "query_version"], ["timestamp", "launch_id"])
               .select("query_name", "launch_id"))
    assert got == [("q", 2), ("r", 4)]


def test_members(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    allowed = spark.createDataFrame([("a",), ("c",), ("c",)], "k string")
    assert rows(members(df, ["k"], allowed)) == [("a", 1), ("c", 3)]


LAUNCH = "launch_id bigint, timestamp timestamp, query_name string, query_version string"
RESULT = "result_id bigint, launch_id bigint, dataset_size bigint, run_index int, elapsed_seconds double"


def test_append_with_keys_continues_after_max(spark):
    t = dt.datetime(2025, 1, 1)
    old = spark.createDataFrame([(5, t, "a", "1"), (9, t, "b", "1")], LAUNCH)
    new = spark.createDataFrame([(None, t + dt.timedelta(seconds=2), "c", "1"),
                                 (None, t + dt.timedelta(seconds=1), "d", "1")], LAUNCH)
    out = rows(append_with_keys(old, new, "launch_id", ["timestamp", "query_name"]).select("launch_id", "query_name"))
    assert out == [(10, "d"), (11, "c"), (5, "a"), (9, "b")]
    mixed = new.unionByName(spark.createDataFrame([(11, t, "e", "1")], LAUNCH))
    keyed = rows(append_with_keys(old, mixed, "launch_id", ["timestamp", "query_name"]).select("launch_id", "query_name"))
    assert sorted(keyed) == [(5, "a"), (9, "b"), (11, "e"), (12, "d"), (13, "c")]
    empty = spark.createDataFrame([], LAUNCH)
    assert rows(append_with_keys(empty, new, "launch_id", ["timestamp"]).select("launch_id")) == [(1,), (2,)]


def test_lookup_update_delete(spark):
    t = dt.datetime(2025, 1, 1)
    launch = spark.createDataFrame([(1, t, "a", "1"), (2, t, "b", "1"), (3, t, "a", "2")], LAUNCH)
    result = spark.createDataFrame([(10, 1, 100, 0, 0.5), (11, 1, 100, 1, None), (12, 2, 100, 0, 0.7)], RESULT)
    assert lookup(launch, "launch_id", 2).count() == 1 and lookup(launch, "launch_id", 7).count() == 0
    upd = spark.createDataFrame([(3, "9"), (8, "x")], "launch_id bigint, query_version string")
    new, affected = update_rows(launch, upd, "launch_id")
    assert affected.collect()[0][0] == 1
    assert rows(new.select("launch_id", "query_version")) == [(1, "1"), (2, "1"), (3, "9")]
    twice = spark.createDataFrame([(3, 1, "8"), (3, 2, None), (None, 3, "x")], "launch_id bigint, at int, query_version string")
    new, affected = update_rows(launch, twice, "launch_id", ["at"])
    assert affected.collect()[0][0] == 1  # the last update counts, and it sets NULL
    assert rows(new.select("launch_id", "query_version")) == [(1, "1"), (2, "1"), (3, None)]
    p, c, counts = delete_cascade(launch, result, "launch_id", F.col("query_name") == "a")
    assert rows(p.select("launch_id")) == [(2,)] and rows(c.select("result_id")) == [(12,)]
    assert tuple(counts.collect()[0]) == (2, 2)
    p, _, _ = delete_cascade(new, result, "launch_id", F.col("query_version") == "1")
    assert rows(p.select("launch_id")) == [(3,)]  # unknown is no match


def test_constraint_report_finds_violations(spark):
    t = dt.datetime(2025, 1, 1)
    launch = spark.createDataFrame([(1, t, "a", "1"), (1, t, "b", "1"), (2, t, None, "1")],
                                   "launch_id bigint, timestamp timestamp, query_name string, query_version string")
    result = spark.createDataFrame([(10, 1, 100, 0, 0.5), (11, 7, 100, 1, None)], RESULT)
    rep = {(r["table_name"], r["constraint_name"], r["column_name"]): r["violations"] for r in constraint_report(
        {"query_launch": launch, "query_result": result},
        {"query_launch": ["launch_id", "query_name"], "query_result": ["result_id"]},
        {"query_launch": "launch_id", "query_result": "result_id"},
        [("query_result", "launch_id", "query_launch", "launch_id")]).collect()}
    assert rep[("query_launch", "not_null", "query_name")] == 1
    assert rep[("query_launch", "primary_key", "launch_id")] == 1
    assert rep[("query_result", "primary_key", "result_id")] == 0
    assert rep[("query_result", "foreign_key", "launch_id")] == 1
