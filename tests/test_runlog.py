"""Latency analytics over launch/result tables."""

import datetime as dt
import math
import statistics

import pytest

from conftest import rows
from edulens.plans import runlog

LAUNCH = "launch_id bigint, timestamp timestamp, query_name string, query_version string"
RESULT = "result_id bigint, launch_id bigint, dataset_size bigint, run_index int, elapsed_seconds double"
T = dt.datetime(2025, 3, 1, 10, 0, 0)


@pytest.fixture(scope="module")
def log(spark):
    launch = spark.createDataFrame([
        (1, T, "base", "1.0"), (2, T + dt.timedelta(hours=1), "base", "1.0"),
        (3, T + dt.timedelta(hours=1), "base", "1.0"),          # same second as 2: higher id wins
        (4, T, "star", "2.0"), (5, T, "base", "2.0")], LAUNCH)
    res, rid = [], 0
    for lid, sizes in [(1, (10, 50)), (2, (10,)), (3, (10, 50)), (4, (10, 50, 100)), (5, (10,))]:
        for size in sizes:
            for i in range(1, 21):
                rid += 1
                res.append((rid, lid, size, i, float(i * lid + size / 10)))
    res.append((rid + 1, 3, 50, 21, None))
    return launch, spark.createDataFrame(res, RESULT)


def _expect(vals):
    s = sorted(vals)
    return statistics.median(s), s[math.ceil(0.95 * len(s)) - 1]


def test_latest_only(spark, log):
    launch, result = log
    st = {(r["query_name"], r["query_version"], r["dataset_size"]): r
          for r in runlog.latency_percentiles(launch, result, latest_only=True).collect()}
    vals = [float(i * 3 + 1) for i in range(1, 21)]
    p50, p95 = _expect(vals)
    r = st[("base", "1.0", 10)]
    assert (r["p50_s"], r["p95_s"], r["size_runs"], r["num_runs"]) == (p50, p95, 20, 40)
    assert ("base", "1.0", 50) in st and st[("star", "2.0", 100)]["num_runs"] == 60


def test_all_launches(spark, log):
    launch, result = log
    st = {(r["query_name"], r["query_version"], r["dataset_size"]): r
          for r in runlog.latency_percentiles(launch, result, latest_only=False).collect()}
    vals = [float(i * lid + 1) for lid in (1, 2, 3) for i in range(1, 21)]
    p50, p95 = _expect(vals)
    r = st[("base", "1.0", 10)]
    assert (r["p50_s"], r["p95_s"], r["size_runs"]) == (p50, p95, 60) and r["num_runs"] == 100


def test_two_queries_and_grid(spark, log):
    launch, result = log
    stats = runlog.latency_percentiles(launch, result, latest_only=True)
    two = {r["dataset_size"]: r for r in runlog.two_queries(stats, ("base", "1.0"), ("star", "2.0")).collect()}
    assert sorted(two) == [10, 50, 100] and two[100]["a_p50_s"] is None and two[100]["b_p50_s"] is not None
    grid = runlog.comparison_grid(spark, stats, [("q", ("base", "1.0"), ("star", "2.0"))], [10, 100, 200])
    g = {r["dataset_size"]: r for r in grid.collect()}
    assert g[100]["baseline_p50_s"] == "" and g[100]["star_p50_s"] != ""
    assert g[200]["star_p95_s"] == "" and g[10]["baseline_num_runs"] == 40
    assert len(g[10]["baseline_p50_s"].split(".")[1]) == 6


def test_trend_and_timeline(spark, log):
    launch, result = log
    stats = runlog.latency_percentiles(launch, result, latest_only=True)
    tr = {(r["query_name"], r["query_version"]): r for r in runlog.latency_trend(stats).collect()}
    assert tr[("star", "2.0")]["slope"] == pytest.approx(100.0)  # seconds per 1,000 rows
    assert tr[("star", "2.0")]["r2"] == pytest.approx(1.0)
    assert tr[("base", "2.0")]["slope"] is None
    tl = [r["launch_id"] for r in runlog.launch_timeline(launch, ("base", "1.0")).collect()]
    assert tl == [1, 2, 3]


def test_query_filter(spark, log):
    launch, result = log
    only = spark.createDataFrame([("star", "2.0")], "query_name string, query_version string")
    out = rows(runlog.latency_percentiles(launch, result, queries=only).select("query_name").distinct())
    assert out == [("star",)]
