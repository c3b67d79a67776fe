"""Tables laid out by key ranges, and percentiles from counts kept by a stream."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, rows
from edulens.operators import ranged
from edulens.operators.quantiles import exact_quantiles
from edulens.plans import runlog
from edulens.sources import driver_tables as dt
from edulens.streaming import runlog_ingest


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(-5, 45).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"), (F.col("id") % 3).alias("key_range_no"))
    return ranged.save_ranged(df, str(tmp_path / "t"), "k", 10)


def files(table):
    return {d.rsplit("=", 1)[1]: sorted(f for f in fs if f.startswith("part-")) for d, _, fs in os.walk(table.path) if "key_range=" in d}


def test_layout(spark, table):
    assert set(files(table)) == {"-1", "0", "1", "2", "3", "4"}
    assert rows(table.read(spark).select("k")) == [(k,) for k in sorted(range(-5, 45), key=str)]
    with pytest.raises(Exception, match="k is null"):
        ranged.save_ranged(spark.createDataFrame([(None, "x")], "k long, v string"), table.path + "-null", "k", 10)


def test_lookup_reads_the_folder_of_its_key(spark, table):
    for key in (-5, 0, 17, 44):
        assert rows(ranged.lookup_ranged(spark, table, key).select("k", "v")) == [(key, f"v{key}")]
    assert ranged.lookup_ranged(spark, table, 99).count() == 0
    plan = ranged.lookup_ranged(spark, table, 17)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(key_range" in plan and "EqualTo(k,17)" in plan
    read = ranged.lookup_ranged(spark, table, 17).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) == 1 and "key_range=1" in read[0]["f"]


def test_list_lookup(spark, table):
    keys = spark.createDataFrame([(3,), (3,), (44,), (1000,), (None,)], "wanted int")
    assert rows(ranged.members_ranged(spark, table, keys).select("k")) == [(3,), (44,)]
    assert ranged.members_ranged(spark, table, keys.where("false")).count() == 0


def test_update_rewrites_only_ranges_it_changes(spark, table):
    before = files(table)
    ups = spark.createDataFrame([(-1, "a"), (12, None), (12, "b"), (777, "c"), (None, "d")], "k long, v string")
    done = ranged.update_ranged(spark, table, ups).first()
    assert (done["affected"], done["ranges_rewritten"], done["ranges_kept"]) == (2, 2, 4)
    now = {r["k"]: r["v"] for r in table.read(spark).collect()}
    assert len(now) == 50 and now[-1] == "a" and now[12] == "b" and now[13] == "v13"
    after = files(table)
    assert {r for r in after if after[r] != before[r]} == {"-1", "1"}
    none = ranged.update_ranged(spark, table, ups.where("k > 700")).first()
    assert (none["affected"], none["ranges_rewritten"]) == (0, 0) and files(table) == after


def test_delete_and_emptied_range(spark, table):
    before = files(table)
    done = ranged.delete_ranged(spark, table, spark.createDataFrame([(k,) for k in [*range(40, 45), 7, 999]], "id long")).first()
    assert (done["affected"], done["ranges_rewritten"], done["ranges_kept"]) == (6, 2, 4)
    after = files(table)
    assert set(after) == {"-1", "0", "1", "2", "3"} and all(after[r] == before[r] for r in ("-1", "1", "2", "3"))
    assert table.read(spark).count() == 44


def test_quantiles_of_weighted_values(spark):
    values = [1.0] * 5 + [2.0, 2.0, 9.0]
    plain = spark.createDataFrame([("a", v) for v in values], "g string, x double")
    counts = spark.createDataFrame([("a", 1.0, 2), ("a", 1.0, 3), ("a", 2.0, 2), ("a", 9.0, 1), ("a", 7.0, 0), ("a", None, 4)], "g string, x double, n long")
    want = {"m": ("median",), "p": ("nearest_rank", 95), "q": ("linear", 0.9)}
    assert rows(exact_quantiles(counts, "x", want, ["g"], weight_col="n")) == rows(exact_quantiles(plain, "x", want, ["g"]))


def test_counts_of_a_stream(spark, tmp_path):
    launch, result = dt.run_log(spark, SF0001)
    landing, counts, checkpoint = (str(tmp_path / x) for x in ("landing", "counts", "checkpoint"))
    assert runlog.percentiles_of_counts(runlog_ingest.read_counts(spark, counts)).count() == 0
    for part in range(3):
        result.where(F.col("result_id") % 3 == part).write.mode("append").parquet(landing)
        runlog_ingest.start_counts(spark, landing, counts, checkpoint, launch).awaitTermination()
    whole = rows(runlog.latency_percentiles(launch, result, latest_only=False))
    kept = runlog.percentiles_of_counts(runlog_ingest.read_counts(spark, counts))
    assert rows(kept) == whole
    assert landing not in kept._jdf.queryExecution().toString() and "events" not in kept._jdf.queryExecution().toString()
    # a batch that is written once more, e.g. after a lost driver, counts once
    runlog_ingest.count_batch(counts, checkpoint, launch)(result.where(F.col("result_id") % 3 == 2), 2)
    assert rows(runlog.percentiles_of_counts(runlog_ingest.read_counts(spark, counts))) == whole
