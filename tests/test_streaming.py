"""Incremental run-log ingestion with Structured Streaming."""

from edulens.streaming.runlog_ingest import start_ingest

RESULT = "result_id bigint, launch_id bigint, dataset_size bigint, run_index int, elapsed_seconds double"


def _land(spark, path, rows):
    spark.createDataFrame(rows, RESULT).coalesce(1).write.mode("append").parquet(path)


def test_ingest_assigns_keys_and_is_incremental(spark, tmp_path):
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    _land(spark, landing, [(None, 1, 100, 1, 0.5), (None, 1, 100, 0, 0.4), (7, 2, 100, 0, 0.9)])
    start_ingest(spark, landing, table, ckpt).awaitTermination(120)
    first = sorted((r["result_id"], r["launch_id"], r["run_index"]) for r in spark.read.parquet(table).collect())
    assert first == [(7, 2, 0), (8, 1, 0), (9, 1, 1)]  # after the key that the batch carries

    _land(spark, landing, [(None, 3, 200, 0, None)])
    start_ingest(spark, landing, table, ckpt).awaitTermination(120)
    all_rows = spark.read.parquet(table)
    assert all_rows.count() == 4
    new = all_rows.where("launch_id = 3").collect()[0]
    assert new["result_id"] == 10 and new["elapsed_seconds"] is None

    # nothing new: a rerun neither duplicates nor changes anything
    start_ingest(spark, landing, table, ckpt).awaitTermination(120)
    assert spark.read.parquet(table).count() == 4

    # another source, with batches numbered from 0 again, adds to what is there
    second = str(tmp_path / "second")
    _land(spark, second, [(None, 4, 100, 0, 0.1), (20, 4, 100, 1, 0.2)])
    start_ingest(spark, second, table, str(tmp_path / "ckpt2")).awaitTermination(120)
    assert sorted(r["result_id"] for r in spark.read.parquet(table).collect()) == [7, 8, 9, 10, 20, 21]
