"""Append run-log result files to the results table as they arrive.

``readStream`` picks up new Parquet files in a landing folder; each
micro-batch is written by ``foreachBatch`` into its own
``ingest_id=<id>/batch_id=<n>`` partition of the results table with
``mode("overwrite")`` for that partition only, so a retried batch replaces its
own output instead of duplicating it (the checkpoint in the shared folder
records which batches committed). The ingest id is the stream's own, kept in
its checkpoint: another source, or a new checkpoint, has another id and so
never touches rows that are there. Rows without a ``result_id`` get keys
continuing after the largest key of other batches and of the batch itself,
ordered by (launch_id, dataset_size, run_index) -- the auto-increment key of a single insert, for a whole batch.
Each batch also writes its largest key to a one-row partition of a marks
table next to the results, so finding the next key never scans the results.
One stream at a time writes to a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from edulens import schemas
from edulens.operators.ranking import global_row_number
from edulens.plans.runlog import latency_counts
from edulens.session import hadoop_fs

INGEST_COL = "ingest_id"
BATCH_COL = "batch_id"
ORDER = ["launch_id", "dataset_size", "run_index"]


def result_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of result records (result_id may be NULL)."""
    schema = StructType([StructField(f.name, f.dataType, True) for f in schemas.QUERY_RESULT.fields])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_dir)


def _marks_dir(table_dir: str) -> str:
    return table_dir.rstrip("/") + "_key_marks"


def ingest_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The stream's id, which Spark keeps in its checkpoint folder."""
    return spark.read.text(f"{checkpoint_dir}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def _previous_max(spark: SparkSession, table_dir: str, stream: str, batch_id: int):
    """Largest key of other batches, from the one-row-per-batch marks table
    (never from a scan of the growing results table)."""
    fs, where = hadoop_fs(spark, _marks_dir(table_dir))
    if not fs.exists(where):  # first batch
        return F.lit(0).cast("long")
    marks = spark.read.schema(f"max_key long, {INGEST_COL} string, {BATCH_COL} long").parquet(_marks_dir(table_dir))
    return (marks.where((F.col(INGEST_COL) != stream) | (F.col(BATCH_COL) != batch_id))
                 .agg(F.coalesce(F.max("max_key"), F.lit(0)).cast("long").alias("m")).select("m").scalar())


def append_batch(table_dir: str, checkpoint_dir: str):
    """``foreachBatch`` function writing one micro-batch idempotently."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = ingest_id(spark, checkpoint_dir)
        largest = batch.agg(F.max("result_id").cast("long").alias("m")).select("m").scalar()
        start = F.greatest(_previous_max(spark, table_dir, stream, batch_id), F.coalesce(largest, F.lit(0).cast("long")))
        given = batch.where(F.col("result_id").isNotNull())
        missing = batch.where(F.col("result_id").isNull()).drop("result_id")
        keyed = (global_row_number(missing, ORDER, name="_rn")
                 .withColumn("result_id", (start + F.col("_rn")).cast("long")).drop("_rn"))
        cols = [f.name for f in schemas.QUERY_RESULT.fields]
        out = (given.select(*cols).unionByName(keyed.select(*cols))
                    .withColumn(INGEST_COL, F.lit(stream)).withColumn(BATCH_COL, F.lit(batch_id)).persist())
        try:
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(INGEST_COL, BATCH_COL).parquet(table_dir))
            mark = out.agg(F.coalesce(F.max("result_id"), start).cast("long").alias("max_key"))
            (mark.withColumn(INGEST_COL, F.lit(stream)).withColumn(BATCH_COL, F.lit(batch_id)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy(INGEST_COL, BATCH_COL).parquet(_marks_dir(table_dir)))
        finally:
            out.unpersist()

    return write


COUNTS = "query_name string, query_version string, dataset_size long, elapsed_seconds double, n long"


def count_batch(counts_dir: str, checkpoint_dir: str, launches: DataFrame):
    """``foreachBatch`` function that adds the counts of one micro-batch's times
    (:func:`edulens.plans.runlog.latency_counts`) as a partition of its own, which
    a retried batch overwrites. ``launches`` names the query of a launch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = ingest_id(batch.sparkSession, checkpoint_dir)
        (latency_counts(launches, batch).withColumn(INGEST_COL, F.lit(stream)).withColumn(BATCH_COL, F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(INGEST_COL, BATCH_COL).parquet(counts_dir))

    return write


def read_counts(spark: SparkSession, counts_dir: str) -> DataFrame:
    """The counts of all batches; none before the first."""
    fs, where = hadoop_fs(spark, counts_dir)
    return spark.read.schema(COUNTS).parquet(counts_dir) if fs.exists(where) else spark.createDataFrame([], COUNTS)


def start_counts(spark: SparkSession, landing_dir: str, counts_dir: str, checkpoint_dir: str, launches: DataFrame,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep the table of counts up to date with the results that land. Each query
    that counts has a checkpoint of its own."""
    writer = (result_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(count_batch(counts_dir, checkpoint_dir, launches))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def start_ingest(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingestion query. ``available_now`` processes what has
    landed and stops (a scheduled job); otherwise it runs continuously."""
    writer = (result_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(append_batch(table_dir, checkpoint_dir))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
