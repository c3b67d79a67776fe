"""CSV sink and source with fixed columns and explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from edulens.session import scratch_folder

CORRUPT = "_corrupt_record"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header + rows; values are written as given (format numbers upstream,
    e.g. with :func:`edulens.functions.fixed6`, so missing is blank)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV read with an explicit schema (no inference)."""
    return spark.read.schema(schema).option("header", True).option("emptyValue", "").csv(path)


def intake_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """CSV, each file with a header or none, read so that no line is lost: the rows that the schema
    takes, the lines that it does not (a value of another type, too many or too
    few fields) as text with their file, and one row that reconciles them: lines
    in the files, rows kept, lines rejected.

    The lines are parsed once, into a table in the shared folder that both parts
    are read from. Blank lines are no lines."""
    name = CORRUPT
    while name in schema.fieldNames():
        name = "_" + name
    folder = scratch_folder(spark, "intake")
    (spark.read.schema(StructType([*schema.fields]).add(name, StringType())).option("header", header).option("emptyValue", "")
     .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", name).option("enforceSchema", True).csv(path)
     .withColumn("_file", F.input_file_name()).write.parquet(f"{folder}/rows"))
    rows = spark.read.parquet(f"{folder}/rows")
    bad = F.col(name).isNotNull()
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.input_file_name().alias("file"))
    heads = lines.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files"))
    counts = (rows.agg(F.count_if(~bad).alias("rows_kept"), F.count_if(bad).alias("rows_rejected"))
              .select(heads.select((F.col("n") - (F.col("files") if header else 0)).alias("n")).scalar().alias("rows_in"), "rows_kept", "rows_rejected"))
    return (rows.where(~bad).select(*schema.fieldNames()),
            rows.where(bad).select(F.col("_file").alias("file"), F.col(name).alias("line")), counts)
