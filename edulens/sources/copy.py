"""Verified catalog copy and schema report.

``copy_tables`` takes a table listing (table_name, table_type), keeps user
tables and views (system 'MSys*' and '~' temporaries dropped, names
deduplicated), and copies each table to Parquet under a destination folder.
The listing is metadata; each copy is a distributed read -> write whose task
commits make a retried task replace, not duplicate, its output, and the tables
are copied as concurrent jobs. A copy counts only when its fingerprint (rows,
and the sum of the rows' hashes, which no order changes) is that of the source;
a copy that is there already is left as it is for the same reason only, so a
run that was cut off is resumed by running it again.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from edulens.sources.registry import quoted

WANTED_TYPES = ["TABLE", "VIEW", "SYSTEM TABLE"]
REPORT_SCHEMA = "table_name string, status string, rows bigint, checksum string, error string"


def wanted_tables(listing: DataFrame) -> DataFrame:
    """User tables of a listing, one row per name."""
    name = F.trim(F.coalesce(F.col("table_name"), F.lit("")))
    kind = F.upper(F.coalesce(F.col("table_type"), F.lit("")))
    return (listing.where((name != "") & ~name.startswith("MSys") & ~name.startswith("~")
                          & kind.isin(WANTED_TYPES))
                   .select(name.alias("table_name"), "table_type").dropDuplicates(["table_name"]))


def fingerprint(df: DataFrame) -> tuple[int, str]:
    """Number of rows and sum of their 64-bit hashes (all columns, maps as sorted entries)."""
    columns = [F.array_sort(F.map_entries(F.col(quoted(f.name)))) if isinstance(f.dataType, MapType) else F.col(quoted(f.name))
               for f in df.schema.fields]
    hashes = F.xxhash64(*columns) if columns else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(hashes.cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return row["n"], str(row["h"])


def _copy(spark: SparkSession, source: str, dest: str, skip_existing: bool) -> tuple[str, int, str]:
    df = spark.read.parquet(source)
    wanted = fingerprint(df)
    if skip_existing:
        try:
            if fingerprint(spark.read.parquet(dest)) == wanted:
                return "kept", *wanted
        except AnalysisException:  # nothing there, or no whole table
            pass
    df.write.mode("overwrite").parquet(dest)
    if fingerprint(spark.read.schema(df.schema).parquet(dest)) != wanted:
        raise OSError(f"the copy in {dest} differs from {source}")
    return "copied", *wanted


def copy_tables(spark: SparkSession, listing: DataFrame, source_path: Callable[[str], str], dest_root: str,
                skip_existing: bool = False, parallel: int = 4) -> DataFrame:
    """Copy every wanted table: table_name, status ('copied', 'kept', or 'skipped'
    with the error that made it so), rows, checksum, error."""
    names = [r.table_name for r in wanted_tables(listing).orderBy("table_name").collect()]

    def one(name: str) -> tuple:
        try:
            status, n, checksum = _copy(spark, source_path(name), f"{dest_root}/{name}", skip_existing)
            return name, status, n, checksum, None
        except Exception as exc:  # a table that cannot be copied is reported, not fatal
            return name, "skipped", None, None, str(exc)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        report = list(pool.map(one, names))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def schema_report(database: str, tables: dict[str, DataFrame], primary_keys: dict[str, str] | None = None
                  ) -> list[tuple]:
    """(database, table, column, type, pk, not_null, default) for each column."""
    pks = primary_keys or {}
    rows = []
    for t, df in tables.items():
        for f in df.schema.fields:
            rows.append((database, t, f.name, f.dataType.simpleString(), f.name == pks.get(t),
                         not f.nullable, None))
    return rows


def schema_report_df(spark: SparkSession, database: str, tables: dict[str, DataFrame],
                     primary_keys: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(
        schema_report(database, tables, primary_keys),
        "database string, table_name string, column_name string, data_type string, pk boolean, "
        "not_null boolean, default_value string")
