"""Registry, copy job, schema report and CSV round trip."""

import os

from pyspark.sql import functions as F

from conftest import rows
from edulens import schemas
from edulens.sources.copy import copy_tables, schema_report_df, wanted_tables
from edulens.sources.csv_io import read_csv, write_csv
from edulens.sources.registry import (Database, TableSource, drop_views, quoted, register_dependencies,
                                      school_databases)


def test_register_views_with_spaces(spark, tmp_path):
    path = str(tmp_path / "math")
    spark.createDataFrame([("000000000001", 2024.0, "All Students", "1,234")],
                          "ENTITY_CD string, YEAR double, SUBGROUP_NAME string, NUM_TESTED string") \
        .write.parquet(path)
    db = Database("reportcard", (TableSource("Annual EM MATH", path),))
    frames = register_dependencies(spark, [db])
    assert spark.sql(f"SELECT ENTITY_CD FROM {quoted('Annual EM MATH')}").collect()[0][0] == "000000000001"
    assert frames["Annual EM MATH"].count() == 1
    assert drop_views(spark, ["Annual EM MATH", "missing view"]) == ["Annual EM MATH"]


def test_school_database_layout():
    dbs = school_databases("/data")
    names = {t.name for db in dbs for t in db.tables}
    assert {"Annual EM MATH", "Demographic Factors", "Attendance", "Expenditures per Pupil"} <= names


def test_wanted_tables_filter(spark):
    listing = spark.createDataFrame([("a", "TABLE"), ("MSysObjects", "SYSTEM TABLE"), ("~tmp", "TABLE"),
                                     ("a", "TABLE"), ("v", "VIEW"), ("", "TABLE"), ("idx", "INDEX")],
                                    "table_name string, table_type string")
    assert rows(wanted_tables(listing).select("table_name")) == [("a",), ("v",)]


def test_copy_tables_reports_rows_and_skips(spark, tmp_path):
    src = tmp_path / "src"
    spark.range(7).write.parquet(str(src / "t1"))
    spark.range(0).write.parquet(str(src / "t2"))
    listing = spark.createDataFrame([("t1", "TABLE"), ("t2", "TABLE"), ("t3", "TABLE")],
                                    "table_name string, table_type string")
    rep = {r["table_name"]: r for r in copy_tables(spark, listing, lambda n: str(src / n),
                                                   str(tmp_path / "dst")).collect()}
    assert rep["t1"]["rows"] == 7 and rep["t1"]["status"] == "copied"
    assert rep["t2"]["rows"] == 0
    assert rep["t3"]["status"] == "skipped" and rep["t3"]["error"]
    again = {r["table_name"]: r["rows"] for r in copy_tables(spark, listing, lambda n: str(src / n),
                                                             str(tmp_path / "dst"), skip_existing=True).collect()}
    assert again["t1"] == 7


def test_schema_report(spark):
    df = spark.createDataFrame([], schemas.QUERY_LAUNCH)
    rep = {r["column_name"]: r for r in schema_report_df(spark, "runlog", {"query_launch": df},
                                                         {"query_launch": "launch_id"}).collect()}
    assert rep["launch_id"]["pk"] and rep["launch_id"]["data_type"] == "bigint"
    assert rep["timestamp"]["not_null"] is True


def test_csv_round_trip_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([("q1", 10, "0.500000", ""), ("q1", 20, "", "1.250000")],
                               "comparison string, dataset_size bigint, a string, b string")
    path = str(tmp_path / "out")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema)
    # blank cells are written empty and read back as missing (NULL)
    assert rows(back) == [("q1", 10, "0.500000", None), ("q1", 20, None, "1.250000")]
    assert "q1,10,0.500000,\n" in "".join(open(os.path.join(path, f)).read() for f in os.listdir(path)
                                           if f.endswith(".csv"))
    assert any(f.endswith(".csv") for f in os.listdir(path))


def test_latency_series_csv_schema(spark, tmp_path):
    path = tmp_path / "series.csv"
    path.write_text("rows,runs,original_P50_seconds,original_P95_seconds,our_P50_seconds,our_P95_seconds\n"
                    "1000,15,0.25,0.5,0.125,0.25\n9000,15,1.25,1.5,0.5,0.75\n")
    df = read_csv(spark, str(path), schemas.LATENCY_SERIES)
    from edulens.operators.stats import linear_fit
    fit = linear_fit(df, "rows", "original_P50_seconds").collect()[0]
    assert fit["n"] == 2 and abs(fit["slope"] - (1.25 - 0.25) / 8000) < 1e-12
    assert df.where(F.col("runs") == 15).count() == 2


def test_temp_table_params_and_preview(spark):
    from edulens.sources.registry import materialize_view, preview, release_view, run_sql
    df = spark.range(100).withColumnRenamed("id", "x")
    kept = materialize_view(df, "nums table")
    out = run_sql(spark, "SELECT x FROM `nums table` WHERE x >= :lo ORDER BY x LIMIT CAST(:n AS INT)", lo=90, n=3)
    assert [r[0] for r in out.collect()] == [90, 91, 92]
    assert len(preview(kept, 5)) == 5
    assert release_view(spark, "nums table", kept) is True
