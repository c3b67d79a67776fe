"""Scale properties of the physical plans, checked on the smallest tables."""

import pytest

import __spark_entry__ as se
from conftest import SF0001

NO_PYTHON = ["q1_factor_corr_raw", "q1_factor_corr_star", "q2_corr_raw", "q2_corr_star", "q3_corr_raw",
             "q3_corr_star", "hist2d_points", "proficiency_rate"]
YEAR_PUSHED = ["q2_points_raw", "q2_corr_raw", "q3_corr_raw", "q1_fixed_period", "top_k_excluding_suffix"]


def _plan(spark, name):
    df = se.queries()[name](spark, SF0001)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def long_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", NO_PYTHON)
def test_core_analyses_stay_in_the_jvm(spark, name):
    plan = _plan(spark, name)
    assert "MapInPandas" not in plan and "EvalPython" not in plan


@pytest.mark.parametrize("name", YEAR_PUSHED)
def test_year_range_reaches_the_lineitem_scan(spark, long_metadata, name):
    plan = _plan(spark, name)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln]
    assert scans and all("GreaterThanOrEqual(l_shipdate" in ln and "LessThan(l_shipdate" in ln for ln in scans)


def test_scans_read_only_needed_columns(spark, long_metadata):
    plan = _plan(spark, "q2_corr_raw")
    for ln in plan.splitlines():
        if "FileScan parquet" in ln and "lineitem" in ln:
            schema = ln.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
            assert len(schema.split(",")) <= 4 and "l_extendedprice" not in schema


def test_numeric_year_filter_reaches_a_school_table_scan(spark, long_metadata, tmp_path):
    from edulens import schemas
    from edulens.plans import raw
    from school_fixtures import frame
    path = str(tmp_path / "att")
    frame(spark, schemas.ATTENDANCE, [{"ENTITY_CD": "000000000001", "ENTITY_NAME": "A", "YEAR": 2024.0,
                                       "ATTENDANCE_RATE": 90.0},
                                      {"ENTITY_CD": "000000000001", "ENTITY_NAME": "A", "YEAR": 2023.0,
                                       "ATTENDANCE_RATE": 80.0}]).write.parquet(path)
    att = spark.read.schema(schemas.ATTENDANCE).parquet(path)
    math = frame(spark, schemas.ANNUAL_EM_MATH, [{"ENTITY_CD": "000000000001", "YEAR": 2024.0,
                                                  "SUBGROUP_NAME": "All Students", "TOTAL_COUNT": "10",
                                                  "NUM_PROF": "5"}])
    df = raw.q2_points(math, att, 2024)
    assert [tuple(r) for r in df.collect()] == [("000000000001", "A", 90.0, 50.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "GreaterThanOrEqual(YEAR,2024.0)" in scan and "LessThan(YEAR,2025.0)" in scan
