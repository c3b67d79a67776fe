"""Lines joined with their segments once: the rows of the joins, and jobs that read them."""

import datetime as dt_
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from conftest import SF0001
from edulens import schemas
from edulens.plans import catalog
from edulens.plans.star import build_star
from edulens.plans.star_load import Batch, by_codes, load_star
from edulens.sources import driver_tables as dt
from edulens.sources import published


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, root, name, rows):
    """A driver table of ``rows`` (columns -> values), other columns null."""
    schema = schemas.DRIVER_TABLES[name]
    spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema).write.parquet(f"{root}/{name}.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Orders that repeat, that lack, that have no customer; customers that repeat or have no segment; null keys and dates."""
    root = str(tmp_path_factory.mktemp("odd"))
    line = lambda o, s, y, n=1, flag="R", part=1: dict(l_orderkey=o, l_suppkey=s, l_linenumber=n, l_quantity=10.0 * n, l_discount=0.01,
                                                      l_returnflag=flag, l_partkey=part, l_shipdate=y and dt_.datetime(y, 5, 1))
    table(spark, root, "lineitem", [line(1, 1, 1999), line(1, 2, 2000, 2, "A"), line(2, 1, 1998, 3), line(3, 1, 2000, 4, "N"), line(4, 2, 1999, 5),
                                    line(9, 1, 2000, 6), line(None, 2, 1999), line(1, None, 2000), line(1, 7, 2000, 7), line(2, 1, None),
                                    line(1, 1, 1999)])
    table(spark, root, "orders", [dict(o_orderkey=k, o_custkey=c) for k, c in [(1, 1), (2, 2), (2, 3), (3, 8), (4, None), (None, 1)]])
    table(spark, root, "customer", [dict(c_custkey=k, c_mktsegment=s) for k, s in
                                    [(1, "BUILDING"), (2, "MACHINERY"), (2, "HOUSEHOLD"), (3, None), (None, "FURNITURE")]])
    table(spark, root, "supplier", [dict(s_suppkey=k, s_name=n) for k, n in [(1, "one"), (2, "two"), (2, "two"), (None, "none")]])
    table(spark, root, "part", [dict(p_partkey=1, p_type="STANDARD"), dict(p_partkey=1, p_type="PROMO")])
    return root


def counted(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_rows_of_the_lines_are_those_of_the_joins(spark, odd):
    li = dt.read(spark, odd, "lineitem")
    orders, cust = dt.read(spark, odd, "orders"), dt.read(spark, odd, "customer")
    every = li.join(orders, li.l_orderkey == orders.o_orderkey, "left").join(cust, orders.o_custkey == cust.c_custkey, "left")
    cols = ["l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "c_mktsegment"]
    lines = dt.segment_lines(spark, odd, "l_partkey")
    assert counted(lines, *cols, "year") == counted(every, *cols, F.year("l_shipdate"))
    inner = li.join(orders, li.l_orderkey == orders.o_orderkey).join(cust, orders.o_custkey == cust.c_custkey)
    assert counted(lines.where("has_customer"), *cols, "year") == counted(inner, *cols, F.year("l_shipdate"))


def test_frames_of_the_lines_equal_those_of_the_joins(spark, odd):
    lines = dt.segment_lines(spark, odd, "l_partkey")
    assert counted(dt.demographic_factors(spark, odd, lines=lines), "*") == counted(dt.demographic_factors(spark, odd), "*")
    assert counted(dt.subject_assessment(spark, odd, lines), "*") == counted(dt.subject_assessment(spark, odd), "*")
    whole = dt.math_assessment(spark, odd, with_subgroups=True).drop("ROW_ID")
    parts = dt.math_assessment(spark, odd).drop("ROW_ID").unionByName(dt.subgroup_assessment(lines))
    assert counted(parts, "*") == counted(whole, "*")


def test_lines_are_written_once_and_anew_when_a_table_changes(spark, tmp_path):
    root = str(tmp_path)
    table(spark, root, "lineitem", [dict(l_orderkey=1, l_suppkey=1, l_shipdate=dt_.datetime(2000, 1, 1))])
    table(spark, root, "orders", [dict(o_orderkey=1, o_custkey=1)])
    table(spark, root, "customer", [])
    first = dt.segment_lines(spark, root)
    assert dt.segment_lines(spark, root) is first and first.count() == 1
    spark.createDataFrame([], schemas.DRIVER_TABLES["lineitem"]).write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    assert dt.segment_lines(spark, root).count() == 0


def test_published_math_is_made_without_a_shuffle_of_its_rows(spark):
    """F1 F3 F4: the joins are in the lines, and rows become texts after the last shuffle."""
    text = plan(published.annual_em_math(spark, SF0001, "23_24"))
    assert "Exchange hashpartitioning" not in text and "o_orderkey" not in text
    assert "o_orderkey" not in plan(published.demographic_factors(spark, SF0001, "23_24"))
    root = {t.name: t.path for db in published.published(spark, SF0001) if db.name == "reportcard_database_23_24" for t in db.tables}
    found = spark.read.schema(schemas.ANNUAL_EM_MATH).parquet(root["Annual EM MATH"]).groupBy(F.input_file_name()).agg(F.countDistinct("YEAR").alias("n"))
    assert {r["n"] for r in found.collect()} == {1}


def test_star_of_the_driver_joins_no_raw_lines(spark):
    """the subgroups' rows come from the written lines; texts' maxima are taken over few rows."""
    plans = {}

    def stage(name, df):
        plans[name] = plan(df)
        return df.localCheckpoint()

    catalog.build_star_from_driver(spark, SF0001, stage)
    assert "o_orderkey" not in plans["_fa_natural"] and "o_orderkey" not in plans["_enrollment_natural"]
    assert "_school_names" in plans and "SortAggregate" not in plans["dim_school"]


def test_school_names_are_the_largest(spark):
    math = spark.createDataFrame([("B", 2000.0, "All Students", 1, 1), ("C", 2000.0, "All Students", 1, 1), (None, 2000.0, "All Students", 1, 1)],
                                 "ENTITY_CD string, YEAR double, SUBGROUP_NAME string, NUM_TESTED long, NUM_PROF long")
    demo = spark.createDataFrame([("A", 2000.0, 1)], "ENTITY_CD string, YEAR double, NUM_F long")
    att = spark.createDataFrame([("D", 2000.0, 90.0)], "ENTITY_CD string, YEAR double, ATTENDANCE_RATE double")
    schools = spark.createDataFrame([("B", "x"), ("B", "y"), ("B", None), ("E", None)], "ENTITY_CD string, ENTITY_NAME string")
    star = build_star(spark, math, demo, att, schools, {"NUM_F": "Female"})
    assert sorted(map(tuple, star.dim_school.collect())) == [(1, "A", None), (2, "B", "y"), (3, "C", None), (4, "D", None), (5, "E", None)]


def test_loads_sort_no_raw_rows(spark, tmp_path, monkeypatch):
    """raw rows are summed by hashing; a subject of several names is one row still."""
    plans, write = {}, DataFrameWriter.parquet

    def kept(self, path, *args, **kw):
        plans[path.rsplit("/", 1)[-1]] = plan(self._df)
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", kept)
    math = spark.createDataFrame([("A", 2000.0, "Math", n, "All Students", 10, 4) for n in ("m", "n", None)] + [("A", 2001.0, "Math", "z", "All Students", 1, 1)],
                                 "ENTITY_CD string, YEAR double, SUBJECT_ID string, SUBJECT_NAME string, SUBGROUP_NAME string, NUM_TESTED long, NUM_PROF long")
    demo = spark.createDataFrame([("A", 2000.0, 1)], "ENTITY_CD string, YEAR double, NUM_F long")
    att = spark.createDataFrame([("A", 2000.0, 90.0)], "ENTITY_CD string, YEAR double, ATTENDANCE_RATE double")
    schools = spark.createDataFrame([("A", "a")], "ENTITY_CD string, ENTITY_NAME string")
    star = load_star(spark, str(tmp_path), Batch((2000,), math, demo, att, schools, {"NUM_F": "Female"}), 1)
    assert "SortAggregate" not in plans["assessment"]
    assert [tuple(r) for r in star.dim_subject.collect()] == [(1, "Math", "n")]
    assert sorted(map(tuple, by_codes(star).collect()), key=str) == [
        ("fact_assessment", "A", 2000, "Math", "All", 30.0, 12.0), ("fact_attendance", "A", 2000, None, "All", 10.0, 30.0),
        ("fact_enrollment", "A", 2000, None, "Female", 1.0, None)]
