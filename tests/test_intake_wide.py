"""CSV intake with rejects, the verified copy, and the wide fact."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import SF0001, rows
from edulens.plans import catalog, wide
from edulens.sources.copy import copy_tables, fingerprint
from edulens.sources.csv_io import intake_csv

SCHEMA = StructType().add("a", "long").add("b", "string").add("_corrupt_record", "double")


def test_intake_keeps_and_rejects_every_line(spark, tmp_path):
    head = "a,b,_corrupt_record\n"
    (tmp_path / "one.csv").write_text(head + "1,x,0.5\nword,x,0.5\n2,,\n\n3,\"with, comma\",1e3\n4,x\n")
    (tmp_path / "two.csv").write_text(head + "5,x,1,more\n6,y,z\n99999999999999999999,q,1\n")
    kept, rejected, counts = intake_csv(spark, str(tmp_path), SCHEMA)
    assert rows(kept) == [(1, "x", 0.5), (2, None, None), (3, "with, comma", 1000.0)]
    assert sorted(r["line"] for r in rejected.collect()) == ["4,x", "5,x,1,more", "6,y,z", "99999999999999999999,q,1", "word,x,0.5"]
    assert {r["file"].rsplit("/", 1)[1] for r in rejected.collect()} == {"one.csv", "two.csv"}
    assert counts.first().asDict() == {"rows_in": 8, "rows_kept": 3, "rows_rejected": 5}


def test_intake_of_nothing(spark, tmp_path):
    (tmp_path / "none.csv").write_text("a,b,_corrupt_record\n")
    kept, rejected, counts = intake_csv(spark, str(tmp_path), SCHEMA)
    assert kept.count() == rejected.count() == 0 and counts.first()["rows_in"] == 0


def test_fingerprint_is_of_rows_not_of_order(spark):
    df = spark.createDataFrame([(1, "a", {"k": 1, "j": 2}), (2, None, None), (2, None, None)], "x int, `y z` string, m map<string,int>")
    assert fingerprint(df) == fingerprint(df.repartition(5).orderBy(F.desc("x")))
    assert fingerprint(df) != fingerprint(df.dropDuplicates(["x"])) and fingerprint(df) != fingerprint(df.withColumn("x", F.col("x") + 1))
    assert fingerprint(df.where("false")) == (0, "0")


def test_cut_off_copy_is_resumed(spark, tmp_path):
    names, source = ["a", "b", "c"], lambda n: str(tmp_path / "src" / n)
    for n in names:
        spark.range(100).withColumn("t", F.lit(n)).write.parquet(source(n))
    listing = spark.createDataFrame([(n, "TABLE") for n in [*names, "missing"]], "table_name string, table_type string")
    dest = str(tmp_path / "dst")
    first = {r["table_name"]: r for r in copy_tables(spark, listing, source, dest).collect()}
    assert {n: first[n]["status"] for n in first} == {"a": "copied", "b": "copied", "c": "copied", "missing": "skipped"}
    spark.read.parquet(source("b")).where("id < 60").write.mode("overwrite").parquet(f"{dest}/b")
    spark.read.parquet(source("c")).withColumn("t", F.lit("other")).write.mode("overwrite").parquet(f"{dest}/c")
    again = {r["table_name"]: r for r in copy_tables(spark, listing, source, dest, skip_existing=True).collect()}
    assert [again[n]["status"] for n in names] == ["kept", "copied", "copied"]
    assert all(again[n]["checksum"] == first[n]["checksum"] and spark.read.parquet(f"{dest}/{n}").count() == 100 for n in names)


def test_wide_rows_join_without_exchange(spark):
    a = spark.createDataFrame([("x", 2020, 1.0), ("y", 2020, 2.0), (None, 2020, 9.0)], "entity_cd string, year int, a double")
    b = spark.createDataFrame([("x", 2020, 5.0), ("x", 2021, 6.0)], "entity_cd string, year int, b double")
    out = wide.wide_rows(spark, {"a": a, "b": b, "none": a.where("false").withColumnRenamed("a", "c")}, buckets=3)
    assert rows(out) == [("x", 2020, 1.0, 5.0, None), ("x", 2021, None, 6.0, None), ("y", 2020, 2.0, None, None)]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_wide_fact_moves_no_row(spark, no_broadcast):
    plan = catalog.wide_fact(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 9 and "Exchange" not in plan
