"""Namespaces of the session catalog, ordered steps, and the published tables."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from edulens import schemas
from edulens.plans import catalog, raw, specs
from edulens.plans.steps import MissingDependency, Step, StepSpec, isolated, missing, run_steps, run_together
from edulens.sources import registry
from edulens.sources.published import RELEASES, published
from edulens.sources.registry import DATABASES, Database, TableSource


@pytest.fixture(scope="module")
def known(spark):
    return catalog.school_catalog(spark, SF0001)


def test_all_published_databases_are_registered(spark, known):
    assert len(DATABASES) == 18 and set(DATABASES) <= set(known)
    assert all(spark.catalog.databaseExists(name) for name in known.values())


def test_equal_table_names_of_two_releases_do_not_meet(spark, known):
    for release, (years, _) in RELEASES.items():
        df = spark.table(f"{known[f'reportcard_database_{release}']}.annual_em_math")
        assert df.schema.fieldNames() == schemas.ANNUAL_EM_MATH.fieldNames()
        assert {int(r[0]) for r in df.select("YEAR").distinct().collect()} == set(years)


def test_published_texts_need_every_cleaning(spark, known):
    df = spark.table(f"{known['reportcard_database_23_24']}.annual_em_math")
    odd = df.agg(*[F.count_if(c).alias(n) for n, c in {
        "commas": F.col("NUM_TESTED").contains(","), "suppressed": F.col("NUM_PROF") == "s", "blank": F.col("NUM_PROF") == "",
        "decimal": F.col("NUM_PROF").contains("."), "other_subject": F.col("ASSESSMENT_NAME").startswith("ELA"),
        "noisy_label": F.col("SUBGROUP_NAME").startswith(" all"), "subgroup": ~F.lower("SUBGROUP_NAME").contains("all students"),
        "totals_differ": F.col("TOTAL_COUNT") != F.col("NUM_TESTED")}.items()]).first().asDict()
    assert all(odd.values()), odd


def _table(spark, known, db, table):
    return spark.table(f"{known[db]}.{table}")


def test_each_filter_changes_the_result(spark, known):
    math = _table(spark, known, "reportcard_database_23_24", "annual_em_math")
    demo = _table(spark, known, "enrollment_database_23_24", "demographic_factors")
    att = _table(spark, known, "student_educator_database_23_24", "attendance")
    exp = _table(spark, known, "reportcard_database_23_24", "expenditures_per_pupil")
    rate = lambda **k: {r["entity_cd"]: r["math_prof_rate"] for r in raw.q1_math_outcome(math.where("YEAR = 2000"), **k).collect()}
    assert rate() != rate(all_prefix="") and rate() != rate(subject_word="")
    q2 = lambda m=math, **k: raw.q2_points(m, att, 2000, **k)
    right = sorted(map(tuple, q2(district="supplier#%7").collect()))
    assert right != sorted(map(tuple, q2(district="nobody").collect()))
    tested = math.withColumn("TOTAL_COUNT", F.col("NUM_TESTED"))
    assert right != sorted(map(tuple, q2(tested, district="supplier#%7").collect()))
    every = math.withColumn("SUBGROUP_NAME", F.when(F.col("SUBGROUP_NAME").contains("all students"), "All Students").otherwise(F.col("SUBGROUP_NAME")))
    assert right != sorted(map(tuple, q2(every, district="supplier#%7").collect()))
    def points(flag=None, **k):
        return raw.q3_points(math, exp.withColumn(flag, F.lit("N")) if flag else exp, 2000, "nobody", **k).count()

    assert points() > 0 == points("DATA_REPORTED_EXP") == points("DATA_REPORTED_ENR") < points("DATA_REPORTED_ENR", require_enrollment_flag=False)
    assert raw.q1_factor_corr(math, demo).where("var = 'per_asian'").first()["n"] == 0


def test_steps_equal_the_direct_plans(spark, known):
    math = _table(spark, known, "reportcard_database_23_24", "annual_em_math")
    demo = _table(spark, known, "enrollment_database_23_24", "demographic_factors")
    got = run_steps(spark, specs.BASELINE_1, known)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, raw.q1_factor_corr(math, demo).collect()), key=str)
    assert not [t for t in spark.catalog.listTables() if t.name in ("assessments", "newest_pairs")]
    capped = run_steps(spark, specs.BASELINE_1, known, n_limit=500)
    assert {r["var"] for r in capped.collect()} == {r["var"] for r in got.collect()} and capped.first()["n"] <= got.first()["n"]


def test_every_spec_has_its_dependencies(spark, known):
    assert [s for s in specs.SPECS.values() if missing(spark, s, known)] == []
    assert sorted(specs.SPECS) == sorted({*catalog.reference_registry().listing(), ("star_query1", "0.0")})


def test_dependencies_are_checked_before_the_first_step(spark, known):
    seen = []
    spec = StepSpec("q", "1", {"reportcard_database_23_24": ("annual_em_math", "nothing"), "moon": ()},
                    [Step("a", lambda run: seen.append(1))])
    with pytest.raises(MissingDependency, match="reportcard_database_23_24.nothing, moon"):
        run_steps(spark, spec, known)
    assert not seen


def test_runs_at_the_same_time_do_not_meet(spark):
    both = threading.Barrier(2, timeout=60)

    def wait(run):
        both.wait()  # both runs have made a view of the same name
        return run.view("shared").selectExpr("max(x) AS x")

    make = [StepSpec("q", str(k), {}, [Step("shared", f"SELECT {k} AS x"), Step("result", wait)]) for k in (1, 2)]
    assert [df.first()["x"] for df in run_together(spark, make, {})] == [1, 2]


def test_reset_and_tables(spark):
    own = isolated(spark)
    own.range(3).createOrReplaceTempView("left_over")
    spec = StepSpec("q", "1", {}, [Step("reset", ("left_over", "never_there"), "reset"), Step("kept", "SELECT :k AS x", "table"),
                                   Step("result", "SELECT x + 1 AS x FROM kept")], {"k": 4})
    assert run_steps(spark, spec, {}, session=own).first()["x"] == 5
    assert own.catalog.listTables() == [] or not [t for t in own.catalog.listTables() if t.isTemporary]
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_discover_register_and_drop(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "Some Table"))
    spark.range(2).write.parquet(str(tmp_path / "other"))
    os.makedirs(tmp_path / "_temporary")
    db = registry.discover(spark, "found", str(tmp_path))
    name = registry.register_database(spark, db, "t_")
    assert registry.register_database(spark, db, "t_") == name == "t_found"
    assert spark.sql("SELECT count(*) FROM t_found.some_table").first()[0] == 4
    registry.drop_database(spark, name)
    assert not spark.catalog.databaseExists(name) and spark.read.parquet(str(tmp_path / "other")).count() == 2
    assert registry.discover(spark, "none", str(tmp_path / "nowhere")).tables == ()


def test_schema_report_has_declared_nullability(spark, tmp_path):
    path = str(tmp_path / "launches")
    spark.createDataFrame([], schemas.QUERY_LAUNCH).write.parquet(path)
    name = registry.register_database(spark, Database("log", (TableSource("query launch", path, schemas.QUERY_LAUNCH),)), "r_")
    report = {r["column_name"]: r for r in registry.schema_report(spark, [name], {"query_launch": "launch_id"}).collect()}
    assert report["launch_id"]["pk"] and report["launch_id"]["not_null"] and report["launch_id"]["position"] == 1
    assert not report["timestamp"]["pk"] and report["timestamp"]["data_type"] == "timestamp"
    registry.drop_database(spark, name)


def test_star_facts_prune_year_folders(spark, known):
    plan = spark.table(f"{known['star_schema']}.fact_assessment").where("year_key = 2000")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year_key" in plan


def test_published_once(spark):
    assert published(spark, SF0001) is published(spark, SF0001)


def test_spec_listing_runs_every_spec(spark, known):
    listing = {(r["name"], r["version"]): r for r in catalog.spec_listing(spark, SF0001).collect()}
    assert sorted(listing) == sorted(specs.SPECS) and sum(r["latest"] for r in listing.values()) == 6
    assert {k for k, r in listing.items() if r["latest"]} >= {("baseline_query2", "2.2"), ("star_query1", "2.0")}
