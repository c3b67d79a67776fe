"""Star build and star analyses; star results equal raw results."""

import pytest

from edulens.plans import raw, star
from school_fixtures import FACTOR_IDS, SUBGROUPS, consistent_school_data


@pytest.fixture(scope="module")
def school(spark):
    return consistent_school_data(spark)


def _star(spark, school, stage=None):
    math, demo, att, names = school
    counts = {"NUM_" + col[4:]: name for name, (sid, col) in SUBGROUPS.items()}
    ids = {name: sid for name, (sid, col) in SUBGROUPS.items()}
    return star.build_star(spark, math, demo, att, names, counts, subgroup_ids=ids, stage=stage)


def test_dimensions(spark, school):
    s = _star(spark, school)
    keys = [r["school_key"] for r in s.dim_school.orderBy("school_id").collect()]
    assert keys == list(range(1, 41))
    sg = {r["subgroup_name"]: r["subgroup_id"] for r in s.dim_subgroup.collect()}
    assert sg["All Students"] == "All" and sg["White"] == "White" and len(sg) == 8
    assert sorted(r["year_key"] for r in s.dim_year.collect()) == [2023, 2024]


def test_star_q1_equals_raw_q1(spark, school):
    math, demo, att, names = school
    s = _star(spark, school)
    a = {r["var"]: r for r in raw.q1_factor_corr(math, demo).collect()}
    b = {r["var"]: r for r in star.q1_factor_corr_star(s, FACTOR_IDS).collect()}
    assert set(a) == set(b)
    for k in a:
        assert a[k]["n"] == b[k]["n"]
        assert a[k]["r"] == pytest.approx(b[k]["r"], abs=1e-9)
        assert a[k]["slope"] == pytest.approx(b[k]["slope"], abs=1e-9)


def test_star_q2_equals_raw_q2_without_districts(spark, school):
    math, demo, att, names = school
    s = _star(spark, school)
    r_raw = raw.q2_corr(raw.q2_points(math, att, 2024)).collect()[0][0]
    r_star = star.q2_corr_star(s, 2024).collect()[0][0]
    assert r_raw == pytest.approx(r_star, abs=1e-9)
    pts = star.q2_points_star(s, 2024).collect()
    assert [p["school_id"] for p in pts] == sorted(p["school_id"] for p in pts)


def test_star_q1_share_and_q3(spark, school):
    math, demo, att, names = school
    s = _star(spark, school)
    share = star.q1_share_corr_star(s, "2024").collect()
    assert len(share) == 7
    corr = [r["correlation"] for r in share]
    assert corr == sorted(corr, reverse=True)
    exp = spark.createDataFrame([(r["ENTITY_CD"], r["ENTITY_NAME"], 2024, 1000.0 + i, "Y")
                                 for i, r in enumerate(names.collect())],
                                "ENTITY_CD string, ENTITY_NAME string, YEAR int, PER_FED_STATE_LOCAL_EXP double, "
                                "DATA_REPORTED_EXP string")
    c = star.q3_corr_star(s, exp, 2024).collect()[0][0]
    assert -1 <= c <= 1


def test_materialized_star_matches_lazy(spark, school, tmp_path):
    lazy = _star(spark, school)
    written = star.materialize(lambda stage: _star(spark, school, stage), str(tmp_path / "star"))
    counts = {r["table_name"]: r["rows"] for r in star.star_counts(written).collect()}
    assert counts["dim_school"] == 40 and counts["fact_assessment"] == 40 * 2 * 8
    for name in ("dim_school", "dim_subgroup", "fact_assessment", "fact_enrollment", "fact_attendance"):
        a = sorted(tuple(r) for r in getattr(lazy, name).collect())
        b = sorted(tuple(r) for r in getattr(written, name).select(*getattr(lazy, name).columns).collect())
        assert a == b, name


def test_no_row_is_lost_unseen(spark):
    math = spark.createDataFrame([("001", 2024, "All Students", 10, 5), ("777", 2024, "All Students", 8, 2), (None, 2024, "X", 4, 1)],
                                 "ENTITY_CD string, YEAR int, SUBGROUP_NAME string, NUM_TESTED int, NUM_PROF int")
    demo = spark.createDataFrame([("001", 2024, 3)], "ENTITY_CD string, YEAR int, NUM_X int")
    att = spark.createDataFrame([("777", 2024, 90.0), (None, 2024, 80.0)], "ENTITY_CD string, YEAR int, ATTENDANCE_RATE double")
    schools = spark.createDataFrame([("001", "A"), (None, "nobody")], "ENTITY_CD string, ENTITY_NAME string")
    s = star.build_star(spark, math, demo, att, schools, {"NUM_X": "X"})
    assert sorted(tuple(r) for r in star.reconciliation(s).collect()) == [
        ("fact_assessment", 3, 2, 1), ("fact_attendance", 2, 1, 1), ("fact_enrollment", 1, 1, 0)]
    assert [tuple(r) for r in s.dim_school.orderBy("school_key").collect()] == [(1, "001", "A"), (2, "777", None)]


def test_year_folders_are_pruned(spark, school, tmp_path):
    s = star.materialize(lambda stage: _star(spark, school, stage), str(tmp_path / "star"))
    for df in (star.q2_points_star(s, 2024), star.q1_share_corr_star(s, "2024"), star.q1_factor_corr_star(s, FACTOR_IDS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year_key" in plan


def test_share_corr_drops_single_pair_subgroups(spark):
    s = star.StarTables(
        dim_school=spark.createDataFrame([(1, "001", "A"), (2, "002", "B"), (3, "003", "C")],
                                         "school_key bigint, school_id string, school_name string"),
        dim_year=spark.createDataFrame([(2024, "2024")], "year_key int, school_year_label string"),
        dim_subject=spark.createDataFrame([(1, "Math", "Mathematics")],
                                          "subject_key int, subject_id string, subject_name string"),
        dim_subgroup=spark.createDataFrame([(1, "All", "All Students"), (2, "X", "X"), (3, "Y", "Y")],
                                           "subgroup_key int, subgroup_id string, subgroup_name string"),
        fact_assessment=spark.createDataFrame([(2024, k, 1, 1, 100, 10 * k) for k in (1, 2, 3)],
                                              "year_key int, school_key bigint, subject_key int, "
                                              "subgroup_key int, tested bigint, n_qual bigint"),
        fact_enrollment=spark.createDataFrame([(2024, 1, 2, 10), (2024, 1, 3, 30), (2024, 2, 2, 20),
                                               (2024, 3, 2, 35)],
                                              "year_key int, school_key bigint, subgroup_key int, n_students bigint"),
        fact_attendance=spark.createDataFrame([], "year_key int, school_key bigint, subgroup_key int, "
                                                  "absence_rate double, enrollment bigint"),
    )
    out = {r["subgroup_name"]: r["correlation"] for r in star.q1_share_corr_star(s, "2024").collect()}
    assert set(out) == {"X"}  # Y has a single pair
    assert out["X"] == pytest.approx(3 ** 0.5 / 2)  # shares (0.25, 1, 1) vs rates (10, 20, 30)
