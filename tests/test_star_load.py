"""Incremental star load: stable keys, replaced years, untouched files."""

import os

import pytest

from edulens.plans import star_load
from edulens.plans.star_load import Batch, by_codes, load_star, read_star

MATH = "ENTITY_CD string, YEAR double, SUBJECT_ID string, SUBJECT_NAME string, SUBGROUP_NAME string, NUM_TESTED string, NUM_PROF string"
ALL = "All Students"


def batch(spark, years, schools, names=None, tested="1,000"):
    math = [(s, float(y), sub, f"{sub} name", g, tested if g == ALL else "30", "7.9") for s in schools for y in years
            for sub in ("Math", "ELA") for g in (ALL, "Female")]
    demo = [(s, float(y), "12") for s in schools for y in years]
    att = [(s, float(y), 90.5) for s in schools for y in years]
    names = names or {s: f"School {s}" for s in schools}
    return Batch(tuple(years), spark.createDataFrame([*math, (None, float(years[0]), "Math", "x", ALL, "9", "9")], MATH),
                 spark.createDataFrame(demo, "ENTITY_CD string, YEAR double, NUM_F string"),
                 spark.createDataFrame(att, "ENTITY_CD string, YEAR double, ATTENDANCE_RATE double"),
                 spark.createDataFrame(list(names.items()), "ENTITY_CD string, ENTITY_NAME string"), {"NUM_F": "Female"})


def facts(star):
    return sorted(map(tuple, by_codes(star).collect()), key=str)


def keys(star, name="dim_school", key="school_key", code="school_id"):
    return {r[code]: r[key] for r in getattr(star, name).collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    first = load_star(spark, root, batch(spark, [2021, 2022], ["B", "D"]), 1)
    before = keys(first), keys(first, "dim_subject", "subject_key", "subject_id")
    files = {f for d, _, fs in os.walk(f"{root}/fact_assessment/year_key=2021") for f in fs}
    star = load_star(spark, root, batch(spark, [2022, 2023], ["A", "B", "D", "E"], tested="2,000"), 2)
    return root, star, before, files


def test_known_members_keep_their_keys(loaded):
    _, star, (schools, subjects), _ = loaded
    assert schools == {"B": 1, "D": 2}
    assert keys(star) == {"B": 1, "D": 2, "A": 3, "E": 4}
    assert keys(star, "dim_subject", "subject_key", "subject_id") == subjects == {"ELA": 1, "Math": 2}


def test_loads_equal_one_build_up_to_key_order(spark, loaded, tmp_path):
    root, star, _, _ = loaded
    whole = str(tmp_path)
    load_star(spark, whole, batch(spark, [2021], ["B", "D"]), 1)
    once = load_star(spark, whole, batch(spark, [2022, 2023], ["A", "B", "D", "E"], tested="2,000"), 2)
    assert facts(star) == facts(once)
    assert {r["year_key"] for r in star.dim_year.collect()} == {2021, 2022, 2023}


def test_files_of_other_years_are_left_alone(loaded):
    root, _, _, files = loaded
    assert files == {f for d, _, fs in os.walk(f"{root}/fact_assessment/year_key=2021") for f in fs} and files


def test_a_load_that_is_run_again_changes_nothing(spark, loaded):
    root, star, _, _ = loaded
    before = facts(star), keys(star)
    again = load_star(spark, root, batch(spark, [2022, 2023], ["A", "B", "D", "E"], tested="2,000"), 3)
    assert (facts(again), keys(again)) == before


def test_later_names_and_emptied_years(spark, tmp_path):
    root = str(tmp_path)
    load_star(spark, root, batch(spark, [2021, 2022], ["A", "B"]), 1)
    star = load_star(spark, root, batch(spark, [2021], ["A"], {"A": "New name", "B": None}), 2)
    assert {r["school_id"]: r["school_name"] for r in star.dim_school.collect()} == {"A": "New name", "B": "School B"}
    assert {r["school"] for r in by_codes(star).where("year = 2021").collect()} == {"A"}
    none = batch(spark, [2022], ["A"])
    empty = Batch((2022,), none.math_rows.where("false"), none.demo_counts.where("false"), none.attendance.where("false"),
                  none.schools, none.count_columns)
    star = load_star(spark, root, empty, 3)
    assert {r["year"] for r in by_codes(star).collect()} == {2021}


def test_rows_of_years_that_are_not_declared_stay_out(spark, tmp_path):
    b = batch(spark, [2021, 2022], ["A"])
    star = load_star(spark, str(tmp_path), Batch((2022,), b.math_rows, b.demo_counts, b.attendance, b.schools, b.count_columns), 1)
    assert {r["year"] for r in by_codes(star).collect()} == {2022}
    row = by_codes(star).where("fact = 'fact_attendance'").first()
    assert (row["m1"], row["m2"]) == (9.5, 1000.0)


def test_empty_star(spark, tmp_path):
    star = read_star(spark, str(tmp_path))
    assert all(df.count() == 0 for df in star.as_dict().values()) and set(star_load.FACTS) <= set(star.as_dict())
