"""Raw-schema analyses on published-layout fixtures with every edge row."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from edulens import schemas
from edulens.plans import raw
from school_fixtures import frame

M = schemas.ANNUAL_EM_MATH


def math_row(cd, year, tested, prof, sg="All Students", a="MATH3", total=None, name="X"):
    return {"ENTITY_CD": cd, "ENTITY_NAME": name, "YEAR": year, "ASSESSMENT_NAME": a, "SUBGROUP_NAME": sg,
            "NUM_TESTED": tested, "NUM_PROF": prof, "TOTAL_COUNT": total if total is not None else tested}


def test_q1_outcome_cleans_text_counts(spark):
    math = frame(spark, M, [
        math_row("000000000001", 2024.0, "1,234", "617"),
        math_row("000000000001", 2024.0, "12.7", "s", a="Math 4"),
        math_row("000000000002", 2024.0, "0", "0"),
        math_row("000000000003", 2024.0, "", "5"),
        math_row("000000000004", 2024.0, "100", "50", sg=" all students "),
        math_row("000000000005", 2024.0, "100", "50", sg="Female"),
        math_row("000000000006", 2024.0, "100", "50", a="ELA3"),
    ])
    got = {r["entity_cd"]: r["math_prof_rate"] for r in raw.q1_math_outcome(math).collect()}
    assert got["000000000001"] == pytest.approx(617 / 1246)
    assert got["000000000002"] is None and got["000000000003"] is None
    assert got["000000000004"] == 0.5
    assert "000000000005" not in got and "000000000006" not in got


def _q1_inputs(spark, extra_math=(), extra_demo=()):
    math = [math_row(f"{i:012d}", 2024.0, "100", str(10 + 7 * i)) for i in range(1, 6)]
    math += [math_row("000000000009", 2023.0, "100", "50")]
    math += list(extra_math)
    demo = [{"ENTITY_CD": f"{i:012d}", "YEAR": 2024.0, "PER_ELL": float(i), "PER_SWD": 10 - i,
             "PER_ECDIS": 3, "PER_BLACK": float(i * i), "PER_HISP": None, "PER_ASIAN": 1.0 + (i % 2),
             "PER_WHITE": 50.0 - i} for i in range(1, 6)]
    demo += list(extra_demo)
    return frame(spark, M, math), frame(spark, schemas.DEMOGRAPHIC_FACTORS, demo)


def test_q1_factor_corr_latest_year_and_edges(spark):
    math, demo = _q1_inputs(spark)
    out = {r["var"]: r for r in raw.q1_factor_corr(math, demo).collect()}
    assert set(out) == set(raw.Q1_FACTORS.values())
    assert out["per_ell"]["n"] == 5 and out["per_ell"]["r"] == pytest.approx(1.0)
    assert out["per_ell"]["slope"] == pytest.approx(0.07)
    assert out["per_swd"]["r"] == pytest.approx(-1.0)
    assert out["per_ecdis"]["r"] is None and out["per_ecdis"]["slope"] is None
    assert out["per_hisp"]["n"] == 0 and out["per_hisp"]["r"] is None
    order = [r["var"] for r in raw.q1_factor_corr(math, demo).collect()]
    assert order[-1] in ("per_ecdis", "per_hisp")


def test_q1_zero_rate_dropped_and_single_pair(spark):
    math = frame(spark, M, [math_row("000000000001", 2024.0, "100", "0"), math_row("000000000002", 2024.0, "100", "40")])
    demo = frame(spark, schemas.DEMOGRAPHIC_FACTORS, [
        {"ENTITY_CD": "000000000001", "YEAR": 2024.0, "PER_ELL": 1.0},
        {"ENTITY_CD": "000000000002", "YEAR": 2024.0, "PER_ELL": 2.0}])
    out = {r["var"]: r for r in raw.q1_factor_corr(math, demo).collect()}
    assert out["per_ell"]["n"] == 1 and out["per_ell"]["r"] is None and out["per_ell"]["slope"] is None


def test_q1_union_form_is_equal(spark):
    math, demo = _q1_inputs(spark)
    a = {r["var"]: r for r in raw.q1_factor_corr(math, demo).collect()}
    b = {r["var"]: r for r in raw.q1_factor_corr(math, demo, by_union=True).collect()}
    for k in a:
        assert a[k]["n"] == b[k]["n"]
        assert (a[k]["r"], a[k]["slope"]) == pytest.approx((b[k]["r"], b[k]["slope"]), abs=1e-9)


def test_q1_of_a_prefix(spark):
    from edulens.operators.relational import prefix_by_key
    math, demo = _q1_inputs(spark)
    first = {r["var"]: r["n"] for r in raw.q1_factor_corr(prefix_by_key(math, 2, ["ENTITY_CD"]), demo).collect()}
    assert first["per_ell"] == 2


def test_q2_points_filters(spark):
    math = frame(spark, M, [
        math_row("000000000001", 2024.0, "100", "50", total="200"),
        math_row("000000000002", 2024.0, "100", "50"),
        math_row("000000000003", 2024.0, "100", "50"),
        math_row("000000000004", 2024.0, "100", "0"),
        math_row("000000000005", 2024.0, "100", "30"),
        math_row("000000000006", 2024.0, "100", "30"),
        math_row("000000000001", 2023.0, "100", "90"),
        math_row("000000000001", 2024.0, "100", "90", sg="Female"),
    ])
    att = frame(spark, schemas.ATTENDANCE, [
        {"ENTITY_CD": "000000000001", "ENTITY_NAME": "Albany High", "YEAR": 2024.0, "ATTENDANCE_RATE": 91.0},
        {"ENTITY_CD": "000000000002", "ENTITY_NAME": "Albany SD", "YEAR": 2024.0, "ATTENDANCE_RATE": 92.0},
        {"ENTITY_CD": "000000000003", "ENTITY_NAME": "Albany Sd", "YEAR": 2024.0, "ATTENDANCE_RATE": 93.0},
        {"ENTITY_CD": "000000000004", "ENTITY_NAME": "Zero Rate", "YEAR": 2024.0, "ATTENDANCE_RATE": 94.0},
        {"ENTITY_CD": "000000000005", "ENTITY_NAME": None, "YEAR": 2024.0, "ATTENDANCE_RATE": 95.0},
        {"ENTITY_CD": "000000000006", "ENTITY_NAME": "No Attendance", "YEAR": 2024.0, "ATTENDANCE_RATE": 0.0},
    ])
    pts = rows(raw.q2_points(math, att, 2024))
    assert pts == [("000000000001", "Albany High", 91.0, 25.0)]
    assert raw.q2_corr(raw.q2_points(math, att, 2024)).collect()[0][0] is None


def test_q3_points_flags_and_nonpositive_spend(spark):
    math = frame(spark, M, [math_row(f"{i:012d}", 2024.0, "100", str(10 * i)) for i in range(1, 6)])
    exp = frame(spark, schemas.EXPENDITURES_PER_PUPIL, [
        {"ENTITY_CD": "000000000001", "ENTITY_NAME": "A", "YEAR": 2024, "PER_FED_STATE_LOCAL_EXP": 10.0,
         "DATA_REPORTED_EXP": "Y", "DATA_REPORTED_ENR": "Y"},
        {"ENTITY_CD": "000000000002", "ENTITY_NAME": "B", "YEAR": 2024, "PER_FED_STATE_LOCAL_EXP": 20.0,
         "DATA_REPORTED_EXP": "Y", "DATA_REPORTED_ENR": "N"},
        {"ENTITY_CD": "000000000003", "ENTITY_NAME": "C", "YEAR": 2024, "PER_FED_STATE_LOCAL_EXP": -5.0,
         "DATA_REPORTED_EXP": "Y", "DATA_REPORTED_ENR": "Y"},
        {"ENTITY_CD": "000000000004", "ENTITY_NAME": "D", "YEAR": 2024, "PER_FED_STATE_LOCAL_EXP": 0.0,
         "DATA_REPORTED_EXP": "Y", "DATA_REPORTED_ENR": "Y"},
        {"ENTITY_CD": "000000000005", "ENTITY_NAME": "E", "YEAR": 2024, "PER_FED_STATE_LOCAL_EXP": 30.0,
         "DATA_REPORTED_EXP": "Y", "DATA_REPORTED_ENR": "Y"},
    ])
    assert [r[0] for r in rows(raw.q3_points(math, exp, 2024))] == ["000000000001", "000000000005"]
    loose = [r[0] for r in rows(raw.q3_points(math, exp, 2024, require_enrollment_flag=False))]
    assert loose == ["000000000001", "000000000002", "000000000005"]
    assert raw.q3_corr(raw.q3_points(math, exp, 2024)).collect()[0][0] == pytest.approx(1.0)


def test_q5_clip_fit_and_q4_hist(spark):
    pts = spark.createDataFrame([(f"{i:012d}", "n", float(i), 2.0 * i + 1) for i in range(1, 101)],
                                "ENTITY_CD string, ENTITY_NAME string, per_pupil_expenditure double, "
                                "math_prof_rate double")
    r = raw.q5_clip_fit(pts).collect()[0]
    assert r["n"] == 99 and r["slope"] == pytest.approx(2.0) and r["intercept"] == pytest.approx(1.0)
    assert r["p_value"] == 0.0
    h = raw.q4_hist(pts.select(F.col("per_pupil_expenditure").alias("ATTENDANCE_RATE"), "math_prof_rate"))
    assert h.agg(F.sum("n")).collect()[0][0] == 100


def test_q10_top_k_with_districts_excluded(spark):
    s = frame(spark, schemas.SUSPENSIONS, [
        {"ENTITY_CD": f"{i:012d}", "ENTITY_NAME": ("Town SD" if i % 4 == 0 else f"School {i}"), "YEAR": 2022.0,
         "NUM_SUSPENSIONS": float(i % 6)} for i in range(1, 30)])
    out = raw.q10_top_suspensions(s, 2022, 10).collect()
    assert len(out) == 10
    assert all(not r["ENTITY_NAME"].endswith("SD") for r in out)
    assert [r["NUM_SUSPENSIONS"] for r in out] == sorted([r["NUM_SUSPENSIONS"] for r in out], reverse=True)


def test_rate_distribution(spark):
    df = spark.createDataFrame([(0.2,), (0.4,), (None,)], "math_prof_rate double")
    r = raw.rate_distribution(df).collect()[0]
    assert (r["n"], r["min_rate"], r["max_rate"]) == (2, 0.2, 0.4) and r["mean_rate"] == pytest.approx(0.3)


def test_year_types_join_after_normalization(spark):
    math = frame(spark, M, [math_row("000000000001", 2024.0, "100", "40"), math_row("000000000002", 2024.0, "100", "60")])
    att = spark.createDataFrame([("000000000001", "A", "2024", 90.0), ("000000000002", "B", "2024.0", 95.0)],
                                "ENTITY_CD string, ENTITY_NAME string, YEAR string, ATTENDANCE_RATE double")
    pts = rows(raw.q2_points(math, att, 2024))
    assert pts == [("000000000001", "A", 90.0, 40.0), ("000000000002", "B", 95.0, 60.0)]
