"""The registered queries as ordered steps over the published databases and the
star: names and versions as published, every step from the catalog's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edulens.operators.relational import prefix_by_key
from edulens.operators.stats import factor_table, pearson_sql
from edulens.plans import raw, star as starplans
from edulens.plans.steps import Run, Step, StepSpec
from edulens.schemas import STAR_TABLES

FACTORS = raw.Q1_FACTORS
MATH_ORDER = ["ENTITY_CD", "YEAR", "ASSESSMENT_NAME", "SUBGROUP_NAME"]
REPORTCARD = {"reportcard_database_23_24": ("annual_em_math", "expenditures_per_pupil")}
ENROLLMENT = {"enrollment_database_23_24": ("demographic_factors",)}
STUDENT = {"student_educator_database_23_24": ("attendance",)}
STAR = {"star_schema": tuple(STAR_TABLES)}
PARAMS = {"year": 2000, "district": raw.DISTRICT, "n_limit": None}


def _math(run: Run) -> DataFrame:
    """The math table, or its first rows where a cap is given."""
    df, cap = run.table("reportcard_database_23_24", "annual_em_math"), run.params["n_limit"]
    return df if cap is None else prefix_by_key(df, int(cap), MATH_ORDER)


def _factor_steps() -> list[Step]:
    return [Step("correlations", lambda run: factor_table(run.view("newest_pairs").where("math_prof_rate IS NOT NULL"), "math_prof_rate",
                                                          list(FACTORS.values())))]


BASELINE_1 = StepSpec("baseline_query1", "1.1", {**ENROLLMENT, **REPORTCARD}, [
    Step("reset", ("composition", "assessments", "outcome", "newest_pairs", "correlations"), "reset"),
    Step("composition", lambda run: raw.q1_demo(run.table("enrollment_database_23_24", "demographic_factors"))),
    Step("assessments", _math),
    Step("outcome", lambda run: raw.q1_math_outcome(run.view("assessments"))),
    Step("newest_pairs", lambda run: raw.q1_pairs_latest_year(run.view("outcome"), run.view("composition"), list(FACTORS.values()))),
    *_factor_steps()], PARAMS)

_POINTS_2 = Step("points", lambda run: raw.q2_points(
    _math(run), run.table("student_educator_database_23_24", "attendance"), run.params["year"], run.params["district"]))
BASELINE_2_POINTS = StepSpec("baseline_query2", "1.2", {**REPORTCARD, **STUDENT}, [_POINTS_2], PARAMS)
BASELINE_2 = StepSpec("baseline_query2", "2.2", {**REPORTCARD, **STUDENT}, [
    _POINTS_2, Step("correlation", f"SELECT {pearson_sql('ATTENDANCE_RATE', 'math_prof_rate')} AS correlation FROM points")], PARAMS)
BASELINE_3 = StepSpec("baseline_query3", "1.0", REPORTCARD, [
    Step("points", lambda run: raw.q3_points(_math(run), run.table("reportcard_database_23_24", "expenditures_per_pupil"),
                                             run.params["year"], run.params["district"])),
    Step("correlation", f"SELECT {pearson_sql('per_pupil_expenditure', 'math_prof_rate')} AS correlation FROM points")], PARAMS)


def _star(run: Run) -> starplans.StarTables:
    return starplans.StarTables(**{t: run.table("star_schema", t) for t in STAR_TABLES})


# one school-year: the rates of all students, the shares of the subgroups, and their pairs
STAR_1_STEPS = StepSpec("star_query1", "0.0", STAR, [
    Step("math_rows", """
        SELECT f.school_key, f.tested, f.n_qual FROM IDENTIFIER(:star_schema || '.fact_assessment') f
        JOIN IDENTIFIER(:star_schema || '.dim_subject') s ON s.subject_key = f.subject_key AND s.subject_name = :subject
        JOIN IDENTIFIER(:star_schema || '.dim_subgroup') g ON g.subgroup_key = f.subgroup_key AND g.subgroup_name = :everyone
        WHERE f.year_key = (SELECT year_key FROM IDENTIFIER(:star_schema || '.dim_year') WHERE school_year_label = CAST(:year AS STRING))"""),
    Step("school_rates", "SELECT school_key, 100.0D * try_divide(sum(n_qual), sum(tested)) AS math_prof_rate FROM math_rows GROUP BY school_key"),
    Step("composition", """
        SELECT e.school_key, g.subgroup_name, try_divide(CAST(e.n_students AS DOUBLE), sum(e.n_students) OVER (PARTITION BY e.school_key)) AS share
        FROM IDENTIFIER(:star_schema || '.fact_enrollment') e
        JOIN IDENTIFIER(:star_schema || '.dim_subgroup') g ON g.subgroup_key = e.subgroup_key
        WHERE e.year_key = (SELECT year_key FROM IDENTIFIER(:star_schema || '.dim_year') WHERE school_year_label = CAST(:year AS STRING))"""),
    Step("pairs", "SELECT subgroup_name, share, math_prof_rate FROM composition JOIN school_rates USING (school_key) "
                  "WHERE share IS NOT NULL AND math_prof_rate IS NOT NULL", "table"),
    Step("correlation", f"SELECT subgroup_name, {pearson_sql('share', 'math_prof_rate')} AS correlation FROM pairs "
                        "GROUP BY subgroup_name HAVING count(*) > 1")],
    {**PARAMS, "subject": "Mathematics", "everyone": "All Students"})
STAR_1_SHARE = StepSpec("star_query1", "1.0", STAR, [
    Step("correlation", lambda run: starplans.q1_share_corr_star(_star(run), str(run.params["year"]), all_name=run.params["everyone"]))],
    {**PARAMS, "everyone": "All Students"})
STAR_1_FACTORS = StepSpec("star_query1", "2.0", STAR, [
    Step("correlations", lambda run: starplans.q1_factor_corr_star(_star(run), run.params["factor_ids"]))], {**PARAMS, "factor_ids": {}})
STAR_2 = StepSpec("star_query2", "1.0", STAR, [Step("points", lambda run: starplans.q2_points_star(_star(run), run.params["year"]))], PARAMS)
STAR_3 = StepSpec("star_query3", "0.0", {**STAR, **REPORTCARD}, [
    Step("correlation", lambda run: starplans.q3_corr_star(
        _star(run), run.table("reportcard_database_23_24", "expenditures_per_pupil"), run.params["year"], run.params["district"]))], PARAMS)

#: In order of registration: a name alone means its last version.
SPECS = {(s.name, s.version): s for s in (BASELINE_1, BASELINE_2_POINTS, BASELINE_2, BASELINE_3, STAR_1_SHARE, STAR_1_STEPS,
                                          STAR_1_FACTORS, STAR_2, STAR_3)}
