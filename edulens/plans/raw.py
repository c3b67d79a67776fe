"""Analyses on the raw (published) school tables.

Inputs are DataFrames shaped like the published tables (see
:mod:`edulens.schemas`); numbers may be text or numeric, years double, int
or text. Everything is lazy and reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edulens.functions import (label_contains, label_startswith, not_like_ci, positive, flag_is,
                               to_number, year_equals, year_of)
from edulens.operators.quantiles import clip_above_quantile
from edulens.operators.rates import guarded_ratio
from edulens.operators.relational import cap_intervals
from edulens.operators.stats import (factor_table, factor_table_union, hist2d, pair_count_expr,
                                     pearson, pearson_expr, slope_expr, intercept_expr, with_significance)

ALL_PREFIX = "ALL STUDENTS"
ALL_LABEL = "All Students"
MATH_WORD = "MATH"
DISTRICT = "% SD"

# Q1 factor columns of 'Demographic Factors' -> names in the result (fixed values)
Q1_FACTORS = {
    "PER_ELL": "per_ell", "PER_SWD": "per_swd", "PER_ECDIS": "per_ecdis", "PER_BLACK": "per_black",
    "PER_HISP": "per_hisp", "PER_ASIAN": "per_asian", "PER_WHITE": "per_white",
}


# --- Q1: subgroup composition vs math proficiency ----------------------------------

def q1_math_rows(math_src: DataFrame, all_prefix: str = ALL_PREFIX, subject_word: str = MATH_WORD) -> DataFrame:
    """'All Students' math rows (the rows the outcome is computed from)."""
    return math_src.where(label_startswith("SUBGROUP_NAME", all_prefix)
                          & label_contains("ASSESSMENT_NAME", subject_word))


def q1_math_outcome(math_src: DataFrame, all_prefix: str = ALL_PREFIX, subject_word: str = MATH_WORD) -> DataFrame:
    """Per (entity_cd, year): ``math_prof_rate`` = SUM(NUM_PROF)/SUM(NUM_TESTED)
    (a 0-1 fraction, NULL unless tested > 0) over 'All Students' math rows;
    counts are cleaned text-to-integer (commas stripped, decimals truncated)."""
    m = q1_math_rows(math_src, all_prefix, subject_word)
    overall = m.groupBy(F.col("ENTITY_CD").alias("entity_cd"), year_of(m, "YEAR").alias("year")).agg(
        F.sum(to_number(m, "NUM_PROF", integral=True)).alias("num_prof"),
        F.sum(to_number(m, "NUM_TESTED", integral=True)).alias("num_tested"))
    return overall.select("entity_cd", "year", guarded_ratio("num_prof", "num_tested", 1.0).alias("math_prof_rate"))


def q1_latest_year(math_src: DataFrame, all_prefix: str = ALL_PREFIX, subject_word: str = MATH_WORD):
    """MAX(year) of the outcome as a scalar subquery. Every outcome group
    comes from at least one row, so this is the MAX over the rows: a
    partial/final max with no shuffle of groups."""
    m = q1_math_rows(math_src, all_prefix, subject_word)
    return m.agg(F.max(year_of(m, "YEAR")).alias("y")).select("y").scalar()


def q1_demo(demo: DataFrame, factors: Mapping[str, str] = Q1_FACTORS) -> DataFrame:
    """entity_cd, year and the factor percentages as doubles."""
    return demo.select(F.col("ENTITY_CD").alias("entity_cd"), year_of(demo, "YEAR").alias("year"),
                       *[to_number(demo, src).alias(dst) for src, dst in factors.items()])


def q1_pairs_latest_year(outcome: DataFrame, demo_view: DataFrame, factors: Sequence[str], latest=None) -> DataFrame:
    """Pairs of the latest year (MAX over all outcome rows, as a scalar
    subquery) with a positive rate, joined on (entity_cd, year)."""
    if latest is None:
        latest = outcome.agg(F.max("year").alias("y")).select("y").scalar()
    o = outcome.where((F.col("year") == latest) & positive("math_prof_rate"))
    return o.join(demo_view, ["entity_cd", "year"]).select("entity_cd", "year", "math_prof_rate", *factors)


def q1_factor_corr(math_src: DataFrame, demo: DataFrame, factors: Mapping[str, str] = Q1_FACTORS,
                   by_union: bool = False, all_prefix: str = ALL_PREFIX, latest=None) -> DataFrame:
    """var, n, r, slope of each factor against the math rate, by |r| desc.

    ``by_union`` selects the branch-per-factor form instead of the one-pass
    aggregate; ``latest`` is the newest year of the math rows where it is known.
    """
    latest = q1_latest_year(math_src, all_prefix) if latest is None else latest
    # the range on the stored year skips row groups of both scans
    outcome = q1_math_outcome(math_src.where(year_equals(math_src, "YEAR", latest)), all_prefix)
    composition = q1_demo(demo.where(year_equals(demo, "YEAR", latest)), factors)
    pairs = q1_pairs_latest_year(outcome, composition, list(factors.values()), latest)
    base = pairs.where(F.col("math_prof_rate").isNotNull())
    fn = factor_table_union if by_union else factor_table
    return fn(base, "math_prof_rate", list(factors.values()))


def q1_prefix_sweep(math_src: DataFrame, demo: DataFrame, caps: Sequence[int], order_cols: Sequence[str],
                    factors: Mapping[str, str] = Q1_FACTORS, all_prefix: str = ALL_PREFIX, stage=lambda name, df: df
                    ) -> DataFrame:
    """:func:`q1_factor_corr` of the first n rows of ``math_src`` for every n of
    the ascending ``caps``: cap, var, n, r, slope.

    The rows are cut once into intervals between caps, and summed up by school,
    year and interval. The sums of a cap are running sums over the intervals, and
    its latest year is the running maximum, so neither input is read again for
    another cap. ``stage(name, df)`` may write the two small tables that are read
    more than once; without it the plan stays lazy. A cap without pairs has n = 0.
    """
    kept = label_startswith("SUBGROUP_NAME", all_prefix) & label_contains("ASSESSMENT_NAME", MATH_WORD)
    slim = math_src.select(*order_cols, kept.alias("kept"), F.col("ENTITY_CD").alias("entity_cd"), year_of(math_src, "YEAR").alias("year"),
                           to_number(math_src, "NUM_PROF", integral=True).alias("prof"),
                           to_number(math_src, "NUM_TESTED", integral=True).alias("tested"))
    rows = cap_intervals(stage("rows", slim), caps, order_cols).where("kept")
    copies = F.col("copies")
    sums = stage("sums", rows.groupBy("entity_cd", "year", "cap").agg(
        F.sum(F.col("prof") * copies).alias("prof"), F.sum(F.col("tested") * copies).alias("tested")))
    held = lambda n, c: F.when(F.col("cap") <= n, F.col(c))
    newest = sums.agg(F.array(*[F.max(held(n, "year")) for n in caps]).alias("y")).scalar()
    running = F.array(*[F.struct(F.lit(int(n)).cast("long").alias("cap"), F.sum(held(n, "prof")).alias("prof"),
                                 F.sum(held(n, "tested")).alias("tested"), F.lit(i).alias("at")) for i, n in enumerate(caps)])
    rates = (sums.groupBy("entity_cd", "year").agg(running.alias("caps"))
             .join(q1_demo(demo, factors), ["entity_cd", "year"], "left")
             .select("year", *factors.values(), F.inline("caps"))
             .withColumn("rate", guarded_ratio("prof", "tested", 1.0)))
    counts = (F.col("year") == F.get(newest, F.col("at"))) & positive("rate")
    pairs = rates.select("cap", *factors.values(), F.when(counts, F.col("rate")).alias("math_prof_rate"))
    return factor_table(pairs, "math_prof_rate", list(factors.values()), by=["cap"])


def q1_fixed_period(math_src: DataFrame, demo: DataFrame, year: int, factors: Mapping[str, str] = Q1_FACTORS,
                    all_prefix: str = ALL_PREFIX) -> DataFrame:
    """Factor table for a given year (``year = {year}``), zero rates kept."""
    outcome = q1_math_outcome(math_src, all_prefix).where(F.col("year") == F.lit(year))
    pairs = outcome.join(q1_demo(demo, factors), ["entity_cd", "year"])
    return factor_table(pairs.where(F.col("math_prof_rate").isNotNull()), "math_prof_rate", list(factors.values()))


def entity_corr_over_time(math_src: DataFrame, demo: DataFrame, factor: str, factors: Mapping[str, str] = Q1_FACTORS,
                          all_prefix: str = ALL_PREFIX) -> DataFrame:
    """Per entity, Pearson r of one factor with the math rate across years
    (n pairs, r); an algebraic grouped aggregate."""
    outcome = q1_math_outcome(math_src, all_prefix)
    pairs = outcome.join(q1_demo(demo, factors), ["entity_cd", "year"])
    return pairs.groupBy("entity_cd").agg(pair_count_expr(factor, "math_prof_rate").cast("long").alias("n"),
                                          pearson_expr(factor, "math_prof_rate").alias("r"))


# --- Q2 / Q3: attendance and expenditure vs math proficiency ---------------------

def math_school(math_src: DataFrame, year: int, all_label: str = ALL_LABEL) -> DataFrame:
    """Per (ENTITY_CD, YEAR): total_prof, total_tested and
    ``math_prof_rate = 100 * SUM(NUM_PROF) / SUM(TOTAL_COUNT)``."""
    m = math_src.where(year_equals(math_src, "YEAR", year) & (F.col("SUBGROUP_NAME") == F.lit(all_label)))
    prof, tested = to_number(m, "NUM_PROF"), to_number(m, "TOTAL_COUNT")
    return m.groupBy("ENTITY_CD", year_of(m, "YEAR").alias("YEAR")).agg(
        F.sum(prof).alias("total_prof"), F.sum(tested).alias("total_tested"),
        guarded_ratio(F.sum(prof), F.sum(tested), 100.0).alias("math_prof_rate"))


def q2_points(math_src: DataFrame, attendance: DataFrame, year: int, district: str = DISTRICT,
              all_label: str = ALL_LABEL) -> DataFrame:
    """Attendance/math pairs of non-district schools with positive values:
    ENTITY_CD, ENTITY_NAME, ATTENDANCE_RATE, math_prof_rate."""
    att = attendance.where(year_equals(attendance, "YEAR", year))
    att = att.select("ENTITY_CD", "ENTITY_NAME", year_of(att, "YEAR").alias("YEAR"),
                     to_number(att, "ATTENDANCE_RATE").alias("ATTENDANCE_RATE"))
    m = math_school(math_src, year, all_label)
    j = att.join(m, ["ENTITY_CD", "YEAR"])
    return (j.where(not_like_ci("ENTITY_NAME", district) & positive("math_prof_rate") & positive("ATTENDANCE_RATE"))
             .select("ENTITY_CD", "ENTITY_NAME", "ATTENDANCE_RATE", "math_prof_rate"))


def q2_corr(points: DataFrame) -> DataFrame:
    return pearson(points, "ATTENDANCE_RATE", "math_prof_rate", r_name="correlation")


def q3_points(math_src: DataFrame, expenditures: DataFrame, year: int, district: str = DISTRICT,
              all_label: str = ALL_LABEL, require_enrollment_flag: bool = True) -> DataFrame:
    """Expenditure/math pairs: ENTITY_CD, ENTITY_NAME, per_pupil_expenditure,
    math_prof_rate; expenditure rows must be flagged reported."""
    e = expenditures.where(year_equals(expenditures, "YEAR", year) & flag_is("DATA_REPORTED_EXP"))
    if require_enrollment_flag:
        e = e.where(flag_is("DATA_REPORTED_ENR"))
    e = e.select("ENTITY_CD", "ENTITY_NAME", year_of(e, "YEAR").alias("YEAR"),
                 to_number(e, "PER_FED_STATE_LOCAL_EXP").alias("per_pupil_expenditure"))
    m = math_school(math_src, year, all_label)
    j = e.join(m, ["ENTITY_CD", "YEAR"])
    return (j.where(not_like_ci("ENTITY_NAME", district) & positive("per_pupil_expenditure")
                    & positive("math_prof_rate"))
             .select("ENTITY_CD", "ENTITY_NAME", "per_pupil_expenditure", "math_prof_rate"))


def q3_corr(points: DataFrame) -> DataFrame:
    return pearson(points, "per_pupil_expenditure", "math_prof_rate", r_name="correlation")


# --- Q4 / Q5: distribution views of the uncapped pairs --------------------------

def q4_hist(points: DataFrame, bins: int = 100) -> DataFrame:
    """2-D histogram of attendance (x) vs math rate (y)."""
    return hist2d(points, "ATTENDANCE_RATE", "math_prof_rate", bins)


def corr_significance(points: DataFrame, x: str, y: str) -> DataFrame:
    """n, r, t and two-sided p of the Pearson test."""
    agg = points.agg(pair_count_expr(x, y).cast("long").alias("n"), pearson_expr(x, y).alias("r"))
    return with_significance(agg)


def q5_clip_fit(points: DataFrame, q: float = 0.99) -> DataFrame:
    """Drop expenditures above the q-quantile, then n, r, t, p, slope, intercept."""
    clipped = clip_above_quantile(points, "per_pupil_expenditure", q)
    x, y = "per_pupil_expenditure", "math_prof_rate"
    agg = clipped.agg(pair_count_expr(x, y).cast("long").alias("n"), pearson_expr(x, y).alias("r"),
                      slope_expr(x, y).alias("slope"), intercept_expr(x, y).alias("intercept"))
    return with_significance(agg)


def rate_distribution(outcome: DataFrame, rate_col: str = "math_prof_rate") -> DataFrame:
    """n, min, mean, max of a rate column."""
    return outcome.agg(F.count(F.col(rate_col)).cast("long").alias("n"), F.min(rate_col).alias("min_rate"),
                       F.avg(rate_col).alias("mean_rate"), F.max(rate_col).alias("max_rate"))


# --- Q10: top-k with districts excluded ------------------------------------------

def q10_top_suspensions(suspensions: DataFrame, year: int, k: int = 10, district: str = "%SD") -> DataFrame:
    """The k schools with most suspensions in a year, districts excluded
    (ties broken by ENTITY_CD so the k rows are well defined)."""
    s = suspensions.where(year_equals(suspensions, "YEAR", year) & not_like_ci("ENTITY_NAME", district))
    return (s.select("ENTITY_CD", "ENTITY_NAME", to_number(s, "NUM_SUSPENSIONS").alias("NUM_SUSPENSIONS"))
             .orderBy(F.col("NUM_SUSPENSIONS").desc_nulls_last(), F.col("ENTITY_CD")).limit(k))
