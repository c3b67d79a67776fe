"""Explicit schemas (no inference): raw school tables as published (numbers
stored as text), the star schema, the run log, and the driver tables."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in
                       ((f[0], f[1], f[2] if len(f) > 2 else True) for f in fields)])


S, D, I, L = StringType(), DoubleType(), IntegerType(), LongType()

# --- raw school tables --------------------------------------------------------
ANNUAL_EM_MATH = _s(
    ("INSTITUTION_ID", S), ("ENTITY_CD", S), ("ENTITY_NAME", S), ("YEAR", D),
    ("ASSESSMENT_NAME", S), ("SUBGROUP_NAME", S),
    ("TOTAL_COUNT", S), ("NOT_TESTED", S), ("PCT_NOT_TESTED", S), ("NUM_TESTED", S), ("PCT_TESTED", S),
    ("LEVEL1_COUNT", S), ("LEVEL1_%TESTED", S), ("LEVEL2_COUNT", S), ("LEVEL2_%TESTED", S),
    ("LEVEL3_COUNT", S), ("LEVEL3_%TESTED", S), ("LEVEL4_COUNT", S), ("LEVEL4_%TESTED", S),
    ("LEVEL5_COUNT", S), ("LEVEL5_%TESTED", S),
    ("NUM_PROF", S), ("PER_PROF", S), ("TOTAL_SCALE_SCORES", S), ("MEAN_SCORE", S),
)

_DEMO_DOUBLE = ["ELL", "AM_IND", "BLACK", "HISP", "ASIAN", "WHITE", "Multi"]
_DEMO_INT = ["SWD", "FEMALE", "MALE", "NONBINARY", "ECDIS", "MIGRANT", "HOMELESS", "FOSTER", "ARMED"]
DEMOGRAPHIC_FACTORS = StructType(
    [StructField("ENTITY_CD", S), StructField("ENTITY_NAME", S), StructField("YEAR", D)]
    + [StructField(f"{p}_{g}", D) for g in _DEMO_DOUBLE for p in ("NUM", "PER")]
    + [StructField(f"{p}_{g}", I) for g in _DEMO_INT for p in ("NUM", "PER")]
)

ATTENDANCE = _s(("ENTITY_CD", S), ("ENTITY_NAME", S), ("YEAR", D), ("ATTENDANCE_RATE", D), ("DATA_REPORTED", S))

EXPENDITURES_PER_PUPIL = _s(
    ("INSTITUTION_ID", S), ("ENTITY_CD", S), ("ENTITY_NAME", S), ("YEAR", I),
    ("PUPIL_COUNT_TOT", D), ("FEDERAL_EXP", D), ("PER_FEDERAL_EXP", D), ("STATE_LOCAL_EXP", D),
    ("PER_STATE_LOCAL_EXP", D), ("FED_STATE_LOCAL_EXP", D), ("PER_FED_STATE_LOCAL_EXP", D),
    ("DATA_REPORTED_ENR", S), ("DATA_REPORTED_EXP", S),
)

SUSPENSIONS = _s(("ENTITY_CD", S), ("ENTITY_NAME", S), ("YEAR", D), ("NUM_SUSPENSIONS", D),
                 ("PER_SUSPENSIONS", D), ("DATA_REPORTED", S))

RAW_TABLES = {
    "Annual EM MATH": ANNUAL_EM_MATH,
    "Demographic Factors": DEMOGRAPHIC_FACTORS,
    "Attendance": ATTENDANCE,
    "Expenditures per Pupil": EXPENDITURES_PER_PUPIL,
    "Suspensions": SUSPENSIONS,
}

# --- star schema (inferred from the columns the star queries read) -------------
FACT_ASSESSMENT = _s(("year_key", I), ("school_key", L), ("subject_key", I), ("subgroup_key", I),
                     ("tested", L), ("n_qual", L))
FACT_ATTENDANCE = _s(("year_key", I), ("school_key", L), ("subgroup_key", I), ("absence_rate", D),
                     ("enrollment", L))
FACT_ENROLLMENT = _s(("year_key", I), ("school_key", L), ("subgroup_key", I), ("n_students", L))
DIM_SCHOOL = _s(("school_key", L), ("school_id", S), ("school_name", S))
DIM_YEAR = _s(("year_key", I), ("school_year_label", S))
DIM_SUBJECT = _s(("subject_key", I), ("subject_id", S), ("subject_name", S))
DIM_SUBGROUP = _s(("subgroup_key", I), ("subgroup_id", S), ("subgroup_name", S))

STAR_TABLES = {
    "fact_assessment": FACT_ASSESSMENT, "fact_attendance": FACT_ATTENDANCE,
    "fact_enrollment": FACT_ENROLLMENT, "dim_school": DIM_SCHOOL, "dim_year": DIM_YEAR,
    "dim_subject": DIM_SUBJECT, "dim_subgroup": DIM_SUBGROUP,
}

# --- run log ------------------------------------------------------------------------
QUERY_LAUNCH = _s(("launch_id", L, False), ("timestamp", TimestampType(), False),
                  ("query_name", S, False), ("query_version", S, False))
QUERY_RESULT = _s(("result_id", L, False), ("launch_id", L, False), ("dataset_size", L, False),
                  ("run_index", I, False), ("elapsed_seconds", D))
LATENCY_SERIES = _s(("rows", D), ("runs", D), ("original_P50_seconds", D), ("original_P95_seconds", D),
                    ("our_P50_seconds", D), ("our_P95_seconds", D))
RUNLOG_NOT_NULL = {"query_launch": ["launch_id", "timestamp", "query_name", "query_version"],
                   "query_result": ["result_id", "launch_id", "dataset_size", "run_index"]}
RUNLOG_PRIMARY_KEYS = {"query_launch": "launch_id", "query_result": "result_id"}
RUNLOG_FOREIGN_KEYS = [("query_result", "launch_id", "query_launch", "launch_id")]

# --- driver tables (TPC-H-like test data) ------------------------------------------
NTZ = TimestampNTZType()
DRIVER_TABLES = {
    "region": _s(("r_regionkey", I), ("r_name", S)),
    "nation": _s(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _s(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _s(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _s(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
               ("p_retailprice", D)),
    "orders": _s(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                 ("o_orderdate", NTZ), ("o_orderpriority", S)),
    "lineitem": _s(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                   ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                   ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", NTZ)),
    "events": _s(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
}
