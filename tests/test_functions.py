"""Scalar functions: text-to-number cleaning (ANSI-safe), predicates, formats."""

from pyspark.sql import functions as F

from edulens.functions import (clean_digit_text, clean_int, clean_real, fixed6, is_digit_text, label_contains,
                               label_startswith, not_like_ci, norm_label, parse_ts, positive, to_number, year_int,
                               year_of)


def test_clean_int_edge_rows(spark):
    df = spark.createDataFrame([("1,234",), ("12.7",), ("s",), ("",), ("0",), (" 7 ",), (None,), ("1e3",),
                                ("-5",), ("12.7x",)], "x string")
    got = [r[0] for r in df.select(clean_int("x")).collect()]
    assert got == [1234, 12, None, None, 0, 7, None, 1000, -5, None]


def test_clean_real_keeps_decimals(spark):
    df = spark.createDataFrame([("1,234.5",), ("12.7",), ("s",), ("",)], "x string")
    assert [r[0] for r in df.select(clean_real("x")).collect()] == [1234.5, 12.7, None, None]


def test_suppressed_values_add_nothing_to_sums(spark):
    df = spark.createDataFrame([("10",), ("s",), ("",), ("1,000",)], "x string")
    assert df.agg(F.sum(clean_int("x"))).collect()[0][0] == 1010


def test_digit_text(spark):
    df = spark.createDataFrame([("10_000",), ("1,000",), ("12a",), ("",), ("7",), ("1.5",)], "x string")
    got = df.select(clean_digit_text("x"), is_digit_text("x")).collect()
    assert [r[0] for r in got] == [10000, 1000, None, None, 7, None]
    assert [r[1] for r in got] == [True, True, False, False, True, False]


def test_year_types_normalize(spark):
    df = spark.createDataFrame([("2024.0",), ("2024",), (" 2024",), ("x",)], "y string")
    assert [r[0] for r in df.select(year_int("y")).collect()] == [2024, 2024, 2024, None]
    d = spark.createDataFrame([(2024.0,), (2023.0,)], "y double")
    assert [r[0] for r in d.select(year_of(d, "y")).collect()] == [2024, 2023]


def test_to_number_dispatches_on_type(spark):
    df = spark.createDataFrame([("1,234", 12.7)], "t string, d double")
    r = df.select(to_number(df, "t", True), to_number(df, "d", True), to_number(df, "d")).collect()[0]
    assert tuple(r) == (1234, 12, 12.7)


def test_label_predicates(spark):
    df = spark.createDataFrame([(" all students ", "Grade 3 Math"), ("ALL STUDENTS (total)", "ELA"),
                                ("Female", "math8"), (None, None)], "sg string, a string")
    got = df.select(label_startswith("sg", "All Students"), label_contains("a", "MATH"), norm_label("sg")).collect()
    assert [r[0] for r in got] == [True, True, False, None]
    assert [r[1] for r in got] == [True, False, True, None]
    assert got[0][2] == "ALL STUDENTS"


def test_district_suffix_is_case_insensitive_and_drops_null(spark):
    df = spark.createDataFrame([("Albany SD",), ("Albany Sd",), ("Albany High",), (None,)], "n string")
    kept = [r[0] for r in df.where(not_like_ci("n", "% SD")).collect()]
    assert kept == ["Albany High"]


def test_positive_guard(spark):
    df = spark.createDataFrame([(0.0,), (None,), (-1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.where(positive("x")).collect()] == [2.0]


def test_fixed6_blank_for_missing(spark):
    df = spark.createDataFrame([(1.5,), (None,), (float("nan"),), (2.0000004,)], "x double")
    assert [r[0] for r in df.select(fixed6("x")).collect()] == ["1.500000", "", "", "2.000000"]


def test_parse_ts(spark):
    df = spark.createDataFrame([("2025-01-02 03:04:05",), ("bad",)], "t string")
    got = [r[0] for r in df.select(parse_ts("t")).collect()]
    assert got[0].year == 2025 and got[1] is None


def test_only_decimal_text_is_a_number(spark):
    df = spark.createDataFrame([(s,) for s in ("NaN", "Infinity", "5d", "5f", "1e3", "-2.", ".5", "+7", "1,2,3", "", None)], "x string")
    assert [r[0] for r in df.select(clean_real("x")).collect()] == [None] * 4 + [1000.0, -2.0, 0.5, 7.0, 123.0, None, None]
    assert [r[0] for r in df.select(positive(F.lit(float("nan")))).limit(1).collect()] == [False]
