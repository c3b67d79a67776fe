"""Correlation, regression, significance and 2-D binning."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edulens.operators.stats import (factor_table, factor_table_union, hist2d, linear_fit, pearson,
                                     with_significance)


def test_small_exact_fit(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.5), (4.0, 7.0)], "x double, y double")
    r = pearson(df, "x", "y", r_name="r").collect()[0]["r"]
    fit = linear_fit(df, "x", "y").collect()[0]
    assert r == pytest.approx(0.999321651, abs=1e-9)
    assert fit["slope"] == pytest.approx(1.678571429, abs=1e-9)
    assert fit["intercept"] == pytest.approx(0.25, abs=1e-12)
    assert fit["r2"] == pytest.approx(0.998643762, abs=1e-9)


def test_degenerate_inputs_give_null_not_errors(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    const_x = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    const_y = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, y double")
    for df in (one, const_x):
        f = linear_fit(df, "x", "y").collect()[0]
        assert pearson(df, "x", "y").collect()[0][0] is None
        assert f["slope"] is None
    f = linear_fit(const_y, "x", "y").collect()[0]
    assert pearson(const_y, "x", "y").collect()[0][0] is None
    assert f["slope"] == 0.0 and f["r2"] is None


def test_complete_pairs_keep_r_in_range(spark):
    random.seed(7)
    data = []
    for i in range(300):
        x = random.gauss(0, 1)
        y = 0.5 * x + random.gauss(0, 1)
        if i % 3 == 0:
            x = None
        if i % 7 == 0:
            y = None
        data.append((x, y))
    df = spark.createDataFrame(data, "x double, y double")
    r = pearson(df, "x", "y", n_name="n").collect()[0]
    pairs = [(x, y) for x, y in data if x is not None and y is not None]
    assert r["n"] == len(pairs)
    assert r["correlation"] == pytest.approx(float(np.corrcoef(np.array(pairs).T)[0, 1]), abs=1e-12)
    assert -1.0 <= r["correlation"] <= 1.0


def test_r_is_invariant_under_order_and_partitioning(spark):
    random.seed(3)
    data = [(random.random(), random.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "x double, y double")
    a = pearson(df, "x", "y").collect()[0][0]
    b = pearson(df.repartition(7).orderBy(F.rand(5)), "x", "y").collect()[0][0]
    assert a == pytest.approx(b, abs=1e-12)


def test_factor_table_forms_agree_without_nulls(spark):
    random.seed(11)
    rows = []
    for _ in range(200):
        a, b, c = random.random(), random.random(), random.random()
        rows.append((a, b, c, 0.3 * a - 0.2 * b + random.random() * 0.1))
    df = spark.createDataFrame(rows, "fa double, fb double, fc double, y double")
    one = {r["var"]: r for r in factor_table(df, "y", ["fa", "fb", "fc"]).collect()}
    branch = {r["var"]: r for r in factor_table_union(df, "y", ["fa", "fb", "fc"]).collect()}
    for k in one:
        assert one[k]["n"] == branch[k]["n"] == 200
        assert one[k]["r"] == pytest.approx(branch[k]["r"], abs=1e-9)
        assert one[k]["slope"] == pytest.approx(branch[k]["slope"], abs=1e-9)


def test_factor_table_orders_by_abs_r_and_handles_constant_factor(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 4.0, 1.0), (3.0, 1.0, 1.0), (4.0, 3.0, 1.0)],
                               "y double, fneg double, fconst double")
    out = factor_table(df, "y", ["fneg", "fconst"]).collect()
    assert [r["var"] for r in out] == ["fneg", "fconst"]
    assert out[1]["r"] is None and out[1]["slope"] is None and out[1]["n"] == 4


def _t_sf_numeric(t, dof):
    """Two-sided p of Student's t by numerical integration (independent check)."""
    xs = np.linspace(abs(t), abs(t) + 200.0, 400001)
    c = math.gamma((dof + 1) / 2) / (math.sqrt(dof * math.pi) * math.gamma(dof / 2))
    dens = c * (1 + xs ** 2 / dof) ** (-(dof + 1) / 2)
    return 2 * np.trapezoid(dens, xs)


def test_t_p_value_matches_numeric_integration(spark):
    cases = [(0.5, 10), (-0.4, 22), (0.05, 5), (0.9, 3), (0.2, 52), (0.001, 4), (0.03, 150)]
    got = with_significance(spark.createDataFrame([(n, r) for r, n in cases], "n bigint, r double")).collect()
    for row in got:
        # a tail of t with one degree of freedom ends far beyond the integral's range
        exact = 2 * math.atan2(1, abs(row["t"])) / math.pi if row["n"] == 3 else _t_sf_numeric(row["t"], row["n"] - 2)
        assert row["p_value"] == pytest.approx(exact, abs=2e-4 if row["n"] < 6 else 1e-6)


def test_t_p_value_of_many_rows_is_normal(spark):
    n = 4_000_000_000
    rows = with_significance(spark.createDataFrame([(n, z / math.sqrt(n)) for z in (0.0, 1.0, 1.96, 4.0, 60.0)], "n bigint, r double"))
    for z, row in zip((0.0, 1.0, 1.96, 4.0, 60.0), rows.collect(), strict=True):
        assert row["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-5, abs=1e-15)


def test_factor_names_are_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], ["y", "it's `a` \\ name"])
    assert factor_table(df, "y", df.columns[1:]).first()["var"] == df.columns[1]


def test_factor_table_by_group(spark):
    rows = [(g, float(i), float(i * (1 if g else -1))) for g in (0, 1) for i in range(5)]
    got = factor_table(spark.createDataFrame(rows, "g int, y double, f double"), "y", ["f"], by=["g"]).collect()
    assert [(r["g"], r["var"], r["n"], round(r["r"], 9)) for r in got] == [(0, "f", 5, -1.0), (1, "f", 5, 1.0)]


def test_significance_columns(spark):
    df = spark.createDataFrame([(10, 0.5), (2, 0.3), (5, 1.0), (5, None)], "n bigint, r double")
    out = with_significance(df).collect()
    t = 0.5 * math.sqrt(8 / 0.75)
    assert out[0]["t"] == pytest.approx(t) and out[0]["p_value"] == pytest.approx(_t_sf_numeric(t, 8), abs=1e-6)
    assert out[1]["t"] is None and out[1]["p_value"] is None
    assert out[2]["p_value"] == 0.0
    assert out[3]["p_value"] is None


def test_hist2d_top_edge_in_last_bin(spark):
    pts = spark.createDataFrame([(0.0, 0.0), (10.0, 5.0), (5.0, 2.5), (10.0, 0.0)], "x double, y double")
    got = {(r["x_bin"], r["y_bin"]): r["n"] for r in hist2d(pts, "x", "y", 100).collect()}
    assert got == {(0, 0): 1, (99, 99): 1, (50, 50): 1, (99, 0): 1}
    assert sum(got.values()) == 4


def test_hist2d_constant_column_goes_to_middle_bin(spark):
    pts = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "x double, y double")
    got = sorted((r["x_bin"], r["y_bin"], r["n"]) for r in hist2d(pts, "x", "y", 100).collect())
    assert got == [(50, 0, 1), (50, 99, 1)]
