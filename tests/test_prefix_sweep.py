"""The cap sweep against the analysis run anew on every prefix."""

import random

import pytest

from edulens.operators.relational import cap_intervals, prefix_by_key
from edulens.plans import raw

MATH = "ROW_ID long, ENTITY_CD string, YEAR double, ASSESSMENT_NAME string, SUBGROUP_NAME string, NUM_PROF string, NUM_TESTED string"
DEMO = "ENTITY_CD string, YEAR double, PER_A string, PER_B double"
FACTORS = {"PER_A": "per_a", "PER_B": "per_b"}


def school_rows():
    rng = random.Random(8)
    rows = []
    for i in range(400):
        rows.append((i, f"S{rng.randrange(12)}", rng.choice([2021.0, 2022.0]) if i < 250 else 2023.0, rng.choice(["MATH3", "Math 8", "ELA3"]),
                     rng.choice([" all students", "All Students", "Female"]), rng.choice(["1,2", "7", "s", None]), rng.choice(["1,400", "90", ""])))
    same = (None, "S1", 2023.0, "MATH3", "All Students", "40", "90")
    demo = [(f"S{k}", y, rng.choice(["12.5", "s", str(rng.randrange(90))]), rng.random()) for k in range(11) for y in (2021.0, 2022.0, 2023.0)]
    return [same] * 30 + rows + rows[:5], demo


@pytest.mark.parametrize("caps", [[10, 29, 31, 100, 260, 10_000], [7]])
def test_sweep_is_each_prefix_by_itself(spark, caps):
    rows, demo = school_rows()
    math, demo = spark.createDataFrame(rows, MATH).repartition(5), spark.createDataFrame(demo, DEMO)
    got = {(r["cap"], r["var"]): (r["n"], r["r"], r["slope"]) for r in raw.q1_prefix_sweep(math, demo, caps, ["ROW_ID"], FACTORS).collect()}
    assert len(got) == 2 * len(caps)
    for cap in caps:
        # equal keys are ordered by the columns the analysis reads, as in the sweep
        alone = raw.q1_factor_corr(prefix_by_key(math, cap, ["ROW_ID"]), demo, FACTORS)
        for r in alone.collect():
            n, corr, slope = got[cap, r["var"]]
            assert n == r["n"]
            for a, b in ((corr, r["r"]), (slope, r["slope"])):
                assert (a is None and b is None) or a == pytest.approx(b, abs=1e-9)


def test_intervals_hold_each_row_once(spark):
    df = spark.createDataFrame([(None, "a")] * 6 + [(1, "b"), (2, "c"), (2, "c"), (3, "d")], "k int, v string")
    got = sorted(((r["cap"], r["k"] or 0, r["copies"]) for r in cap_intervals(df, [2, 4, 7, 9], ["k"]).collect()))
    assert got == [(2, 0, 2), (4, 0, 2), (7, 0, 2), (7, 1, 1), (9, 2, 2)]
    assert cap_intervals(df.where("false"), [2], ["k"]).count() == 0
