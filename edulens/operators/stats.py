"""Correlation, regression, significance and binning as algebraic aggregates.

All statistics here are built from Spark's centered moment aggregates
(``covar_pop``, ``stddev_pop``, ``var_pop``, ``regr_*``), which combine
partial results map-side, so a hot group never costs more than one partial
row per partition. ``corr()`` is not used: under ANSI mode it raises
DIVIDE_BY_ZERO on a constant column, and a ``when`` around it cannot help.

Pearson r is taken over complete pairs only (rows where x and y are both
non-NULL), which keeps |r| <= 1 when either side has gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Backtick-quoted column reference for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def _masked(x: str, y: str) -> tuple[str, str, str]:
    both = f"({q(x)} IS NOT NULL AND {q(y)} IS NOT NULL)"
    return f"CASE WHEN {both} THEN {q(x)} END", f"CASE WHEN {both} THEN {q(y)} END", both


def pearson_sql(x: str, y: str) -> str:
    xm, ym, _ = _masked(x, y)
    r = f"try_divide(covar_pop({xm}, {ym}), stddev_pop({xm}) * stddev_pop({ym}))"
    # clamp rounding noise into [-1, 1]; least/greatest skip NULLs, so keep NULL explicitly
    return f"CASE WHEN {r} IS NULL THEN NULL ELSE greatest(-1.0D, least(1.0D, {r})) END"


def pearson_expr(x: str, y: str) -> Column:
    """Guarded Pearson r over complete pairs; NULL when either side is
    constant or fewer than two pairs exist. Built as one SQL expression
    (parsed once by Catalyst) rather than dozens of Column calls."""
    return F.expr(pearson_sql(x, y))


def pair_count_expr(x: str, y: str) -> Column:
    _, _, both = _masked(x, y)
    return F.expr(f"count(CASE WHEN {both} THEN 1 END)")


def slope_expr(x: str, y: str) -> Column:
    """Least-squares slope of y on x; NULL when x is constant."""
    return F.expr(f"regr_slope({q(y)}, {q(x)})")


def intercept_expr(x: str, y: str) -> Column:
    return F.expr(f"regr_intercept({q(y)}, {q(x)})")


def r2_expr(x: str, y: str) -> Column:
    """Coefficient of determination; NULL when y is constant (``regr_r2``
    alone would report 1.0 there)."""
    _, ym, _ = _masked(x, y)
    return F.expr(f"CASE WHEN var_pop({ym}) > 0 THEN regr_r2({q(y)}, {q(x)}) END")


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = (), r_name: str = "correlation",
            n_name: str | None = None) -> DataFrame:
    """Pearson r of x and y, globally or per group."""
    aggs = [pearson_expr(x, y).alias(r_name)]
    if n_name:
        aggs.insert(0, pair_count_expr(x, y).alias(n_name))
    return df.groupBy(*by).agg(*aggs)


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R^2 of y = slope*x + intercept (``polyfit`` deg 1)."""
    return df.groupBy(*by).agg(
        pair_count_expr(x, y).alias("n"),
        slope_expr(x, y).alias("slope"),
        intercept_expr(x, y).alias("intercept"),
        r2_expr(x, y).alias("r2"),
    )


def factor_table(df: DataFrame, y: str, factors: Sequence[str], name_col: str = "var", by: Sequence[str] = ()) -> DataFrame:
    """Correlate many factor columns with one outcome in a single pass.

    One aggregation (per group of ``by``) computes (n, r, slope) for every factor
    with masked complete-pair moments; each aggregated row is turned into one row
    per factor. Output: ``by``, ``var, n, r, slope`` ordered by ``by``, then |r|
    desc, NULLs last.
    """
    aggs = []
    for i, f in enumerate(factors):
        _, _, both = _masked(f, y)
        aggs += [F.expr(f"count(CASE WHEN {both} THEN 1 END)").alias(f"n{i}"), pearson_expr(f, y).alias(f"r{i}"),
                 slope_expr(f, y).alias(f"s{i}")]
    rows = F.array(*[F.struct(F.lit(f).alias(name_col), F.col(f"n{i}").cast("long").alias("n"), F.col(f"r{i}").alias("r"),
                              F.col(f"s{i}").alias("slope")) for i, f in enumerate(factors)])
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(rows)).orderBy(*by, F.abs(F.col("r")).desc_nulls_last())


def factor_table_union(df: DataFrame, y: str, factors: Sequence[str], name_col: str = "var") -> DataFrame:
    """The table of :func:`factor_table` from a UNION ALL: one (factor name,
    x, y) relation per factor, correlated by factor name. It reads its input
    once per factor; the one-pass form is the one to use on large inputs."""
    long = None
    for f in factors:
        part = df.select(F.lit(f).alias(name_col), F.col(f).cast("double").alias("_x"), F.col(y).alias("_y"))
        long = part if long is None else long.unionByName(part)
    return (long.groupBy(name_col)
                .agg(pair_count_expr("_x", "_y").cast("long").alias("n"), pearson_expr("_x", "_y").alias("r"),
                     slope_expr("_x", "_y").alias("slope"))
                .orderBy(F.abs(F.col("r")).desc_nulls_last()))


# --- significance -----------------------------------------------------------

#: Intervals of the quadrature, and standard deviations that it covers.
TAIL_STEPS, TAIL_WIDTH = 1000, 9


def t_two_sided_p_sql(r: str, dof: str) -> str:
    """Two-sided p of a Pearson r with ``dof`` = n - 2 degrees of freedom.

    With t = sqrt(dof) * tan(a) the t density turns into cos(a)^(dof-1), and the
    angle of t is asin|r|: p is the part of that curve's area beyond the angle.
    Both areas are Simpson sums over at most ``TAIL_WIDTH`` / sqrt(dof), beyond
    which less than 1e-17 of the area is left."""
    def area(start: str) -> str:
        stop = f"least(pi() / 2, {start} + {TAIL_WIDTH} / sqrt({dof}))"
        weight = f"CASE WHEN k IN (0, {TAIL_STEPS}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
        node = f"{start} + ({stop} - {start}) * k / {TAIL_STEPS}"
        return (f"(({stop} - {start}) * aggregate(sequence(0, {TAIL_STEPS}), 0.0D, "
                f"(s, k) -> s + {weight} * pow(greatest(cos({node}), 0.0D), {dof} - 1)))")
    return f"least(1.0D, {area(f'asin(abs({r}))')} / {area('0.0D')})"


def t_statistic_expr(n: Column, r: Column) -> Column:
    """t = r * sqrt((n-2) / (1-r^2)); NULL for n <= 2 and for |r| = 1 (infinite
    t, whose p-value 0 is set by :func:`with_significance`)."""
    return F.when((n > 2) & (F.abs(r) < 1), r * F.sqrt((n - 2) / (1 - r * r)))


def with_significance(df: DataFrame, n_col: str = "n", r_col: str = "r") -> DataFrame:
    """Add ``t`` and two-sided ``p_value`` (Pearson r test, n - 2 degrees of
    freedom) to aggregated rows: 0 for |r| = 1, NULL for n <= 2 or no r."""
    n, r = F.col(n_col), F.col(r_col)
    tail = F.expr(t_two_sided_p_sql(q(r_col), f"({q(n_col)} - 2)"))
    return df.withColumn("t", t_statistic_expr(n, r)).withColumn(
        "p_value", F.when((n > 2) & (F.abs(r) >= 1), F.lit(0.0)).when((n > 2) & r.isNotNull(), tail))


# --- 2-D histogram --------------------------------------------------------------

def hist2d(df: DataFrame, x: str, y: str, bins: int = 100) -> DataFrame:
    """Sparse 2-D histogram with ``bins`` x ``bins`` equal-width bins spanning
    each column's [min, max]; the top edge belongs to the last bin. A column
    with min == max uses [min-0.5, max+0.5] (numpy's convention).

    The bounds are one struct-valued scalar subquery (a tiny global aggregate);
    the counts are a grouped count with map-side combine.
    Output: x_bin, y_bin, n (only non-empty bins).
    """
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    bounds = pts.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"),
                              F.max(y).alias("y1")).alias("b")).select("b").scalar()
    # one occurrence of the subquery; the bin expressions read its fields
    pts = pts.select(x, y, bounds.alias("_bounds"))
    x0, x1, y0, y1 = (F.col(f"_bounds.{c}") for c in ("x0", "x1", "y0", "y1"))

    def bin_of(v, lo, hi):
        lo_e = F.when(hi > lo, lo).otherwise(lo - 0.5)
        hi_e = F.when(hi > lo, hi).otherwise(hi + 0.5)
        raw = F.floor((F.col(v) - lo_e) / (hi_e - lo_e) * F.lit(bins)).cast("int")
        return F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))

    return (pts.select(bin_of(x, x0, x1).alias("x_bin"), bin_of(y, y0, y1).alias("y_bin"))
               .groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).cast("long").alias("n")))
