"""Exact percentiles by group, distributed.

Spark's exact ``percentile``/``median`` merge a map of every distinct value of
a group in one task. Here the values are first counted per (group, value)
(map-side combine), then ranked with the distributed prefix sum of
:mod:`edulens.operators.ranking`; only the one or two rows per statistic that
hold the target ranks survive to the final, tiny aggregation.

Statistics (``n`` = non-NULL values of the group, ranks 1-based):

* ``("nearest_rank", p)``: the smallest value with at least ``p`` percent of
  the values at or below it (rank ``p/100*n`` rounded up, held between 1 and n).
* ``("median",)``: middle value, mean of the two middle values for even ``n``.
* ``("linear", q)``: linear interpolation between closest ranks at
  ``h = (n-1)*q`` (the default of numpy's percentile), ``0 <= q <= 1``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edulens.operators.ranking import BEFORE, TOTAL, prefix_weights

_COUNT = "_q_c"


def _targets(spec: tuple, n: Column) -> tuple[Column, Column, Column | None]:
    """(low rank, high rank, weight of high) for one statistic."""
    kind = spec[0]
    if kind == "nearest_rank":
        share = F.lit(float(spec[1]) / 100.0)
        rank = F.least(n, F.greatest(F.lit(1), F.ceil(share * n))).cast("long")
        return rank, rank, None
    if kind == "median":
        return F.floor((n + 1) / 2).cast("long"), F.ceil((n + 1) / 2).cast("long"), F.lit(0.5)
    if kind == "linear":
        q = float(spec[1])
        h = (n - 1).cast("double") * F.lit(q)
        return (F.floor(h) + 1).cast("long"), (F.ceil(h) + 1).cast("long"), h - F.floor(h)
    raise ValueError(f"unknown statistic {spec!r}")


def _covers(rank: Column) -> Column:
    return (F.col(BEFORE) < rank) & (rank <= F.col(BEFORE) + F.col(_COUNT))


def exact_quantiles(df: DataFrame, value_col: str, stats: Mapping[str, tuple],
                    group_cols: Sequence[str] = (), count_name: str | None = "n",
                    num_slices: int | None = None, weight_col: str | None = None) -> DataFrame:
    """One row per group with the requested exact statistics of ``value_col``
    (NULL values ignored; groups with no value are absent). With ``weight_col``
    a row stands for that many values, e.g. in a table of counts."""
    g = list(group_cols)
    times = F.count(F.lit(1)) if weight_col is None else F.sum(F.col(weight_col)).cast("long")
    counted = df.where(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(times.alias(_COUNT))
    if weight_col is not None:
        counted = counted.where(F.col(_COUNT) > 0)
    ranked = prefix_weights(counted, [value_col], g, _COUNT, num_slices)
    n = F.col(TOTAL)
    targets = {name: _targets(spec, n) for name, spec in stats.items()}
    hit = None
    for lo, hi, _ in targets.values():
        c = _covers(lo) | _covers(hi)
        hit = c if hit is None else hit | c
    picked = ranked.where(hit)
    aggs = [F.max(F.col(TOTAL)).alias("_q_n")]
    for name, (lo, hi, _) in targets.items():
        aggs.append(F.max(F.when(_covers(lo), F.col(value_col))).alias(f"_q_{name}_lo"))
        aggs.append(F.max(F.when(_covers(hi), F.col(value_col))).alias(f"_q_{name}_hi"))
    grouped = picked.groupBy(*g).agg(*aggs)
    out_cols = [F.col(c) for c in g]
    if count_name:
        out_cols.append(F.col("_q_n").cast("long").alias(count_name))
    for name, (lo, hi, w) in targets.items():
        vlo, vhi = F.col(f"_q_{name}_lo"), F.col(f"_q_{name}_hi")
        if w is None:
            val = vlo
        elif stats[name][0] == "median":
            val = (vlo + vhi) / 2
        else:
            h = (F.col("_q_n") - 1).cast("double") * F.lit(float(stats[name][1]))
            val = vlo + (h - F.floor(h)) * (vhi - vlo)
        out_cols.append(val.alias(name))
    return grouped.select(*out_cols)


def clip_above_quantile(df: DataFrame, value_col: str, q: float = 0.99) -> DataFrame:
    """Keep rows with ``value <= linear quantile q`` of the column (numpy's
    default interpolation); the threshold is a scalar subquery, computed once."""
    thr = exact_quantiles(df, value_col, {"thr": ("linear", q)}, count_name=None)
    return df.where(F.col(value_col) <= thr.select("thr").scalar())
