"""Rates, weighted means and composition tables (grouped, algebraic)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edulens.functions.cleaning import _col


def guarded_ratio(num, den, scale: float = 1.0) -> Column:
    """``CASE WHEN den > 0 THEN scale * num / den END`` (never divides by 0)."""
    return F.when(_col(den) > 0, F.try_divide(F.lit(float(scale)) * _col(num), _col(den)))


def grouped_rate(df: DataFrame, keys: Sequence, num, den, scale: float = 100.0,
                 rate_name: str = "rate", num_name: str | None = None,
                 den_name: str | None = None) -> DataFrame:
    """Per group: ``scale * SUM(num) / SUM(den)``, NULL unless SUM(den) > 0."""
    s_num, s_den = F.sum(_col(num)), F.sum(_col(den))
    aggs = []
    if num_name:
        aggs.append(s_num.alias(num_name))
    if den_name:
        aggs.append(s_den.alias(den_name))
    aggs.append(guarded_ratio(s_num, s_den, scale).alias(rate_name))
    return df.groupBy(*keys).agg(*aggs)


def weighted_mean(df: DataFrame, keys: Sequence, x, w, name: str = "wmean",
                  complement: float | None = None, complement_name: str | None = None) -> DataFrame:
    """Per group ``SUM(x*w)/SUM(w)`` (NULL unless SUM(w) > 0) and optionally
    ``complement - mean`` (e.g. attendance = 100 - absence)."""
    s_xw, s_w = F.sum(_col(x) * _col(w)), F.sum(_col(w))
    mean = F.when(s_w > 0, F.try_divide(s_xw, s_w))
    aggs = [mean.alias(name)]
    if complement is not None:
        aggs.append(F.when(s_w > 0, F.lit(float(complement)) - F.try_divide(s_xw, s_w))
                    .alias(complement_name or f"{name}_complement"))
    return df.groupBy(*keys).agg(*aggs)


def share_of_group(df: DataFrame, keys: Sequence[str], value_col: str, name: str = "share",
                   total_name: str | None = None) -> DataFrame:
    """Each row's share of its group total (``1.0 * x / SUM(x) OVER group``),
    NULL when the total is not positive. Meant for inputs whose grain bounds
    the rows per group (e.g. one row per school and subgroup)."""
    total = F.sum(F.col(value_col)).over(Window.partitionBy(*keys))
    out = df.withColumn("_grp_total", total)
    out = out.withColumn(name, guarded_ratio(F.col(value_col), F.col("_grp_total"), 1.0))
    if total_name:
        return out.withColumnRenamed("_grp_total", total_name)
    return out.drop("_grp_total")
