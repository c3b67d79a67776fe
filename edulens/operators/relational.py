"""Relational helpers: prefix of rows by key, latest row per group and
run-time membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edulens.operators.ranking import BEFORE, global_row_number, prefix_weights


def prefix_by_key(df: DataFrame, n: int, order_cols: Sequence[str]) -> DataFrame:
    """"First n rows" with an explicit order, NULL first (a bare LIMIT has no
    meaning on a distributed table): exactly n rows, or all when there are
    fewer. Rows with equal keys are ordered by their other columns, so rows
    that are cut differ from those that stay unless they are equal throughout.
    Lazy: the rows are ranked by :func:`global_row_number` and filtered."""
    rest = [c for c in df.columns if c not in order_cols]
    return global_row_number(df, [*order_cols, *rest], name="_prefix_rn").where(F.col("_prefix_rn") <= int(n)).drop("_prefix_rn")


def cap_intervals(df: DataFrame, caps: Sequence[int], order_cols: Sequence[str], name: str = "cap", weight: str = "copies"
                  ) -> DataFrame:
    """For every row the smallest of the ascending ``caps`` whose "first n rows"
    (:func:`prefix_by_key`) hold it; rows beyond the last cap are left out. Equal
    rows are counted in ``weight``, and in two rows where a cap lies between them.
    What holds for a cap is then the sum over its own and all smaller intervals,
    so one pass over the table serves all caps."""
    rest = [c for c in df.columns if c not in order_cols]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(weight))
    placed = prefix_weights(counted, [*order_cols, *rest], (), weight)
    first, last = F.col(BEFORE), F.col(BEFORE) + F.col(weight)
    bounds = [0, *caps]
    parts = F.array(*[F.struct(F.lit(int(hi)).cast("long").alias(name),
                               F.greatest(F.lit(0), F.least(last, F.lit(hi)) - F.greatest(first, F.lit(lo))).cast("long").alias("_held"))
                      for lo, hi in zip(bounds, bounds[1:])])
    return (placed.where(first < int(caps[-1])).select(*df.columns, F.inline(parts)).where("_held > 0")
            .withColumnRenamed("_held", weight))


def latest_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` (lexicographic, e.g. timestamp
    then id as tiebreak) per group, as a ``max(struct)`` aggregate: partial
    aggregation keeps one candidate per group per partition, so a hot group
    is never gathered into one task (unlike ``row_number() = 1``)."""
    rest = [c for c in df.columns if c not in group_cols and c not in order_cols]
    best = F.max(F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest])).alias("_best")
    return df.groupBy(*group_cols).agg(best).select(*group_cols, *[F.col(f"_best.{c}").alias(c) for c in df.columns
                                                                    if c not in group_cols])


def members(df: DataFrame, key_cols: Sequence[str], allowed: DataFrame) -> DataFrame:
    """Rows whose key is in ``allowed`` (``IN (...)`` with a run-time list)."""
    return df.join(allowed.select(*key_cols).dropDuplicates(), list(key_cols), "left_semi")
