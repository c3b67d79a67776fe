"""Run-log analytics: latency percentiles per query, comparisons and trends.

Inputs are the launch and result tables of :mod:`edulens.operators.records`.
Percentiles are exact and distributed (:mod:`edulens.operators.quantiles`):
median (mean of the two middle values for an even count) and nearest-rank
P95 per (query, version, dataset size), over non-NULL elapsed times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edulens.functions import fixed6
from edulens.operators.quantiles import exact_quantiles
from edulens.operators.relational import latest_per_group, members
from edulens.operators.stats import linear_fit

KEY = ["query_name", "query_version"]


def selected_launches(launch: DataFrame, latest_only: bool) -> DataFrame:
    """Launches per (query_name, query_version): only the latest (by
    timestamp, then launch_id) or all of them."""
    if latest_only:
        return latest_per_group(launch.select("launch_id", "timestamp", *KEY), KEY, ["timestamp", "launch_id"])
    return launch.select("launch_id", "timestamp", *KEY)


def latency_percentiles(launch: DataFrame, result: DataFrame, latest_only: bool = True,
                        queries: DataFrame | None = None) -> DataFrame:
    """query_name, query_version, dataset_size, p50_s, p95_s, size_runs, num_runs.

    ``num_runs`` counts results with an elapsed time over all sizes of the
    selection (as the reference reports it); ``queries`` optionally limits
    the (name, version) pairs (a run-time IN list as a semi join).
    """
    launches = selected_launches(launch, latest_only)
    if queries is not None:
        launches = members(launches, KEY, queries)
    return _percentiles(timed_results(launches, result))


def timed_results(launches: DataFrame, result: DataFrame) -> DataFrame:
    """The elapsed times of ``launches``, without those that were not timed."""
    return (result.where(F.col("elapsed_seconds").isNotNull())
                  .join(launches.select("launch_id", *KEY), "launch_id")
                  .select(*KEY, "dataset_size", "elapsed_seconds"))


def _percentiles(timed: DataFrame, weight_col: str | None = None) -> DataFrame:
    per_size = exact_quantiles(timed, "elapsed_seconds", {"p50_s": ("median",), "p95_s": ("nearest_rank", 95)},
                               group_cols=[*KEY, "dataset_size"], count_name="size_runs", weight_col=weight_col)
    # every timed result is in one size, so the sizes sum up to the runs
    return per_size.withColumn("num_runs", F.sum("size_runs").over(Window.partitionBy(*KEY)))


def latency_counts(launch: DataFrame, result: DataFrame) -> DataFrame:
    """query_name, query_version, dataset_size, elapsed_seconds, n: how often each
    time was measured. Counts of parts of the results add up to those of all, so
    a table of them serves percentiles without the results."""
    timed = timed_results(launch.select("launch_id", *KEY), result)
    return timed.groupBy(*timed.columns).agg(F.count(F.lit(1)).alias("n"))


def percentiles_of_counts(counts: DataFrame) -> DataFrame:
    """:func:`latency_percentiles` of all launches, from tables of :func:`latency_counts`."""
    return _percentiles(counts, "n")


def two_queries(stats: DataFrame, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """Side by side per dataset size: a_p50_s, a_p95_s, b_p50_s, b_p95_s
    (NULL where a query has no result at that size)."""
    def of(q):
        return (F.col("query_name") == q[0]) & (F.col("query_version") == q[1])

    sides = [F.max(F.when(of(q), F.col(c))).alias(f"{prefix}_{c}")
             for prefix, q in (("a", a), ("b", b)) for c in ("p50_s", "p95_s", "num_runs")]
    return stats.where((of(a) | of(b)) & F.col("dataset_size").isNotNull()).groupBy("dataset_size").agg(*sides)


def comparison_grid(spark: SparkSession, stats: DataFrame, comparisons: Sequence[tuple[str, tuple[str, str], tuple[str, str]]],
                    sizes: Sequence[int]) -> DataFrame:
    """One row per (comparison, dataset size) with the baseline and star
    query's P50/P95 as six-decimal text (blank when missing) and run counts.

    Each side of a comparison meets the statistics once; a comparison then
    holds its sides' statistics of the asked sizes and is laid out by size."""
    labels = ["comparison", "baseline_name", "baseline_version", "star_name", "star_version"]
    sides = spark.createDataFrame(
        [(c, *base, *star, side, *query) for c, base, star in comparisons for side, query in (("baseline", base), ("star", star))],
        ", ".join(f"{c} string" for c in [*labels, "side", *KEY]))
    met = sides.join(stats, KEY, "left")
    asked = F.col("dataset_size").isin([int(s) for s in sizes])
    entry = F.struct(F.col("dataset_size").cast("long"), F.struct("p50_s", "p95_s"))
    columns = []
    for side in ("baseline", "star"):
        here = F.col("side") == side
        columns += [F.map_from_entries(F.collect_list(F.when(here & asked, entry))).alias(side),
                    F.coalesce(F.max(F.when(here, F.col("num_runs"))), F.lit(0)).cast("long").alias(f"{side}_num_runs")]
    grid = met.groupBy(*labels).agg(*columns).withColumn(
        "dataset_size", F.explode(F.array(*[F.lit(int(s)).cast("long") for s in sizes])))

    def text(side, statistic):
        return fixed6(F.try_element_at(side, "dataset_size")[statistic]).alias(f"{side}_{statistic}")

    return grid.select("comparison", "dataset_size",
                       "baseline_name", "baseline_version", text("baseline", "p50_s"), text("baseline", "p95_s"),
                       "baseline_num_runs",
                       "star_name", "star_version", text("star", "p50_s"), text("star", "p95_s"), "star_num_runs")


def latency_trend(stats: DataFrame, rows_unit: int = 1000) -> DataFrame:
    """Per query and version: linear fit of P50 against dataset size in units
    of ``rows_unit`` rows: n, slope (seconds per unit), intercept (seconds),
    R^2 (NULL when P50 is constant)."""
    x = (F.col("dataset_size").cast("double") / F.lit(float(rows_unit))).alias("k_rows")
    return linear_fit(stats.select(*KEY, x, "p50_s"), "k_rows", "p50_s", KEY)


def launch_timeline(launch: DataFrame, query: tuple[str, str]) -> DataFrame:
    """Launches of one query and version in ascending time order."""
    return (launch.where((F.col("query_name") == query[0]) & (F.col("query_version") == query[1]))
                  .orderBy("timestamp", "launch_id"))
