"""Exact ranks without gathering a group into one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` puts a whole group into a
single task. When one group holds a third of all rows that task is the job.
Here a rank is a sum of two parts, both computed in the JVM:

1. bounds: the distinct keys ``(g, k)`` with the smallest hashes, an even
   sample of at most ``SAMPLE_PER_SLICE`` keys a slice, sorted and thinned to
   one bound a slice. They are one scalar subquery, a function of the data;
2. a row's slice is the number of bounds at or below its key (a binary search
   in an expression), so it depends on the row alone: however often, wherever
   and in whatever exchange a row is computed, its slice is the same;
3. the weight of each (slice, group) is summed, partially before the shuffle,
   and a window over this small table gives the weight of earlier slices;
4. a window over (slice, group) gives the weight before the row in its slice.

A hot group is spread over many slices. The number of slices follows the
session's shuffle partitions; which tasks they go to is left to the planner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = "_er_before"
TOTAL = "_er_total"
_SLICE = "_er_slice"
_WEIGHT = "_er_w"
#: Sampled keys for each slice: bounds are the sample's quantiles.
SAMPLE_PER_SLICE = 8


def _slice_bounds(df: DataFrame, keys: Sequence[str], n: int) -> Column:
    """Sorted array of at most ``n`` structs of the keys, as a scalar subquery."""
    sample = (df.select(*keys).dropDuplicates()
                .orderBy(F.xxhash64(*keys), *keys).limit(n * SAMPLE_PER_SLICE))
    return (sample.agg(F.sort_array(F.collect_list(F.struct(*keys))).alias("s"))
                  .select(F.filter("s", lambda _, i: i % SAMPLE_PER_SLICE == SAMPLE_PER_SLICE - 1).alias("s")).scalar())


def _slice_of(keys: Sequence[str], bounds: str, n: int) -> Column:
    """How many of the sorted bounds are at or below the row's key. Structs
    compare field by field, NULL first."""
    key = F.struct(*keys)
    steps = [1 << b for b in reversed(range(max(1, n).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= F.size(bounds)) & (F.get(F.col(bounds), at + step - 1) <= key), at + step)
        .otherwise(at))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    l, r = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        c = F.col(f"_l.`{k}`").eqNullSafe(F.col(f"_r.`{k}`"))
        cond = c if cond is None else cond & c
    extra = [c for c in right.columns if c not in keys]
    return l.join(r, cond, "inner").select("_l.*", *[F.col(f"_r.`{c}`") for c in extra])


def prefix_weights(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                   weight_col: str | None = None, num_slices: int | None = None) -> DataFrame:
    """Add ``_er_before`` (sum of weights of rows ordered strictly before the
    row within its group) and ``_er_total`` (the group's total weight; a NULL
    weight counts 0).

    ``order_cols`` should give a total order within a group, NULL first; rows
    with equal keys lie in one slice and get an arbitrary order among them.
    An empty frame gives an empty frame.
    """
    g, o = list(group_cols), list(order_cols)
    keys = [*g, *[c for c in o if c not in g]]
    n = num_slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weight = F.lit(1).cast("long") if weight_col is None else F.coalesce(F.col(weight_col).cast("long"), F.lit(0).cast("long"))
    sliced = (df.withColumn(_WEIGHT, weight)
                .withColumn("_er_bounds", _slice_bounds(df, keys, n))
                .withColumn(_SLICE, _slice_of(keys, "_er_bounds", n)).drop("_er_bounds"))
    pieces = sliced.groupBy(_SLICE, *g).agg(F.sum(_WEIGHT).alias("_er_piece"))
    by_group = Window.partitionBy(*g) if g else Window.partitionBy()  # one row a slice and group
    offsets = pieces.select(
        _SLICE, *g,
        F.coalesce(F.sum("_er_piece").over(by_group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_er_off"),
        F.sum("_er_piece").over(by_group).alias(TOTAL))
    in_slice = Window.partitionBy(_SLICE, *g).orderBy(*o).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_er_local", F.coalesce(F.sum(_WEIGHT).over(in_slice), F.lit(0)))
    return (_null_safe_join(local, offsets, [_SLICE, *g])
            .withColumn(BEFORE, F.col("_er_off") + F.col("_er_local"))
            .drop("_er_off", "_er_local", _SLICE, _WEIGHT))


def global_row_number(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                      name: str = "rn", num_slices: int | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by group_cols order by order_cols)``
    (1-based) computed as a distributed prefix sum."""
    out = prefix_weights(df, order_cols, group_cols, None, num_slices)
    return out.withColumn(name, (F.col(BEFORE) + 1).cast("long")).drop(BEFORE, TOTAL)


def dense_keys(df: DataFrame, key_cols: Sequence[str], name: str = "key",
               num_slices: int | None = None) -> DataFrame:
    """Deterministic surrogate keys 1..n over the sorted distinct keys
    (deterministic, unlike ``monotonically_increasing_id``)."""
    distinct = df.select(*key_cols).dropDuplicates()
    return global_row_number(distinct, key_cols, (), name, num_slices)
