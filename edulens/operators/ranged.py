"""Tables laid out by ranges of an integer key.

Rows of a range of ``width`` keys share a folder and are sorted by key in it;
the files carry Bloom filters of the key. A lookup therefore reads the folders
of its keys and in them the row groups that can hold them, and an update or a
delete rewrites the ranges that it changes and no other file.

The new rows of the ranges are first written beside the table, then put in
place of the old folders. If that is cut off, running the change again from the
same table or from the rows beside it ends it. One change runs at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from edulens.operators.records import update_rows
from edulens.session import hadoop_fs, scratch_folder

RANGE = "key_range"


@dataclass(frozen=True)
class RangedTable:
    path: str
    schema: StructType
    key: str
    width: int

    def range_of(self, key: Column) -> Column:
        return F.floor(key / F.lit(self.width)).cast("long")

    def with_ranges(self, spark: SparkSession) -> DataFrame:
        """The rows with the range they are in."""
        return spark.read.schema(StructType([*self.schema.fields]).add(RANGE, "long")).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.with_ranges(spark).drop(RANGE)


def _write(df: DataFrame, key: str, path: str, mode: str) -> None:
    (df.hint("rebalance", RANGE).sortWithinPartitions(RANGE, key).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").option(f"parquet.bloom.filter.enabled#{key}", "true")
     .partitionBy(RANGE).parquet(path))


def save_ranged(df: DataFrame, path: str, key: str, width: int) -> RangedTable:
    """Write ``df``, whose ``key`` is a unique integer, by ranges of ``width`` keys.
    Rows without a key have no place and are refused."""
    table = RangedTable(path, df.schema, key, width)
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} is null"))).otherwise(table.range_of(F.col(key)))
    _write(df.withColumn(RANGE, checked.cast("long")), key, path, "overwrite")
    return table


def lookup_ranged(spark: SparkSession, table: RangedTable, key: int) -> DataFrame:
    """The row of one key: one folder, by a filter on its name, and the row groups whose Bloom filter has the key."""
    return table.with_ranges(spark).where((F.col(RANGE) == int(key) // table.width) & (F.col(table.key) == F.lit(int(key)))).drop(RANGE)


def members_ranged(spark: SparkSession, table: RangedTable, keys: DataFrame) -> DataFrame:
    """The rows of a run-time list of keys (one column). The folders follow from
    the list, so the planner can leave out those that it does not name."""
    name = keys.columns[0]
    wanted = (keys.where(F.col(name).isNotNull()).select(F.col(name).cast("long").alias(table.key)).dropDuplicates()
              .withColumn(RANGE, table.range_of(F.col(table.key))))
    return table.with_ranges(spark).join(wanted, [RANGE, table.key], "left_semi").drop(RANGE)


def _replace(spark: SparkSession, table: RangedTable, fresh: DataFrame, hit: DataFrame) -> DataFrame:
    """Put ``fresh`` in place of the ranges ``hit``; ranges left without rows lose their folder.
    One row: ranges rewritten, ranges kept."""
    beside = scratch_folder(spark, "ranges")
    hit.write.parquet(f"{beside}/hit")
    hit = spark.read.schema(hit.schema).parquet(f"{beside}/hit")
    n_all = table.with_ranges(spark).select(RANGE).distinct().count()
    fresh.write.partitionBy(RANGE).parquet(f"{beside}/rows")
    rows = RangedTable(f"{beside}/rows", table.schema, table.key, table.width).with_ranges(spark)
    _write(rows, table.key, table.path, "overwrite")
    empty = hit.join(rows.select(RANGE).distinct(), RANGE, "left_anti").collect()  # folders only, and only emptied ones
    for r in empty:
        fs, where = hadoop_fs(spark, f"{table.path}/{RANGE}={r[RANGE]}")
        fs.delete(where, True)
    return hit.agg(F.count(F.lit(1)).alias("ranges_rewritten")).withColumn("ranges_kept", F.lit(n_all) - F.col("ranges_rewritten"))


def update_ranged(spark: SparkSession, table: RangedTable, updates: DataFrame, order_cols: Sequence[str] = ()) -> DataFrame:
    """:func:`update_rows` on the table in place. Only ranges with a row that the
    updates name are rewritten. One row: affected, ranges_rewritten, ranges_kept."""
    named = updates.select(F.col(table.key).cast("long").alias(table.key)).where(F.col(table.key).isNotNull()).dropDuplicates()
    matched = members_ranged(spark, table, named)
    hit = matched.select(table.range_of(F.col(table.key)).alias(RANGE)).distinct()
    old = table.with_ranges(spark).join(hit, RANGE, "left_semi")
    fresh, affected = update_rows(old, updates, table.key, order_cols)
    n = affected.first()["affected"]
    return _replace(spark, table, fresh, hit).withColumn("affected", F.lit(n).cast("long"))


def delete_ranged(spark: SparkSession, table: RangedTable, keys: DataFrame) -> DataFrame:
    """Delete the rows of ``keys`` (one column) in place; ranges without such a row
    are left alone. One row: affected, ranges_rewritten, ranges_kept."""
    matched = members_ranged(spark, table, keys)
    gone = matched.select(table.key, table.range_of(F.col(table.key)).alias(RANGE))
    hit = gone.select(RANGE).distinct()
    old = table.with_ranges(spark).join(hit, RANGE, "left_semi")
    n = gone.count()
    done = _replace(spark, table, old.join(gone.select(table.key), table.key, "left_anti"), hit)
    return done.withColumn("affected", F.lit(n).cast("long"))
