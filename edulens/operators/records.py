"""Run-log record maintenance as batch DataFrame operations.

The run log is two tables: launches (launch_id, timestamp, query_name,
query_version) and results (result_id, launch_id, dataset_size, run_index,
elapsed_seconds), results referencing launches. Each function takes the
current tables and returns new ones; writing them (``mode("overwrite")`` to
a new path, or ``append``) is the caller's choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edulens.operators.ranking import global_row_number


def append_with_keys(existing: DataFrame, new: DataFrame, key_col: str, order_cols: Sequence[str]) -> DataFrame:
    """Append ``new`` rows, giving each a key ``max(existing key) + rank``
    where rank follows ``order_cols`` (a total order) -- an auto-increment
    key for a whole batch, computed with distributed ranks. Rows of ``new``
    that already carry a key keep it, and the new keys come after these too."""
    taken = existing.select(F.col(key_col).cast("long").alias("k"))
    if key_col in new.columns:
        taken = taken.unionByName(new.select(F.col(key_col).cast("long").alias("k")))
    start = taken.agg(F.coalesce(F.max("k"), F.lit(0).cast("long")).alias("m")).select("m").scalar()
    missing = new.where(F.col(key_col).isNull()) if key_col in new.columns else new
    given = new.where(F.col(key_col).isNotNull()) if key_col in new.columns else None
    ranked = global_row_number(missing.drop(key_col) if key_col in missing.columns else missing,
                               order_cols, name="_new_rn")
    keyed = ranked.withColumn(key_col, (start + F.col("_new_rn")).cast("long")).drop("_new_rn")
    out = existing.unionByName(keyed.select(*existing.columns))
    if given is not None:
        out = out.unionByName(given.select(*existing.columns))
    return out


def lookup(df: DataFrame, key_col: str, key) -> DataFrame:
    """Point lookup by primary key (zero or one row)."""
    return df.where(F.col(key_col) == F.lit(key))


def update_rows(df: DataFrame, updates: DataFrame, key_col: str, order_cols: Sequence[str] = ()
                ) -> tuple[DataFrame, DataFrame]:
    """Set the columns that ``updates`` names, NULL included, in the rows with
    its keys; nothing is inserted. Of several updates of a key the greatest by
    ``order_cols`` counts, then by the values themselves; an update without a
    key matches nothing. Returns (new table, one-row frame with ``affected`` =
    updated rows)."""
    named = [c for c in updates.columns if c != key_col and c in df.columns]
    last = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                          *[F.col(c).alias(f"v{i}") for i, c in enumerate(named)], F.lit(True).alias("hit")))
    u = updates.where(F.col(key_col).isNotNull()).groupBy(key_col).agg(last.alias("_update"))
    merged = df.join(u, key_col, "left")
    out = merged.select(*[
        F.when(F.col("_update").isNotNull(), F.col(f"_update.v{named.index(c)}")).otherwise(F.col(c)).alias(c)
        if c in named else F.col(c) for c in df.columns])
    affected = df.join(u.select(key_col), key_col, "left_semi").agg(F.count(F.lit(1)).cast("long").alias("affected"))
    return out, affected


def delete_cascade(parent: DataFrame, child: DataFrame, key_col: str, predicate: Column
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delete parent rows matching ``predicate`` (unknown is no match) and, as
    the foreign key declares (ON DELETE CASCADE), the child rows that reference
    them. Returns (new parent, new child, one-row counts of deleted rows)."""
    hit = F.coalesce(predicate, F.lit(False))
    gone = parent.where(hit).select(key_col)
    new_child = child.join(gone, key_col, "left_anti")
    counts = (gone.agg(F.count(F.lit(1)).cast("long").alias("parents_deleted"))
                  .select("parents_deleted",
                          child.join(gone, key_col, "left_semi").agg(F.count(F.lit(1))).scalar()
                          .cast("long").alias("children_deleted")))
    return parent.where(~hit), new_child, counts


def constraint_report(tables: Mapping[str, DataFrame], not_null: Mapping[str, Sequence[str]],
                      primary_keys: Mapping[str, str],
                      foreign_keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Violations of declared constraints as rows (table, constraint, column,
    violations): NULLs in NOT NULL columns, duplicated primary keys, and
    child keys with no parent (foreign key orphans)."""
    parts = []
    for t, cols in not_null.items():
        df = tables[t]
        aggs = [F.count(F.when(F.col(c).isNull(), F.lit(1))).cast("long").alias(c) for c in cols]
        one = df.agg(*aggs)
        stack = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit("not_null").alias("constraint_name"),
                                   F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in cols])
        parts.append(one.select(F.inline(stack)))
    for t, pk in primary_keys.items():
        dup = (tables[t].groupBy(pk).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1)
                        .agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("long").alias("violations")))
        parts.append(dup.select(F.lit(t).alias("table_name"), F.lit("primary_key").alias("constraint_name"),
                                F.lit(pk).alias("column_name"), "violations"))
    for child, ck, parent, pk in foreign_keys:
        orphans = (tables[child].where(F.col(ck).isNotNull())
                   .join(tables[parent].select(F.col(pk).alias(ck)), ck, "left_anti")
                   .agg(F.count(F.lit(1)).cast("long").alias("violations")))
        parts.append(orphans.select(F.lit(child).alias("table_name"), F.lit("foreign_key").alias("constraint_name"),
                                    F.lit(ck).alias("column_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
