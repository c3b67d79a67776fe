"""Connected components as Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_table, write_table


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """The smallest vertex that each vertex of ``edges`` (``a``, ``b`` long)
    can reach, as ``(vertex, root)``.

    Each round every vertex takes the smallest label among its neighbours and
    then the label of its label, until no label changes. Rounds grow with the
    logarithm of the longest path in practice. Each round is a written table;
    the driver sees only how many labels changed.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = write_table(spark, both.where("a <> b").distinct(), "edges")
    labels = write_table(spark, links.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("b"))
                         .select("vertex", F.least("vertex", "b").alias("root"), F.lit(True).alias("changed")), "labels")
    while labels.where("changed").limit(1).count():
        known = labels.select(F.col("vertex").alias("v"), F.col("root").alias("r"))
        seen = links.join(known, links.b == known.v).groupBy("a").agg(F.min("r").alias("near"))
        hooked = (labels.join(seen, labels.vertex == seen.a)
                  .select("vertex", F.col("root").alias("old"), F.least("root", "near").alias("root")))
        jumped = (hooked.join(known, hooked.root == known.v, "left")
                  .select("vertex", "old", F.least("root", "r").alias("root")))
        fresh = write_table(spark, jumped.select("vertex", "root", (F.col("root") != F.col("old")).alias("changed")),
                            "labels")
        drop_table(spark, labels)
        labels = fresh
    return labels.select("vertex", "root")
