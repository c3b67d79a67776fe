"""The corpus pipeline: documents are judged by quality rules, one document of
each group of near copies stays, benchmark passages go, sources are mixed to
their target weights, and what is left is dealt to shards of equal bytes.

Each stage takes the rows that the one before it wrote. The mixing stage
decides the order of rows (successive files hold successive slots, rows are
sorted within), and the slots of each shard follow that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edulens.llm import decontaminate, mixing, ngram_join, quality
from edulens.llm.common import write_table
from edulens.llm.queries import sharded


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the weakly supervised rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram Jaccard join."""
    return ngram_join.keep_one_of_each(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the Pfair schedule of their sources."""
    return mixing.in_mixed_order(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row."""
    return sharded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("sharding", shard),
]

#: SQL can express neither the fit of the rules nor the differencing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
