"""One query for each operator, over its whole table with the operator's
production parameters. ``ORACLE`` has DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_trie,
    decontaminate,
    filter_audit,
    license_scan,
    mixing,
    ngram_join,
    quality,
    quality_model,
    sharding,
    token_counts,
    token_files,
    toxicity,
    warc_index,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder, captures = warc_index.write_archives(pages)
    return warc_index.lookup(pages, folder, warc_index.write_index(folder, captures))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("file", "row")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_shards(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_shards(manifest)


def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"), license_scan.known_licences(spark))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(spark, _table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def sharded(docs: DataFrame) -> DataFrame:
    """The rows of the sharding operator with the names of its law."""
    return sharding.shard_by_bytes(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(spark, *conversation_trie.rebuilt(_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc_index, op2_mix_sources, op3_token_shards, op4_license_digests, op5_ngram_jaccard, op6_toxicity,
        op7_quality_rules, op8_token_counts, op9_decontaminate, op10_shard_bytes, op11_filter_audit, op12_quality_model, op13_conversation_trie)
}

ORACLE: dict[str, str] = {"op4_license_digests": license_scan.oracle_sql(), "op11_filter_audit": filter_audit.oracle_sql()}
