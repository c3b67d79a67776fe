"""Sharding by Karmarkar-Karp differencing: groups of equal texts, which must
stay together, go to a fixed number of shards of nearly equal bytes.

A partial partition is a tuple of as many sums as there are shards. The rule
is to take the two tuples of the largest spread and add them in opposite order,
until one is left. Tasks apply it to lots of groups that a hash deals, and lots
are the leaves of a tree of ``FAN`` children a node. A group that is large
against the children of a node belongs to the node, so that large groups are
differenced first. Each node starts from its share of the sums that its parent
reached and balances them with groups of its own: what a huge group puts in one
shard, all lots under it make up for. No step holds more than the groups of one
node, and nothing is collected. Hot groups are summed before the shuffle and
joined back with a join that can be split. A table of one lot is differenced as
a whole; beyond it, sizes differ by some bytes for each lot.

Slots number the rows of a shard without gaps, in order of place in the input.

A null text counts as empty (size 8) and shares a group with empty texts. Null
or repeated ids and repeated rows are rows of their own. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_length, numbered, row_position, write_table

SHARDS = 24
ROW_BYTES = 8
#: Groups that are differenced together, at most.
LOT = 20_000
#: Children of a node, and how many groups of a node's least size fill a child's shard.
FAN, SMALL = 16, 64


def difference(sums: np.ndarray) -> np.ndarray:
    """Combine partial partitions by largest differencing. ``sums`` is (n,
    shards); the result gives, for each tuple and each of its places, the bin of the whole."""
    n, shards = sums.shape
    if not n:
        return np.empty((0, shards), np.int64)
    place = [np.argsort(-row, kind="stable") for row in sums]
    tuples = [row[p] for row, p in zip(sums, place, strict=True)]
    heap = [(int(t[-1] - t[0]), i) for i, t in enumerate(tuples)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = tuples[a] + tuples[b][::-1]
        order = np.argsort(-total, kind="stable")
        merges.append((a, b, order))
        tuples[a] = tuples[b] = None
        tuples.append(total[order])
        heapq.heappush(heap, (int(total[order[-1]] - total[order[0]]), len(tuples) - 1))
    # from the last tuple back to the first ones: the bin of each sorted place
    bins: list = [None] * len(tuples)
    bins[-1] = np.arange(shards)
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        of = np.empty(shards, np.int64)
        of[order] = bins[n + k]
        bins[a], bins[b] = of, of[::-1]
        bins[n + k] = None
    out = np.empty((n, shards), np.int64)
    for i in range(n):
        out[i, place[i]] = bins[i]
    return out


def _node(shards: int):
    """Difference the groups of a node (``digest, bytes``) together with the sums from above
    (``bin, bytes``): the bin of each group, and the new sums (without digest)."""
    def run(groups: pa.Table, above: pa.Table) -> pa.Table:
        n, node = groups.num_rows, (above if above.num_rows else groups).column("node")[0].as_py()
        sums = np.zeros((n + 1, shards), np.int64)
        sums[:n, 0] = groups.column("bytes").to_numpy()
        sums[n, above.column("bin").to_numpy()] = above.column("bytes").to_numpy()
        bins = difference(sums)
        of = np.argsort(bins[n])  # bins keep the names that they have above
        home, total = of[bins[:n, 0]], sums[n].copy()
        np.add.at(total, home, sums[:n, 0])
        return pa.table({"node": pa.array(np.full(n + shards, node)),
                         "digest": pa.chunked_array([*groups.column("digest").chunks, pa.nulls(shards, pa.binary())], pa.binary()),
                         "bin": pa.array(np.concatenate([home, np.arange(shards)])),
                         "bytes": pa.array(np.concatenate([sums[:n, 0], total]))})
    return run


def _homes(spark: SparkSession, groups: DataFrame, shards: int) -> DataFrame:
    """``digest, shard`` of ``groups`` (``digest, bytes``, a written table)."""
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    width = [max(1, -(-n // LOT))]  # nodes by level, from the lots up to one
    while width[0] > 1:
        width.insert(0, -(-width[0] // FAN))
    lots = groups.withColumn("lot", F.pmod(F.xxhash64("digest"), F.lit(width[-1])))
    above = spark.createDataFrame([(0, b, 0) for b in range(shards)], "node long, bin long, bytes long")
    found, upper = [], None
    for d, nodes in enumerate(width):
        below = width[d + 1] if d + 1 < len(width) else None
        own = F.lit(True) if below is None else F.col("bytes") * (below * shards * SMALL) > total
        here = lots.where(own if upper is None else own & ~upper)
        upper = own
        node = F.floor(F.col("lot") / FAN ** (len(width) - 1 - d)).alias("node")
        tasks = -(-nodes // 4)
        level = write_table(spark, here.select(node, "digest", "bytes").repartition(tasks, "node").groupBy("node").cogroup(
            above.repartition(tasks, "node").groupBy("node")).applyInArrow(
                _node(shards), "node long, digest binary, bin long, bytes long"), "level")
        found.append(level.where("digest is not null").select("digest", F.col("bin").cast("int").alias("shard")))
        if below:  # the sums are shared out among the children; the first ones have what is left over
            children = F.least(F.lit(FAN), F.lit(below) - F.col("node") * FAN)
            above = level.where("digest is null").withColumn("children", children).withColumn(
                "child", F.explode(F.expr("sequence(0L, children - 1)"))).select(
                (F.col("node") * FAN + F.col("child")).alias("node"), "bin",
                F.expr("bytes div children + if(child < bytes % children, 1, 0)").alias("bytes"))
    return reduce(DataFrame.union, found)


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size`` (UTF-8 bytes and 8), ``text_crc32, shard, slot`` of
    each row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    placed, file, row = row_position(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = write_table(spark, placed.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(file).alias("file"), F.col(row).alias("row"),
        (byte_length(text) + ROW_BYTES).alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("digest")), "sizes")
    groups = write_table(spark, rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    dealt = write_table(spark, rows.join(_homes(spark, groups, shards), "digest").drop("digest"), "dealt")
    return numbered(dealt, "shard", "file", "row", "slot").select("doc_id", "size", "text_crc32", "shard", "slot")
