"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

A source's rows are cut in blocks. Block j (from 1) of a source that has c of H
blocks of a period is released at slot ``floor((j - 1) H / c)`` and due by slot
``ceil(j H / c)``. In each slot, of the released blocks the one with the
earliest deadline goes next (ties: the first source by name). All blocks meet
their deadlines then, so that at any slot, until a source runs out, each source
is less than one block away from its weight.

The schedule repeats after H slots, so one period is computed, with a fold
over an array, and block j takes the slot of its place in the period: the work
on the rows is counting. When a source has run out its slots stay empty, and
the others go on in the same proportions; no row is dropped or repeated.

Weights that are whole numbers of a sum of at most ``MAX_PERIOD`` are the blocks
of a period. Others are apportioned by largest remainders, at least one block
each, to as many slots as a fold of ``FOLD_STEPS`` serves (``MAX_PERIOD`` at
most); the bound above is to the weights so apportioned.

A fold over all sources would grow with their square, so above ``2 * FAN``
sources, the light ones (less than 1 / ``FAN`` of all weight) are dealt to
bundles by a hash, ``FAN`` to a bundle on average. A bundle is scheduled as a
source of their common weight, and its slots are dealt to its sources in the
same way; bundles of many bundles are bundled again. Any number of sources has
a schedule then, and each fold is over a bounded array in a row of its own. A
source that is in no bundle is less than one block away from its weight; one in
bundles, less than one block and, for each, its share of the bundle's weight.

Rows of a source are counted in chunks of a file, so a source with a third of
all rows is spread over many tasks. Schedules are tables with one row for each
source, which Spark broadcasts only where their files are small.

A null source is a source of its own, and comes first. Null ids and texts and
repeated rows are rows like others. Extra columns are ignored. Weights that are
null or not positive are none. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, numbered, row_position, write_table

BLOCK_ROWS = 16
#: Sources of a bundle, on average.
FAN = 64
#: Slots of a period, at most, and slots times sources.
MAX_PERIOD = 8192
FOLD_STEPS = 1 << 18


def tempered_weights(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """The weight of each source (``source, blocks``): a power of its rows."""
    return docs.groupBy("source").agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("blocks"))


def _key(source: Column) -> Column:
    """A text that is never null and keeps the order of sources."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source.cast("string")))


def _apportioned(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``bundle, node, weight``) with whole ``blocks`` of a period of their bundle."""
    of = Window.partitionBy("bundle")
    weight, total, members = F.col("weight"), F.sum("weight").over(of), F.count(F.lit(1)).over(of)
    whole = (F.max(weight - F.floor(weight)).over(of) == 0) & (total <= MAX_PERIOD)
    slots = F.greatest(members, F.least(F.lit(MAX_PERIOD), F.floor(FOLD_STEPS / members)))
    shared = nodes.withColumn("share", F.when(whole, weight).otherwise(weight / total * slots)).withColumn(
        "blocks", F.greatest(F.lit(1), F.floor("share")).cast("long"))
    left = F.round(F.sum("share").over(of)) - F.sum("blocks").over(of)
    by_remainder = F.row_number().over(of.orderBy((F.col("share") - F.floor("share")).desc(), "node"))
    return (shared.withColumn("more", F.when(by_remainder <= left, 1).otherwise(0))
            .withColumn("blocks", F.col("blocks") + F.col("more")).drop("share", "more"))


def _periods(nodes: DataFrame, tasks: int = 1) -> DataFrame:
    """``bundle, period, node, blocks, slots`` of each of ``nodes`` (``bundle,
    node, blocks``): the slots in which its blocks run in a period of its bundle."""
    listed = nodes.repartition(tasks, "bundle").groupBy("bundle").agg(
        F.sort_array(F.collect_list(F.struct("node", F.col("blocks").cast("long").alias("blocks")))).alias("s"))
    sized = listed.withColumn("period", F.expr("aggregate(s, 0L, (t, x) -> t + x.blocks)"))
    # a step of the fold: the released block with the earliest deadline; done counts blocks by node
    ran = F.expr("""aggregate(sequence(0L, period - 1),
        struct(transform(s, x -> 0L) as done, cast(array() as array<int>) as ran),
        (state, t) -> transform(
            array(array_min(transform(s, (x, i) -> struct(
                if(state.done[i] < x.blocks and floor(state.done[i] * period / x.blocks) <= t,
                   ceil((state.done[i] + 1) * period / x.blocks), period * 2) as due, i as i))).i),
            p -> struct(transform(state.done, (d, i) -> if(i = p, d + 1, d)) as done, concat(state.ran, array(p)) as ran))[0],
        state -> state.ran)""")
    slots = sized.select("bundle", "s", "period", F.posexplode(ran).alias("slot", "i"))
    return slots.groupBy("bundle", "period", F.expr("s[i].node").alias("node"), F.expr("s[i].blocks").alias("blocks")).agg(
        F.sort_array(F.collect_list("slot")).alias("slots"))


def one_period(weights: DataFrame) -> DataFrame:
    """The slots of one period of ``weights`` (``source, blocks``), all in one
    bundle: ``source, blocks, period, place`` (of the block among those of its
    source) and ``slot``."""
    nodes = weights.select(F.lit("").alias("bundle"), _key(F.col("source")).alias("node"), "blocks")
    return _periods(nodes).select(
        F.when(F.col("node") != "0", F.substring("node", 2, 1 << 30)).alias("source"), "blocks", "period",
        F.posexplode("slots").alias("place", "slot"))


def schedule(weights: DataFrame) -> list[DataFrame]:
    """The schedule of ``weights`` (``source, blocks``) as tables of
    ``bundle, period, node, blocks, slots``: sources in bundles first, last the nodes of the whole."""
    spark, levels = weights.sparkSession, []
    nodes = weights.where("blocks > 0").groupBy(_key(F.col("source")).alias("node")).agg(F.sum(F.col("blocks").cast("double")).alias("weight"))
    while True:
        nodes = write_table(spark, nodes, "weights")
        n, total = nodes.agg(F.count(F.lit(1)), F.sum("weight")).first()
        bundles = 1 if n <= 2 * FAN else -(-n // FAN)
        dealt = F.when(F.col("weight") * FAN >= F.lit(total), F.concat(F.lit("="), "node")).otherwise(
            F.pmod(F.xxhash64("node", F.lit(len(levels))), F.lit(bundles)).cast("string"))
        bundled = nodes.withColumn("bundle", F.lit("") if bundles == 1 else dealt)
        levels.append(write_table(spark, _periods(_apportioned(bundled), -(-bundles // 8)), "period"))
        if bundles == 1:
            return levels
        nodes = bundled.groupBy(F.col("bundle").alias("node")).agg(F.sum("weight").alias("weight"))


def mix(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The place of each row of ``docs`` (``doc_id``, ``source``) in the mix:
    ``doc_id, source, number`` (in its source), ``block`` (from 1), ``release,
    deadline, slot``, and ``file, row`` that place it in the input. Sorted by
    ``slot, number`` the rows are in mixed order. ``weights`` has ``source,
    blocks`` (positive numbers, in proportion); by default they follow the square root of the
    source's rows. Rows of sources without a weight come with null slots."""
    return _mixed(*row_position(docs), weights, block_rows)


def _mixed(placed: DataFrame, file: str, row: str, weights: DataFrame | None, block_rows: int) -> DataFrame:
    rows = placed.select(F.col("doc_id"), F.col("source"), F.col(file).alias("file"), F.col(row).alias("row"),
                         _key(F.col("source")).alias("node"))
    levels = schedule(tempered_weights(rows) if weights is None else weights)
    blocked = numbered(rows, "node", "file", "row", "number").withColumn("block", F.floor(F.col("number") / block_rows) + 1)
    # a block's slot among those of its bundle is the bundle's block before (from 0), up to the whole
    kept = [c for c in blocked.columns if c != "node"]
    out = blocked.withColumn("slot", F.col("block") - 1).withColumn("gap", F.lit(1.0))
    for level in levels:
        out = out.join(level, "node", "left").select(
            *kept, F.col("bundle").alias("node"), (F.col("gap") * F.col("period") / F.col("blocks")).alias("gap"),
            F.expr("slot div blocks * period + slots[cast(slot % blocks as int)]").alias("slot"))
    return out.select("doc_id", "source", "number", "block", F.floor((F.col("block") - 1) * F.col("gap")).alias("release"),
                      F.ceil(F.col("block") * F.col("gap")).alias("deadline"), "slot", "file", "row")


def in_mixed_order(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with all columns, its rows in mixed order: partitions hold
    successive slots, and rows are sorted in them (sources without a weight last)."""
    placed, file, row = row_position(docs)
    slot, number = free_name(placed, "__slot"), free_name(placed, "__number")
    place = write_table(docs.sparkSession, _mixed(placed, file, row, weights, block_rows).select(
        F.col("file").alias(file), F.col("row").alias(row), F.coalesce("slot", F.lit((1 << 63) - 1)).alias(slot),
        F.col("number").alias(number)), "mixed")
    order = [slot, number, file, row]
    return placed.join(place.hint("merge"), [file, row]).repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
