"""Prefix trie of conversations, from sorted neighbours.

A turn is a key (a digest of role and text) and the length of its text. The
turns of a conversation are cut into segments of ``SEGMENT``; a round deals with
one segment of all conversations that still share their beginning with another:

1. equal segments under one anchor (the prefix before the segment) are counted
   as one class, partially before the shuffle, so copies never meet in a task;
2. the classes are sorted over all tasks. In a block of at most ``BLOCK`` sorted
   classes the common prefix with the neighbour is an edge; edges are joined by
   union-find in descending depth, and every merge makes or grows a branching
   node. This is the forest of the block;
3. nodes that no later or earlier block can touch are final. Those on the paths
   of the block's first and last class are contracted to one record a node, and
   records of all blocks merge by the node's key (a digest of its prefix); what
   such a node adds to its ancestors in the segment is summed up by their keys.

A conversation that shares a whole segment with no other is a chain from there,
read off its turns without another round; rounds end with the longest prefix
that two conversations share. Nodes of a later round hang under the class that
is their anchor, so rounds are merged from the last to the first.

Digests have 128 bits. Null roles and texts are empty. Turns are numbered by
``turn``, null first, then key: equal turns of one place are in any order alike.
Rows without ``conv_id`` belong to no conversation and are ignored; an empty
table has no nodes. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import BEFORE, prefix_weights
from .common import write_table

#: Turns of a segment, and hex digits of a digest.
SEGMENT, DIGITS = 32, 32
#: Sorted classes whose forest is built together.
BLOCK = 1 << 14
#: Turns of the shared beginning, below, and conversations that share one.
SHARED, FAMILY = 6, 100

NODE = "conv_id long, depth long, parent_conv_id long, parent_key string, n_convs long, n_children long, n_leaves long, saved_tokens long, end_key string"
EDGE = "key string, depth long, above array<string>, parent_conv_id long, n_convs long, least long, n_children long, n_leaves long, saved_tokens long, points long, end_key string"


def digest(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, DIGITS)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:DIGITS]


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 0), ``key, points`` of each turn of the table
    (``conv_id``, ``turn``, ``role``, ``text``). Repeated rows are counted, then
    numbered together, and a long conversation is numbered in slices."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("key"), F.length(text).cast("long").alias("points"))
            .groupBy("conv_id", "turn", "key", "points").agg(F.count(F.lit(1)).alias("copies")))
    rows = write_table(conversations.sparkSession, rows, "turns")
    return (prefix_weights(rows, ["turn", "key"], ["conv_id"], "copies")
            .select("conv_id", F.explode(F.sequence(F.col(BEFORE), F.col(BEFORE) + F.col("copies") - 1)).alias("place"), "key", "points"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family of ``FAMILY`` ids:
    the first h turns of that one, h the crc32 of the id modulo ``SHARED``, then
    the own turns after the first h. Returns ``conv_id, n_turns`` of every
    conversation and ``conv_id, depth`` (from 1), ``key, points`` of its turns."""
    spark = conversations.sparkSession
    turns = write_table(spark, turns_of(conversations), "places")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = (turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED - 1)).groupBy(F.col("conv_id").alias("first"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "key", "points"))).alias("head")))  # at most SHARED - 1 turns
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")).select("conv_id", "n_own", first.alias("first"), h.alias("h"))
    own = (own.join(heads, "first", "left")
           .withColumn("head", F.coalesce(F.slice("head", 1, F.col("h")), F.array())).withColumn("n_head", F.size("head")))
    own = write_table(spark, own.withColumn("n_turns", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))), "families")
    shared = own.select("conv_id", F.posexplode("head").alias("at", "t")).select(
        "conv_id", (F.col("at") + 1).cast("long").alias("depth"), "t.key", "t.points")
    rest = turns.where(F.col("place") >= h).join(own.select("conv_id", "h", "n_head"), "conv_id").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("n_head") + 1).cast("long").alias("depth"), "key", "points")
    return own.select("conv_id", "n_turns"), write_table(spark, shared.union(rest), "rebuilt")


class Forest:
    """The trie of a block of sorted classes, and what of it can still grow."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        m = len(rows)
        self.depth = [len(r["keys"]) // DIGITS for r in rows]
        self.parent = [-1] * m
        self.row = list(range(m))  # a class below each node, whose keys its prefix is of
        edges = []
        for i in range(1, m):
            if rows[i]["anchor"] == rows[i - 1]["anchor"] and (depth := _common(rows[i - 1]["keys"], rows[i]["keys"])):
                edges.append((-depth, i))
        top, group = list(range(m)), list(range(m))

        def find(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        for depth, i in sorted(edges):  # the deepest first, from the left: what is right of an edge still lies deeper
            a, b = find(i - 1), find(i)
            node = top[a]
            if self.depth[node] != -depth:
                node = len(self.depth)
                self.depth.append(-depth)
                self.parent.append(-1)
                self.row.append(i)
                self.parent[top[a]] = node
            self.parent[top[b]] = node
            group[b] = a
            top[a] = node
        n = len(self.depth)
        self.order = sorted(range(n), key=lambda v: -self.depth[v])
        self.open = [False] * n  # on the path of the first or last class
        for v in {0, m - 1}:
            while v >= 0:
                self.open[v] = True
                v = self.parent[v]
        of = [rows[v] if v < m else None for v in range(n)]
        self.n = [r["n"] if r else 0 for r in of]
        self.least = [r["least"] if r else None for r in of]
        self.kids = [r["more_children"] if r else 0 for r in of]  # closed ones only
        self.leaves = [r["more_leaves"] if r else 0 for r in of]
        self.saved = [r["more_saved"] if r else 0 for r in of]

    def points(self, v: int, depth: int) -> int:
        return self.rows[self.row[v]]["points"][depth - 1]

    def key(self, v: int, depth: int) -> str:
        r = self.rows[self.row[v]]
        return _digest(r["anchor"] + r["keys"][: DIGITS * depth]) if depth else r["anchor"]

    def end(self, v: int, depth: int) -> str | None:
        return self.key(v, depth) if v < len(self.rows) and depth == self.depth[v] and self.rows[v]["n_ends"] else None

    def build(self, start: int) -> tuple[list[tuple], list[tuple]]:
        """Final nodes, and records of nodes that other blocks may share."""
        nodes, edges, anchors = [], [], {}
        for v in self.order:
            p, depth = self.parent[v], self.depth[v]
            above = self.depth[p] if p >= 0 else 0
            r = self.rows[self.row[v]]
            if not self.open[v] and not self.kids[v]:
                self.leaves[v] = 1
            for d in range(depth, above, -1):
                n, kids = self.n[v], self.kids[v] if d == depth else 1
                if self.open[v]:
                    own = (kids, self.leaves[v], self.saved[v]) if d == depth else (0, 0, 0)
                    edges.append((self.key(v, d), start + d, [self.key(v, k) for k in range(d - 1, -1, -1)], r["parent_conv_id"] if d == 1 else None,
                                  n, self.least[v], *own, self.points(v, d), self.end(v, d)))
                else:
                    self.saved[v] += (n - 1) * self.points(v, d)
                    parent, key, closed = self.least[v], None, -1
                    if d == above + 1:
                        if p < 0:
                            parent = r["parent_conv_id"]
                        elif self.open[p]:
                            parent, key = None, self.key(p, above)
                        else:
                            closed = p
                    nodes.append([self.least[v], start + d, parent, key, n, kids, self.leaves[v], self.saved[v], self.end(v, d), closed])
            if p >= 0:
                self.n[p] += self.n[v]
                self.least[p] = self.least[v] if self.least[p] is None else min(self.least[p], self.least[v])
            if not self.open[v]:
                if p >= 0:
                    self.kids[p] += 1
                    self.leaves[p] += self.leaves[v]
                    self.saved[p] += self.saved[v]
                else:
                    a = anchors.setdefault(r["anchor"], [0, 0, 0])
                    a[0] += 1
                    a[1] += self.leaves[v]
                    a[2] += self.saved[v]
        edges += [(key, start, [], None, 0, None, *a, 0, None) for key, a in anchors.items()]
        for x in nodes:  # a closed parent's smallest member is known once all its children are
            if (p := x.pop()) >= 0:
                x[2] = self.least[p]
        return nodes, edges


def _common(a: str, b: str) -> int:
    """Turns that two strings of keys share at their beginning."""
    low, high = 0, min(len(a), len(b)) // DIGITS
    while low < high:
        mid = (low + high + 1) // 2
        if a[: mid * DIGITS] == b[: mid * DIGITS]:
            low = mid
        else:
            high = mid - 1
    return low


_FIELDS = ["anchor", "parent_conv_id", "keys", "points", "n", "n_ends", "least", "more_children", "more_leaves", "more_saved"]


def _forests(start: int):
    """Forests of blocks of sorted classes: rows with ``node`` or ``edge``."""
    kinds = pa.schema([pa.field("node", pa.struct(_arrow(NODE))), pa.field("edge", pa.struct(_arrow(EDGE)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def built(rows: list[dict]) -> pa.RecordBatch:
            nodes, edges = Forest(rows).build(start)
            names, parts = [f.name for f in kinds.field("node").type], [f.name for f in kinds.field("edge").type]
            return pa.RecordBatch.from_pylist(
                [{"node": dict(zip(names, x, strict=True)), "edge": None} for x in nodes]
                + [{"node": None, "edge": dict(zip(parts, x, strict=True))} for x in edges], schema=kinds)

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= BLOCK:
                yield built(held[:BLOCK])
                held = held[BLOCK:]
        if held:
            yield built(held)
    return run


def _arrow(ddl: str) -> list[pa.Field]:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    return [pa.field(name, kinds[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))]


def _merged(spark: SparkSession, found: DataFrame, start: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of a segment, and children, leaves and saved tokens below each anchor."""
    edges = found.where("edge is not null").select("edge.*")
    edges = write_table(spark, edges.groupBy("key").agg(
        F.max("depth").alias("depth"), F.max("above").alias("above"), F.max("parent_conv_id").alias("parent_conv_id"),
        F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("points").alias("points"),
        F.max("end_key").alias("end_key")), "contracted")
    children = edges.where(F.size("above") > 0).groupBy(F.col("above")[0].alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    counted = edges.join(children, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0)))
    adds = counted.withColumn("n_leaves", F.when((F.col("n_children") == 0) & (F.col("depth") > start), 1).otherwise(F.col("n_leaves"))).withColumn(
        "saved_tokens", F.col("saved_tokens") + F.greatest(F.col("n_convs") - 1, F.lit(0)) * F.col("points"))
    below = (adds.select(F.explode(F.concat(F.array("key"), "above")).alias("key"), "n_leaves", "saved_tokens")
             .groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    # an anchor below which all tops are open has no record of its own
    anchors = (below.join(children, "key", "left").join(edges.where(F.col("depth") == start).select("key", "n_children"), "key", "left")
               .withColumn("more_children", F.coalesce("open_children", F.lit(0)) + F.coalesce("n_children", F.lit(0))))
    tops = counted.where(F.col("depth") > start)
    whole = write_table(spark, tops.drop("n_leaves", "saved_tokens").join(below, "key"), "open_nodes")
    known = whole.select(F.col("key").alias("parent_key"), F.col("least").alias("parent_least"))
    last = ["n_convs", "n_children", "n_leaves", "saved_tokens", "end_key"]
    nodes = (found.where("node is not null").select("node.*")
             .unionByName(whole.select(F.col("least").alias("conv_id"), "depth", "parent_conv_id",
                                       F.when(F.col("depth") > start + 1, F.col("above")[0]).alias("parent_key"), *last)))
    routed = nodes.where("parent_key is not null").join(known, "parent_key").withColumn("parent_conv_id", F.col("parent_least"))
    columns = ["conv_id", "depth", "parent_conv_id", *last]
    nodes = nodes.where("parent_key is null").select(*columns).unionByName(routed.select(*columns))
    inside = anchors.join(tops.select("key"), "key", "left_anti").select(
        "key", "more_children", F.col("n_leaves").alias("more_leaves"), F.col("saved_tokens").alias("more_saved"))
    return nodes, inside


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each key, from rows sorted by key and id, a few rows held at a time."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(str(c).encode())
            else:
                state.update(f",{c}".encode())
        yield _pairs(done)
    if state is not None:
        yield _pairs([(key, state.hexdigest())])


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["end_key", "ends_sha256"])


def prefix_trie(spark: SparkSession, convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every node of the trie of the conversations ``convs`` (``conv_id``,
    ``n_turns``) with ``turns`` (``conv_id``, ``depth`` from 1, ``key``, ``points``):
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    top = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    if not top["n"]:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    pieces = write_table(spark, turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / SEGMENT).alias("segment"))
                         .agg(F.sort_array(F.collect_list(F.struct("depth", "key", "points"))).alias("t"))  # at most SEGMENT turns
                         .select("conv_id", "segment", F.array_join("t.key", "").alias("keys"), F.col("t.points").alias("points")), "segments")
    active = convs.where("n_turns > 0").select("conv_id", "n_turns", F.lit("").alias("anchor"), F.lit(top["least"]).alias("parent_conv_id"))
    ends = convs.where("n_turns = 0").select(F.lit("").alias("end_key"), "conv_id")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds, tails = [], None
    while not rounds or not active.isEmpty():
        at = len(rounds)
        last = SEGMENT * (at + 1)
        members = write_table(spark, active.join(pieces.where(F.col("segment") == at).drop("segment"), "conv_id")
                              .withColumn("key", digest(F.concat("anchor", "keys"))), "members")
        over = F.col("n_turns") <= last
        classes = write_table(spark, members.groupBy("key", "anchor", "parent_conv_id", "keys").agg(
            F.min("points").alias("points"), F.count(F.lit(1)).alias("n"), F.sum(over.cast("long")).alias("n_ends"),
            F.min("conv_id").alias("least"), F.min(F.when(~over, F.col("conv_id"))).alias("goes_on")), "classes")
        rounds.append(classes)
        ends = ends.unionByName(members.where(over).select(F.col("key").alias("end_key"), "conv_id"))
        open_ = classes.where("n > n_ends").select("key", "least", "goes_on", (F.col("n") - F.col("n_ends")).alias("n_open"))
        lone = open_.where("n_open = 1").select(F.col("goes_on").alias("conv_id"), "least", F.lit(last).alias("from"))
        tails = lone if tails is None else tails.unionByName(lone)
        active = write_table(spark, members.where(~over).join(open_.where("n_open > 1").select("key", "least"), "key")
                             .select("conv_id", "n_turns", F.col("key").alias("anchor"), F.col("least").alias("parent_conv_id")), "active")
    nodes = below = None
    for at in reversed(range(len(rounds))):
        goes_on = F.col("n") - F.col("n_ends")
        classes = rounds[at]
        more = ["more_children", "more_leaves", "more_saved"]
        if below is not None:
            classes = classes.join(below, "key", "left")
        alone = F.when(goes_on == 1, 1).otherwise(0)
        for c in more:
            classes = classes.withColumn(c, F.when(goes_on > 1, F.col(c) if below is not None else 0)
                                         .otherwise(alone if c != "more_saved" else 0).cast("long"))
        found = write_table(spark, classes.select(*_FIELDS).repartitionByRange(width, "anchor", "keys").sortWithinPartitions("anchor", "keys")
                            .mapInArrow(_forests(SEGMENT * at), f"node struct<{_ddl(NODE)}>, edge struct<{_ddl(EDGE)}>"), "forest")
        these, below = _merged(spark, found, SEGMENT * at)
        below = write_table(spark, below, "below")
        nodes = these if nodes is None else nodes.unionByName(these)
    root = below.where(F.col("key") == "").first()  # one row
    nodes = nodes.unionByName(spark.createDataFrame(
        [(top["least"], 0, None, top["n"], root["more_children"] if root else 0, root["more_leaves"] if root else 1,
          root["more_saved"] if root else 0, "")], nodes.schema))
    # the rest of a conversation that shares nothing any more
    tail = turns.where(F.col("depth") > SEGMENT).join(tails, "conv_id").where(F.col("depth") > F.col("from")).join(convs, "conv_id").select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("from") + 1, F.col("least")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), F.when(F.col("depth") < F.col("n_turns"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") < F.col("n_turns"), F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).alias("ends_sha256"))
    # one digest needs its ids in order, so those that end alike are streamed through one task
    hashes = ends.repartition(width, "end_key").sortWithinPartitions("end_key", "conv_id").mapInArrow(_hashed, "end_key string, ends_sha256 string")
    nodes = write_table(spark, nodes, "nodes")
    none = nodes.where("end_key is null").drop("end_key").withColumn("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    some = nodes.where("end_key is not null").join(hashes, "end_key", "left").drop("end_key").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return none.unionByName(some).unionByName(tail)


def _ddl(fields: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (f.split(" ") for f in fields.split(", ")))
