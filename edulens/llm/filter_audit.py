"""Audit of how five document filters interact, from sorted posting lists.

Every row gets a number in a range of at most ``RANGE`` rows that one scan task
read together. For each part (language) and range the table of postings holds
the sorted numbers of the rows that fail each filter, and of those labelled good
and toxic. Unions of the lists of every set of filters, and what a filter's list
holds beyond such a union, are galloping merges within a range; their sizes add
up over the ranges, so a part of any size is spread over many tasks, and all
120 orders of the filters are read off the 80 sums of a part.

Filters (words are runs of bytes other than ASCII white space):
A under 100 words; B fewer than 80 distinct words in 100; C over 10 A-Z in 100
code points; D any of ``#$%&*|``; E the same text as a row with a smaller id.

Null texts are empty, null languages the empty part. A row with a null id fails
no E and makes none fail, and has no label; rows that repeat an id count each,
and several labels of an id hold if any does. An empty table has no parts.
Columns other than ``doc_id``, ``text``, ``lang`` are never read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8, write_table

FILTERS = "ABCDE"
LISTS = [*FILTERS, "good", "toxic"]
#: Rows whose postings are merged together.
RANGE = 1 << 16
#: Ids that a list moves on by at most in one round of a merge.
BLOCK = 1 << 10
#: A text of over one row in so many meets its rows by broadcast: there are fewer than this.
HOT = 1000

_CAPITALS = bytes(range(65, 91))
_MARKS = re.compile(rb"[#$%&*|]")
_CONTINUED = bytes(range(0x80, 0xC0))


def failed_by_itself(text: bytes) -> int:
    """Bits 0 to 3: whether the text fails A, B, C, D."""
    words = text.split()  # of bytes: at ASCII white space only
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1
            | (100 * capitals > 10 * points) << 2 | (_MARKS.search(text) is not None) << 3)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n = TaskContext.get().partitionId(), 0
    for batch in slices(batches):
        texts = list(utf8(batch.column(1)))
        number = np.arange(n, n + len(texts))
        n += len(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), pa.array((task << 32) + number // RANGE), pa.array(number % RANGE, pa.int32()), batch.column(0),
             pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary()), pa.array([failed_by_itself(t) for t in texts], pa.int32())],
            ["part", "range", "id", "doc_id", "digest", "lists"])


def postings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, range, n_rows`` and a sorted array of row numbers for each of
    ``LISTS``, as a written table."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    rows = write_table(spark, texts.mapInArrow(_scanned, "part string, range long, id int, doc_id long, digest binary, lists int"), "scanned")
    # one row a text, summed before the shuffle; only texts that stand under several ids meet their rows again
    firsts = write_table(spark, rows.where("doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last"), "firsts")
    bit = {name: 1 << i for i, name in enumerate(LISTS)}
    place = ["part", "range", "id"]
    often = F.col("n") * HOT > rows.count()
    hot = firsts.where(often).select("digest", F.col("first").alias("hot_first"))  # under HOT rows
    met = rows.select(*place, "doc_id", "digest").join(F.broadcast(hot), "digest", "left")
    copies = (met.where("doc_id > hot_first").select(*place)
              .union(met.where("hot_first is null").join(firsts.where(~often), "digest").where("doc_id > first").select(*place))
              .withColumn("lists", F.lit(bit["E"])))
    holds = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null and (quality = 1 or toxic = 1)")
             .groupBy("doc_id").agg((holds("quality") * bit["good"] + holds("toxic") * bit["toxic"]).alias("marks")))
    labelled = rows.join(known, "doc_id").select(*place, F.col("marks").alias("lists"))
    found = (rows.select(*place, "lists", F.lit(1).alias("row"))
             .union(copies.union(labelled).withColumn("row", F.lit(0))))
    ids = [F.sort_array(F.collect_list(F.when(F.col("lists").bitwiseAND(bit[name]) != 0, F.col("id")))).alias(name) for name in LISTS]
    return write_table(spark, found.groupBy("part", "range").agg(F.sum("row").alias("n_rows"), *ids), "postings")


def gallop(ids: np.ndarray, at: int, bound: int) -> int:
    """The first place from ``at`` on with an id of at least ``bound``: steps double, then the last one is bisected."""
    step = 1
    while at + step < len(ids) and ids[at + step] < bound:
        at += step
        step *= 2
    return at + int(np.searchsorted(ids[at : at + step + 1], bound))


def union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """Sorted distinct ids of all sorted lists. In each round every list gallops
    to the same id, the least that is ``BLOCK`` places ahead in any list."""
    lists = [x for x in lists if len(x)]
    if len(lists) < 2:
        return lists[0] if lists else np.empty(0, np.int32)
    at, out = [0] * len(lists), []
    while live := [k for k, x in enumerate(lists) if at[k] < len(x)]:
        if len(live) == 1:
            out.append(lists[live[0]][at[live[0]] :])
            break
        bound = min(int(lists[k][min(at[k] + BLOCK, len(lists[k])) - 1]) for k in live) + 1
        runs = []
        for k in live:
            to = gallop(lists[k], at[k], bound)
            if to > at[k]:
                runs.append(lists[k][at[k] : to])
            at[k] = to
        out.append(runs[0] if len(runs) == 1 else np.unique(np.concatenate(runs)))
    return np.concatenate(out)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The ids of sorted ``a`` that sorted ``b`` has not: ``b`` gallops along the blocks of ``a``."""
    out, at = [a[:0]], 0
    for k in range(0, len(a), BLOCK):
        block = a[k : k + BLOCK]
        at = gallop(b, at, int(block[0])) if at < len(b) else at
        to = gallop(b, at, int(block[-1]) + 1) if at < len(b) else at
        near = b[at:to]
        if len(near):
            place = np.searchsorted(near, block)
            block = block[near[np.minimum(place, len(near) - 1)] != block]
            at = to
        out.append(block)
    return np.concatenate(out)


def _sizes(n_rows: int, lists: dict[str, np.ndarray]) -> Iterator[tuple[int, ...]]:
    """For each filter and set of filters before it: what is kept, removed, and removed of the labelled rows."""
    fails = [lists[name] for name in FILTERS]
    unions = [union([fails[f] for f in range(len(FILTERS)) if s >> f & 1]) for s in range(1 << len(FILTERS))]
    for f, s in itertools.product(range(len(FILTERS)), range(1 << len(FILTERS))):
        if not s >> f & 1:
            gone = difference(fails[f], unions[s])
            lost = [len(gone) - len(difference(gone, lists[name])) for name in ("good", "toxic")]
            yield f, s, n_rows - len(unions[s | 1 << f]), len(gone), *lost


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4]
    for batch in batches:
        for k in range(batch.num_rows):
            lists = {name: np.asarray(batch.column(3 + i)[k].values.to_numpy(zero_copy_only=False), np.int32) for i, name in enumerate(LISTS)}
            part = batch.column(0)[k].as_py()
            found = [(part, *x) for x in _sizes(batch.column(2)[k].as_py(), lists)]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)],
                                             ["part", "filter", "before", "kept", "removed", "good_lost", "toxic_lost"])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley`` of each part, order and step."""
    spark, n = docs.sparkSession, len(FILTERS)
    sizes = (postings(docs, labels).select("part", "range", "n_rows", *LISTS)
             .mapInArrow(_audited, "part string, filter int, before int, kept long, removed long, good_lost long, toxic_lost long")
             .groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in ("kept", "removed", "good_lost", "toxic_lost")]))
    sizes = write_table(spark, sizes, "sizes")
    # a set of k filters stands before a filter in k! (n - 1 - k)! orders
    times = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), F.bit_count("before") + 1)
    others = F.expr(f"{(1 << n) - 1} - shiftleft(1, filter)")
    totals = sizes.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") == others, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * times).alias("shapley"))
    steps = [("".join(FILTERS[f] for f in order), k + 1, f, sum(1 << g for g in order[:k]))
             for order in itertools.permutations(range(n)) for k, f in enumerate(order)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, filter int, before int")  # 600 rows
    return (sizes.join(totals, ["part", "filter"]).join(F.broadcast(orders), ["filter", "before"])
            .select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
                    "unique_fails", "good_lost", "toxic_lost", "shapley"))


def oracle_sql() -> str:
    """The audit in DuckDB SQL, from counts by the set of filters that a row fails."""
    bits = " + ".join(f"CASE WHEN coalesce({name}, false) THEN {1 << i} ELSE 0 END" for i, name in enumerate(FILTERS.lower()))
    return f"""
WITH texts AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
tests AS (
  SELECT part, doc_id, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY body) AS e
  FROM texts),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
counted AS (
  SELECT part, {bits} AS fails, count(*) AS n, sum(coalesce(good, 0)) AS n_good, sum(coalesce(bad, 0)) AS n_bad
  FROM tests LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letter(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS filter_order
  FROM letter p JOIN letter q ON q.l <> p.l JOIN letter r ON r.l NOT IN (p.l, q.l) JOIN letter s ON s.l NOT IN (p.l, q.l, r.l)
  JOIN letter t ON t.l NOT IN (p.l, q.l, r.l, s.l)),
steps AS (
  SELECT filter_order, step, l, bit,
         (SELECT coalesce(sum(x.bit), 0) FROM letter x WHERE position(x.l IN filter_order) < step) AS before
  FROM orders JOIN letter ON true, LATERAL (SELECT position(l IN filter_order) AS step)),
applied AS (
  SELECT part, filter_order, step, l,
         sum(CASE WHEN fails & (before::INT | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & bit > 0 AND fails & before::INT = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & bit > 0 AND fails & before::INT > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & bit > 0 AND fails & before::INT = 0 THEN n_good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & bit > 0 AND fails & before::INT = 0 THEN n_bad ELSE 0 END) AS toxic_lost
  FROM counted JOIN steps ON true GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM applied
"""
