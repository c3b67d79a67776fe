"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes
log-count ratios.

Texts are lowered; the distinct runs of 3, 4 and 5 characters are hashed to
``DIMENSIONS`` features. Over all labelled rows that are not held out, Spark
counts in how many toxic and clean texts each feature occurs. The log ratio r of
the smoothed counts scales a present feature. A logistic regression on the
scaled features is fitted on the driver, on at most ``FIT_ROWS`` rows of each
class (those with the smallest hash of their id), and its constant is moved to
the share of toxic rows among all labelled ones. Labels, language, source and id
never enter a score.

Rows whose ``crc32`` of the id as text is 0 modulo 5 are held out; a null id
counts as the empty text. Several labels of one id count as their maximum; null
labels as none. Repeated documents count each. Null and empty texts have no
features and get the constant's score. Without rows of both classes, all texts
get the smoothed share of toxic rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RowsByFile, row_position, slices, utf8, write_by_file, write_table
from .words import U, mixed

SIZES = (3, 4, 5)
DIMENSIONS = 1 << 18
FIT_ROWS = 1000
FOLDS = 5
#: Features in fewer labelled texts have no weight.
MIN_TEXTS = 5
RANGES = 16
#: Parts of a range that are added together, at most.
FAN = 64
STEPS, PENALTY = 60, 1e-2

_KEYS = mixed(np.arange(max(SIZES), dtype=U) + U(1 << 61)) | U(1)


class _Distinct:
    """The distinct features of a text, found without a sort: the last place that wrote a slot keeps it."""

    def __init__(self):
        self.slot = np.zeros(DIMENSIONS, np.int64)

    def __call__(self, text: bytes) -> np.ndarray:
        points = np.frombuffer(text.decode().lower().encode("utf-32-le"), "<u4").astype(U)
        total, found = np.zeros(len(points), U), []
        for j in range(max(SIZES)):
            n = len(points) - j
            if n <= 0:
                break
            total = total[:n] + points[j:] * _KEYS[j]
            if j + 1 in SIZES:
                found.append((mixed(total + U(j)) & U(DIMENSIONS - 1)).astype(np.int64))
        if not found:
            return np.empty(0, np.int64)
        features = np.concatenate(found)
        places = np.arange(len(features))
        self.slot[features] = places
        return features[self.slot[features] == places]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def _counted(labelled: RowsByFile, fit: set[tuple[str, int]]):
    """Of each task: packed counts by range of features, and the features of rows to fit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, distinct, seen, rows = np.zeros((2, DIMENSIONS), np.int64), _Distinct(), 0, []
        for batch in slices(batches):
            at, toxic = labelled.among(batch.column(0), batch.column(1))
            files, numbers = batch.column(0), batch.column(1)
            for i, label, text in zip(at.tolist(), toxic.tolist(), utf8(batch.column(2).take(pa.array(at))), strict=True):
                features = distinct(text)
                counts[label, features] += 1
                seen += 1
                if (files[i].as_py(), numbers[i].as_py()) in fit:
                    rows.append((None, label, features.astype("<i4").tobytes()))
        if seen:
            width = DIMENSIONS // RANGES
            rows += [(r, None, counts[:, r * width : (r + 1) * width].astype("<i8").tobytes()) for r in range(RANGES)]
        kinds = [pa.int32(), pa.int32(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        part = pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32())
        yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), part],
                                         ["range", "label", "packed", "part"])
    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p, "<i8") for p in table.column("packed").to_pylist())
    return pa.table({"range": table.column("range")[:1], "packed": pa.array([total.astype("<i8").tobytes()], pa.binary()),
                     "part": table.column("part")[:1]})


def _levels(counts: DataFrame) -> DataFrame:
    """The sum of ``counts`` (``range, packed, part``) of each range. At most
    ``FAN`` parts are added in a task, level by level, however many there are."""
    last = counts.agg(F.max("part")).first()[0] or 0
    while True:
        counts = counts.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("range", "part").applyInArrow(
            _summed, "range int, packed binary, part int")
        last //= FAN
        if not last:
            return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of each feature from its (clean, toxic) counts."""
    shares = (counts + 1.0) / (counts + 1.0).sum(1, keepdims=True)
    return np.where(counts.sum(0) >= MIN_TEXTS, np.log(shares[1] / shares[0]), 0.0)


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on features scaled by ``ratios``, with an L2 penalty, by accelerated gradient steps; weights of the raw features, and the constant."""
    rows = [r[ratios[r] != 0] for r in rows]
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    place = np.zeros(len(ratios), np.int32)
    place[flat] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used))
    flat, scale = place[flat], ratios[used]
    x = scale[flat].astype(np.float32)
    # the step is set by the largest eigenvalue of the weighted product, from a few power steps
    v = np.ones(len(used) + 1)
    for _ in range(8):
        v /= np.linalg.norm(v)
        z = np.bincount(owner, x * v[flat], len(rows)) + v[-1]
        v = np.append(np.bincount(flat, x * z[owner], len(used)), z.sum())
    step = 1 / (0.25 * np.linalg.norm(v) / len(rows) + PENALTY)
    w = moved = np.zeros(len(used) + 1)
    for t in range(STEPS):
        z = np.bincount(owner, x * moved[flat], len(rows)) + moved[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels
        slope = np.append(np.bincount(flat, x * error[owner], len(used)) / len(rows) + PENALTY * moved[:-1], error.mean())
        new = moved - step * slope
        moved, w = new + t / (t + 3) * (new - w), new
    out = np.zeros(len(ratios))
    out[used] = w[:-1] * scale
    return out, float(w[-1])


def _scored(weights: np.ndarray, constant: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = _Distinct()
        for batch in slices(batches):
            z = np.array([constant + weights[distinct(t)].sum() for t in utf8(batch.column(2))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))), pa.float64())],
                                             ["doc_id", "held_out", "score"])
    return run


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights of the features and the constant, from ``docs`` (``doc_id``,
    ``text``) and ``labels`` (``doc_id``, ``toxic``) without the held-out rows."""
    spark = docs.sparkSession
    placed, file, row = row_position(docs)
    rows = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(file).alias("file"), F.col(row).alias("row"), "text")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("toxic is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("long").alias("value")))
    marked = write_table(spark, rows.select("doc_id", "file", "row").where(~held_out(F.col("doc_id"))).join(known, "doc_id"), "marked")
    sizes = {r["value"]: r["n"] for r in marked.groupBy("value").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    share = (toxic + 0.1) / (clean + toxic + 1)
    none = np.zeros(DIMENSIONS), float(np.log(share / (1 - share)))
    if not clean or not toxic:
        return none
    order = [F.xxhash64("doc_id"), F.col("file"), F.col("row")]
    fit = {(r["file"], r["row"]) for value in (0, 1) for r in marked.where(F.col("value") == value).orderBy(*order).limit(FIT_ROWS).collect()}
    labelled = write_by_file(spark, marked, "labelled")
    found = write_table(spark, rows.select("file", "row", "text").mapInArrow(_counted(labelled, fit), "range int, label int, packed binary, part int"), "counts")
    summed = _levels(found.where("range is not null").select("range", "packed", "part")).collect()
    counts = np.zeros((2, DIMENSIONS), np.int64)
    width = DIMENSIONS // RANGES
    for r in summed:
        counts[:, r["range"] * width : (r["range"] + 1) * width] = np.frombuffer(r["packed"], "<i8").reshape(2, width)
    sample = found.where("label is not null").select("label", "packed").collect()  # at most 2 * FIT_ROWS
    sample = sorted((r["label"], bytes(r["packed"])) for r in sample)
    labels_fit = np.array([s[0] for s in sample], float)
    weights, constant = fit_weights([np.frombuffer(s[1], "<i4") for s in sample], labels_fit, log_ratios(counts))
    odds = lambda a, b: np.log((a + 0.1) / (b + 0.1))
    return weights, float(constant + odds(toxic, clean) - odds(labels_fit.sum(), (1 - labels_fit).sum()))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    weights, constant = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), "text")
    return (rows.mapInArrow(_scored(weights.astype(np.float32), constant), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
