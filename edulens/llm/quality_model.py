"""Quality classifier: hashed word n-grams, logistic regression by
follow-the-regularised-leader, scores as sparse dot products.

Words are runs of bytes other than ASCII white space. A text's features are its
single words and pairs of neighbours, and the runs of one to three word shapes;
all are hashed to ``DIMENSIONS`` slots. A word's shape is its case, whether it
holds digits or marks, its last two bytes where these are no letters, and
whether it equals the word before. A slot weighs log(1 + its count); the weights
of words and of shapes are each scaled to length one.

The model learns from at most ``FIT_ROWS`` labelled rows of each class that are
not held out (the smallest hashes of id and position). They are written, read
back in order of a hash once an epoch, one partition at a time, and each makes
one update of FTRL-Proximal: every slot keeps its sum of squared slopes, so that
it has a learning rate of its own, and an L1 bound that keeps rare slots at
zero. The constant is then moved to the share of good rows among all labelled.

Rows whose ``crc32`` of the id as text is 1 modulo 3 are held out; a null id
counts as the empty text. Several labels of one id count as their maximum, null
labels as none; repeated documents count each. Null and empty texts have no
features and get the constant's score. Without labelled rows of both classes all
texts get the smoothed share of good rows. Extra columns are ignored; labels,
language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RowsByFile, row_position, slices, utf8, write_by_file, write_table
from .words import U, mixed, window_hashes, word_hashes, word_spans

DIMENSIONS = 1 << 20
#: Labelled rows of each class that the model learns from, at most.
FIT_ROWS = 3000
EPOCHS = 3
FOLDS, HELD = 3, 1
#: FTRL-Proximal: learning rate, its offset, and the L1 and L2 bounds.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 1.0

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_UPPER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = _DIGIT[48:58] = True


def shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A number for the shape of each word."""
    def inside(flags):
        run = np.concatenate(([0], np.cumsum(flags[buf])))
        return run[ends] - run[starts]

    length, plain, upper = ends - starts, inside(_ALNUM), inside(_UPPER)
    case = np.where(upper == 0, 0, np.where(upper == 1, np.where(_UPPER[buf[starts]], 1, 2), np.where(2 * upper >= plain, 3, 4)))
    marks = np.minimum(length - plain, 3)
    last, other = buf[ends - 1], buf[np.maximum(ends - 2, 0)]
    last = np.where(_ALNUM[last], 0, last)
    other = np.where((length < 2) | _ALNUM[other], 0, other)
    same = np.concatenate(([False], words[1:] == words[:-1]))
    digits = inside(_DIGIT) > 0
    return mixed((((case * 4 + marks) * 2 + digits) * 2 + same).astype(U) << U(16) | last.astype(U) << U(8) | other.astype(U))


def _weighed(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    slots, counts = np.unique((np.concatenate(hashes) & U(DIMENSIONS - 1)).astype(np.int32), return_counts=True)
    weights = np.log1p(counts)
    return slots, weights / np.sqrt((weights * weights).sum())


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their weights."""
    starts, ends = word_spans(text)
    if not len(starts):
        return np.empty(0, np.int32), np.empty(0)
    words = word_hashes(text, starts, ends)
    forms = shapes(np.frombuffer(text, np.uint8), starts, ends, words)
    a, x = _weighed([mixed(window_hashes(words, k) + U(k)) for k in (1, 2)])
    b, y = _weighed([mixed(window_hashes(forms, k) + U(100 + k)) for k in (1, 2, 3)])
    return np.concatenate([a, b]), np.concatenate([x, y])


class Ftrl:
    """Weights of a logistic regression that learns a row at a time."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)  # the last slot is the constant

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        slots, values = np.append(slots, DIMENSIONS), np.append(values, 1.0)
        w = self.weights(slots)
        slope = (1 / (1 + np.exp(-np.clip(w @ values, -50, 50))) - label) * values
        square = slope * slope
        rate = (np.sqrt(self.n[slots] + square) - np.sqrt(self.n[slots])) / ALPHA
        # a text of words and shapes may hit a slot twice
        np.add.at(self.z, slots, slope - rate * w)
        np.add.at(self.n, slots, square)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD


def _sampled(picked: RowsByFile):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, label = picked.among(batch.column(0), batch.column(1))
            found = [features(t) for t in utf8(batch.column(2).take(pa.array(at)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int64()), pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                 pa.array([x.astype("<f8").tobytes() for _, x in found], pa.binary())], ["label", "slots", "values"])
    return run


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights of the slots and the constant, from ``docs`` (``doc_id``,
    ``text``) and ``labels`` (``doc_id``, ``quality``) without the held-out rows."""
    spark = docs.sparkSession
    placed, file, row = row_position(docs)
    rows = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(file).alias("file"), F.col(row).alias("row"), "text")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("quality is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("long").alias("value")))
    marked = write_table(spark, rows.select("doc_id", "file", "row").where(~held_out(F.col("doc_id"))).join(known, "doc_id"), "marked")
    sizes = {r["value"]: r["n"] for r in marked.groupBy("value").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(0, 0), sizes.get(1, 0)
    if not bad or not good:
        share = (good + 0.1) / (bad + good + 1)
        return np.zeros(DIMENSIONS), float(np.log(share / (1 - share)))
    order = [F.xxhash64("doc_id", "row"), F.col("file"), F.col("row")]
    least = [marked.where(F.col("value") == v).orderBy(*order).limit(FIT_ROWS) for v in (0, 1)]
    picked = write_by_file(spark, least[0].union(least[1]).select("file", "row", "value"), "sample")
    found = rows.select("file", "row", "text").mapInArrow(_sampled(picked), "label long, slots binary, values binary")
    sample = write_table(spark, found.orderBy(F.xxhash64("slots", "values"), "label"), "sample")
    model = Ftrl()
    for _ in range(EPOCHS):
        for r in sample.orderBy(F.xxhash64("slots", "values"), "label").toLocalIterator():  # 2 * FIT_ROWS rows, a partition at a time
            model.learn(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["values"], "<f8"), r["label"])
    weights = model.weights()
    odds = lambda a, b: np.log((a + 0.1) / (b + 0.1))
    return weights[:-1], float(weights[-1] + odds(good, bad) - odds(min(good, FIT_ROWS), min(bad, FIT_ROWS)))


def _scored(weights: np.ndarray, constant: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            z = np.empty(batch.num_rows)
            for k, text in enumerate(utf8(batch.column(2))):
                slots, values = features(text)
                z[k] = constant + weights[slots] @ values
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))), pa.float64())],
                                             ["doc_id", "held_out", "score"])
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    weights, constant = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), "text")
    return (rows.mapInArrow(_scored(weights.astype(np.float32), constant), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
