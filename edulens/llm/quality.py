"""Quality rules by weak supervision: rules vote or abstain, expectation
maximisation estimates how often each rule is right, and a document stays when
its posterior probability of being good is at least one half.

Each rule reads one integer feature of the whole text and votes good, junk or
not at all. Documents are counted by their vote pattern (at most 3**11 rows,
however large the table). On these counts the driver fits a two-class model in
which rules vote independently given the class; a weak prior keeps the classes
from changing places and defines the result of an empty table. A text with
fewer than 20 words, or with over 30 % of its words in repeated 8-word windows,
is rejected whatever the rules say.

Null and empty texts have no words and are rejected. Repeated rows are judged
alike. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_position, slices, utf8, without_rows, write_by_file, write_table
from .words import window_hashes, word_hashes, word_spans

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_plain", "n_marked", "n_capitals", "n_letters", "n_exclaims", "n_echoes",
            "n_held"]
#: (feature, the feature it is a share of, per cent above which it is junk, per
#: cent up to which it is good). With the bounds exchanged, more is better.
SHARE_RULES = [
    ("n_symbols", "n_words", 30, 2),
    ("n_marked", "n_words", 30, 2),
    ("n_plain", "n_words", 75, 90),
    ("n_capitals", "n_letters", 50, 20),
    ("n_exclaims", "n_words", 30, 5),
    ("n_repeat_words", "n_words", 30, 10),
    ("n_echoes", "n_words", 20, 5),
    ("n_held", "n_words", 15, 2),
    ("n_dup_lines", "n_lines", 50, 10),
    ("word_chars", "n_words", 2000, 1200),
]
N_RULES = len(SHARE_RULES) + 1
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30

_SYMBOL, _LETTER, _CAPITAL = (np.zeros(256, bool) for _ in range(3))
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_END = np.zeros(256, bool)
_END[list(b".,;:!?")] = True


def features(text: bytes) -> tuple[int, ...]:
    """The values of ``FEATURES`` of a text."""
    if not text:
        return (0,) * len(FEATURES)
    buf = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(text)
    n = len(starts)
    symbols, letters = _SYMBOL[buf], _LETTER[buf]
    points = (buf & 0xC0) != 0x80
    spaces = len(buf) - int((ends - starts).sum())
    # a plain word is letters, then at most one mark of punctuation
    run = np.concatenate(([0], np.cumsum(letters)))
    last = _END[buf[ends - 1]] if n else np.zeros(0, bool)
    body = ends - last
    plain = (run[body] - run[starts] == body - starts) & (body > starts)
    # a marked word ends in two symbols
    marked = symbols[ends - 1] & symbols[ends - 2] & (ends - starts > 1) if n else last
    lines, seen, dup = 0, set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    words = word_hashes(text, starts, ends)
    repeated = 0
    windows = window_hashes(words, WINDOW)
    if len(windows):
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        if len(counts) < len(windows):
            at = np.flatnonzero(counts[inverse] > 1)
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            repeated = int((np.cumsum(cover) > 0).sum())
    capitals = _CAPITAL[buf]
    echo = words[1:] == words[:-1]  # a word that repeats the last one; held: the last two
    return (n, int(points.sum()) - spaces, int(symbols.sum()), dup, repeated, lines, int(plain.sum()), int(marked.sum()),
            int(capitals.sum()), int((letters & points).sum()), text.count(b"!"), int(echo.sum()), int((echo[1:] & echo[:-1]).sum()))


def votes(f: np.ndarray) -> np.ndarray:
    """Votes (rows, rules) of features (rows, ``FEATURES``): 2 good, 1 junk, 0 none."""
    of = {name: f[:, i] for i, name in enumerate(FEATURES)}
    out = np.zeros((len(f), N_RULES), np.int64)
    for r, (part, whole, junk, good) in enumerate(SHARE_RULES):
        a, b = 100 * of[part], of[whole]
        bad, fine = (a > junk * b, a <= good * b) if junk > good else (a < junk * b, a >= good * b)
        out[:, r] = np.where(b == 0, 0, np.where(bad, 1, np.where(fine, 2, 0)))
    n = of["n_words"]
    out[:, -1] = np.where(n < 10, 1, np.where(n >= 50, 2, 0))
    return out


def pattern(v: np.ndarray) -> np.ndarray:
    return v @ 3 ** np.arange(N_RULES)


def patterns_votes(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(N_RULES) % 3


def fit(codes: np.ndarray, counts: np.ndarray, tolerance: float = 1e-9) -> tuple[float, np.ndarray]:
    """Share of good documents and, by class (junk, good) and rule, the
    probability that a vote says junk. Before any data, nine documents in ten
    are good, and a rule says junk of 60 % of junk and of 1 % of good documents; this
    prior weighs as much as a hundredth of the documents (ten at least)."""
    v = patterns_votes(codes)
    said, junk = (v > 0).astype(float), (v == 1).astype(float)
    weight = max(10.0, 0.01 * counts.sum())
    prior_good, prior = 0.9, np.array([[0.6] * N_RULES, [0.01] * N_RULES])
    good, rate = prior_good, prior.copy()
    while True:
        p = posterior(codes, good, rate)
        mass = np.stack([(1 - p) * counts, p * counts])
        strength = weight * np.array([[1 - prior_good], [prior_good]])
        new = (mass @ junk + strength * prior) / (mass @ said + strength)
        new_good = (mass[1].sum() + weight * prior_good) / (counts.sum() + weight)
        if np.abs(new - rate).max() < tolerance and abs(new_good - good) < tolerance:
            return new_good, new
        good, rate = new_good, new


def posterior(codes: np.ndarray, good: float, rate: np.ndarray) -> np.ndarray:
    """Probability that a document with this vote pattern is good."""
    v = patterns_votes(codes)
    score = np.log([1 - good, good])[:, None] + (np.log(rate) @ (v == 1).T) + (np.log1p(-rate) @ (v == 2).T)
    return 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))


def _judged(texts) -> tuple[np.ndarray, np.ndarray]:
    f = np.array([features(t) for t in texts], np.int64).reshape(-1, len(FEATURES))
    return f, pattern(votes(f))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        f, code = _judged(utf8(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(f[:, i]) for i in range(len(FEATURES))), pa.array(code)],
                                         ["doc_id", *FEATURES, "votes"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        f, code = _judged(utf8(batch.column(2)))
        failed = _base_failed({c: f[:, i] for i, c in enumerate(FEATURES)})
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code), pa.array(failed)], ["file", "row", "votes", "failed"])


def _fit_counts(rows: list) -> tuple[np.ndarray, np.ndarray]:
    codes = np.array([r[0] for r in rows], np.int64)
    return codes, posterior(codes, *fit(codes, np.array([r[1] for r in rows], float)))


def _base_failed(f: dict):
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEATED * f["n_words"])


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the features, ``base_failed``, ``probability`` (that the
    document is good) and ``kept`` of each row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    schema = ", ".join(f"{c} long" for c in ["doc_id", *FEATURES, "votes"])
    table = write_table(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_featured, schema), "features")
    codes, good = _fit_counts(table.groupBy("votes").count().collect())  # at most 3**N_RULES rows
    verdicts = spark.createDataFrame(list(zip(codes.tolist(), good.tolist(), strict=True)), "votes long, probability double")
    failed = _base_failed({c: F.col(c) for c in FEATURES})
    return (table.join(F.broadcast(verdicts), "votes").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= 0.5))
            .select("doc_id", *FEATURES, "base_failed", "probability", "kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns.
    Features are computed once; the place and votes of each row are stored, and
    a second scan takes the places of the rows that go, so that no text is shuffled."""
    spark = docs.sparkSession
    placed, file, row = row_position(docs)
    rows = placed.select(F.col(file).alias("file"), F.col(row).alias("row"), "text")
    table = write_table(spark, rows.mapInArrow(_placed, "file string, row long, votes long, failed boolean"), "votes")
    codes, good = _fit_counts(table.groupBy("votes").count().collect())  # at most 3**N_RULES rows
    junk = spark.createDataFrame([(c,) for c in codes[good < 0.5].tolist()], "votes long").withColumn("junk", F.lit(True))
    gone = write_by_file(spark, table.join(F.broadcast(junk), "votes", "left").where("failed or junk")
                         .select("file", "row", F.lit(0).cast("long").alias("value")), "rejected")
    return without_rows(placed, file, row, gone, docs)
