"""Benchmark decontamination with an Aho-Corasick automaton.

Benchmark items and documents are normalised alike: A-Z lowered, every ASCII
character that is not a letter or digit a blank, words parted by one blank.
Runs of ten words of an item (or the whole item, if shorter) are the patterns
of an automaton, and every whole text is scanned; matches are mapped back to
words and to character offsets of the original.

The windows lie in a written table, in blocks of at most ``WINDOWS_PER_BLOCK``
windows, so an automaton has a fixed size. With one block a task builds its
automaton once. A larger benchmark has more blocks: they go one after the other
over each slice of texts, so each is built once a slice, and a text is scanned
once for each block. Documents are never shuffled.

Null and empty texts have no words and no hits; null or empty items have no
windows. A null ``item_id`` counts as the id ``''``; rows that repeat an id are
parts of one item. Repeated rows and extra columns change nothing. With an
empty benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import make_folder, slices, utf8

WINDOW = 10
WINDOWS_PER_BLOCK = 50_000

#: Lowers A-Z and blanks every other ASCII character but a-z and 0-9.
_PLAIN = bytes(c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256)).lower()
_automata: dict[str, tuple[ahocorasick.Automaton, list[tuple[int, list[str]]]]] = {}


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The distinct patterns of an item, in order."""
    words = plain_words(text)
    n = max(1, len(words) - size + 1) if words else 0
    return list(dict.fromkeys(b" ".join(words[i : i + size]) for i in range(n)))


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                of = windows(text, size)
                found += of
                ids += [item] * len(of)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(ids, pa.string())], ["window", "item"])
    return run


def _automaton(path: str) -> tuple[ahocorasick.Automaton, list[tuple[int, list[str]]]]:
    """The automaton of a block and, by value, each window's number of words and items."""
    if path not in _automata:
        _automata.clear()
        fs, where = pafs.FileSystem.from_uri(path)
        by_window: dict[bytes, set[str]] = {}
        for file in sorted(f.path for f in fs.get_file_info(pafs.FileSelector(where, recursive=True)) if f.path.endswith(".parquet")):
            with pq.ParquetFile(fs.open_input_file(file)) as parts:
                for batch in parts.iter_batches(columns=["window", "item"]):
                    for w, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                        by_window.setdefault(w, set()).add(item)
        automaton, values = ahocorasick.Automaton(ahocorasick.STORE_INTS), []
        for w, items in by_window.items():
            automaton.add_word(f" {w.decode('latin-1')} ", len(values))
            values.append((w.count(b" ") + 1, sorted(items)))
        automaton.make_automaton()
        _automata[path] = automaton, values
    return _automata[path]


def _scan_all(texts: list[bytes], blocks: list[str]) -> Iterator[tuple[int, np.ndarray, set[str]]]:
    """For each text the number of words, which words are hit, and the items.
    Blocks go one after the other over all texts, so that one automaton is held and each is built once."""
    counts = [0] * len(texts) if blocks else [len(plain_words(t)) for t in texts]
    found: dict[int, tuple[np.ndarray, set[str]]] = {}
    for path in blocks:
        automaton, values = _automaton(path)
        for i, text in enumerate(texts):
            words = plain_words(text)
            counts[i] = len(words)
            if not words or not len(automaton):
                continue
            line = b" " + b" ".join(words) + b" "
            blanks = None
            for end, value in automaton.iter(line.decode("latin-1")):
                if blanks is None:
                    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                    cover, items = found.setdefault(i, (np.zeros(len(words) + 1, np.int64), set()))
                after = int(np.searchsorted(blanks, end))  # words before this blank
                size, of = values[value]
                cover[after - size] += 1
                cover[after] -= 1
                items.update(of)
    for i, n in enumerate(counts):
        cover, items = found.get(i, (None, set()))
        yield n, np.zeros(n, bool) if cover is None else np.cumsum(cover[:-1]) > 0, items


def _scan(text: bytes, blocks: list[str]) -> tuple[int, np.ndarray, set[str]]:
    """Those of one text."""
    return next(_scan_all([text], blocks))


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Character offsets (start, end) in the original of each run of hit words."""
    if not hit.any():
        return []
    word = np.frombuffer(text.translate(_PLAIN), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], word, [0])).astype(np.int8)))
    runs = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
    point = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(point[edges[2 * a]]), "end": int(point[edges[2 * b - 1]])} for a, b in zip(runs[::2], runs[1::2], strict=True)]


_FOUND = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _scanned(blocks: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            texts = list(utf8(batch.column(1)))
            for text, (n, hit, items) in zip(texts, _scan_all(texts, blocks), strict=True):
                for column, value in zip(out, (n, int(hit.sum()), sorted(items), _spans(text, hit)), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(_FOUND)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))],
                                             ["doc_id", "n_words", "n_hit", "items", "spans"])
    return run


def write_windows(benchmark: DataFrame, size: int = WINDOW, per_block: int = WINDOWS_PER_BLOCK) -> list[str]:
    """Write the windows of ``benchmark`` (``item_id``, ``text``) in blocks; their folders."""
    spark = benchmark.sparkSession
    folder = make_folder(spark, "windows")
    found = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
             .mapInArrow(_item_windows(size), "window binary, item string").distinct())
    found.write.parquet(f"{folder}/all")
    table = spark.read.schema(found.schema).parquet(f"{folder}/all")
    blocks = -(-table.count() // per_block)
    (table.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(max(1, blocks))))
     .repartition("block").write.partitionBy("block").parquet(f"{folder}/blocks"))
    return [f"{folder}/blocks/block={b}" for b in range(blocks)]


def _present(blocks: list[str]) -> list[str]:
    out = []
    for path in blocks:
        fs, where = pafs.FileSystem.from_uri(path)
        if fs.get_file_info(where).type != pafs.FileType.NotFound:
            out.append(path)
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit`` (words inside a window), ``items`` (ids, as
    sorted strings) and ``spans`` (character offsets in the text) of each row of ``docs``."""
    blocks = _present(write_windows(benchmark, size))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scanned(blocks), "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    blocks = _present(write_windows(benchmark, size))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not items for _, _, items in _scan_all(list(utf8(batch.column(at))), blocks)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
