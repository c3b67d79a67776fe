"""Helpers the operators share: written tables in the shared folder, text
columns as bytes, and stable positions of rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows that a task works on at a time.
SLICE = 8192


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return scratch_path(spark, "llm", name)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def make_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder in the shared folder; it goes when the driver ends."""
    path = fresh_path(spark, name)
    fs, where = _hadoop(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def write_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again. This
    cuts the lineage: a lost executor costs no recomputation, and rows keep
    the values they were written with. The files go when the driver ends."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    fs, where = _hadoop(spark, path)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table of :func:`write_table` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        fs, where = _hadoop(spark, folder)
        fs.delete(where, True)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut to at most ``SLICE`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8 bytes; null is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def row_position(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns that place each row, its file and its
    number in that file, and their names. Frames that read no files are first
    written to the shared folder, so that the position never changes."""
    file, row = free_name(docs, "__file"), free_name(docs, "__row")

    def placed(df: DataFrame) -> DataFrame:
        where = df.metadataColumn("_metadata")  # also where a column of the rows has this name
        return df.select("*", where["file_path"].alias(file), where["row_index"].alias(row))

    try:
        return placed(docs), file, row
    except AnalysisException:
        return placed(write_table(docs.sparkSession, docs, "rows")), file, row


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def byte_length(col: Column) -> Column:
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


#: Folders that tables by file are cut in, at most.
FILE_BUCKETS = 1024


class RowsByFile:
    """Picked rows of files, each with a number, in the shared folder. A task
    that scans a file loads what is picked of this file, so that rows meet
    their numbers without a shuffle of the file's contents."""

    def __init__(self, folder: str, buckets: int):
        self.folder, self.buckets = folder, buckets
        self._held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return {"folder": self.folder, "buckets": self.buckets, "_held": {}}

    def _load(self, file: str) -> tuple[np.ndarray, np.ndarray]:
        if file not in self._held:
            self._held.clear()
            fs, where = pafs.FileSystem.from_uri(f"{self.folder}/bucket={zlib.crc32(file.encode()) % self.buckets}")
            rows, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for f in fs.get_file_info(pafs.FileSelector(where, allow_not_found=True)):
                if f.path.endswith(".parquet"):
                    found = pq.read_table(f.path, filesystem=fs, columns=["row", "value"], filters=[("file", "=", file)], partitioning=None)
                    rows.append(found.column("row").to_numpy())
                    values.append(found.column("value").to_numpy())
            row, value = np.concatenate(rows), np.concatenate(values)
            order = np.argsort(row)
            self._held[file] = row[order], value[order]
        return self._held[file]

    def among(self, files: pa.Array, rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which of these rows are picked (their indices), and their numbers."""
        at, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        files, rows = files.dictionary_encode(), rows.to_numpy()
        for k, file in enumerate(files.dictionary.to_pylist()):
            here = np.flatnonzero(files.indices.to_numpy() == k)
            row, value = self._load(file)
            place = np.searchsorted(row, rows[here])
            found = place < len(row)
            found[found] = row[place[found]] == rows[here][found]
            at.append(here[found])
            values.append(value[place[found]])
        return np.concatenate(at), np.concatenate(values)


def write_by_file(spark: SparkSession, picked: DataFrame, name: str) -> RowsByFile:
    """Write ``file, row, value`` so that tasks can look rows up by file."""
    folder = make_folder(spark, name)
    (picked.select("file", "row", "value", F.pmod(F.crc32("file"), F.lit(FILE_BUCKETS)).alias("bucket"))
     .repartition("bucket").sortWithinPartitions("bucket", "file").write.partitionBy("bucket").parquet(f"{folder}/rows"))
    return RowsByFile(f"{folder}/rows", FILE_BUCKETS)


def without_rows(placed: DataFrame, file: str, row: str, gone: RowsByFile, docs: DataFrame) -> DataFrame:
    """The rows of ``placed`` (:func:`row_position` of ``docs``) that are not
    among ``gone``, with the columns of ``docs``."""
    names = placed.columns
    at, keep = (names.index(file), names.index(row)), [names.index(c) for c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stays = np.ones(batch.num_rows, bool)
            stays[gone.among(batch.column(at[0]), batch.column(at[1]))[0]] = False
            yield batch.select(keep).filter(pa.array(stays))

    return placed.mapInArrow(run, docs.schema)


#: Rows of a file that are numbered together.
CHUNK = 1024


def numbered(rows: DataFrame, key: str, file: str, row: str, name: str) -> DataFrame:
    """``rows`` with the number (from 0) of each among those of its ``key``
    (not null), in order of place. Rows are counted in chunks of a file, then
    chunks and files are summed up, so no key's rows meet in one task."""
    cut = rows.withColumn("__chunk", F.floor(F.col(row) / CHUNK))
    local = F.row_number().over(Window.partitionBy(key, file, "__chunk").orderBy(row)) - 1
    counts = cut.groupBy(key, file, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    chunks = counts.withColumn("__skip", F.coalesce(F.sum("__n").over(
        Window.partitionBy(key, file).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    files = counts.groupBy(key, file).agg(F.sum("__n").alias("__n")).withColumn("__base", F.coalesce(F.sum("__n").over(
        Window.partitionBy(key).orderBy(file).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    offsets = chunks.drop("__n").join(files, [key, file]).select(
        key, file, "__chunk", (F.col("__skip") + F.col("__base")).alias("__skip"))
    return (cut.withColumn("__local", local).join(offsets, [key, file, "__chunk"])
            .withColumn(name, (F.col("__local") + F.col("__skip")).cast("long"))
            .drop("__chunk", "__local", "__skip"))
