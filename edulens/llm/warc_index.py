"""WARC archives with a two-level capture index.

Writing: each page becomes a gzip member in an archive, a response with its
payload or, if an equal payload of at least ``MIN_REVISIT`` bytes has a larger
page id, a revisit that refers to the largest one. The revisits are found on
digests alone and looked up by file, so payloads are never shuffled.

Index: one line for each record (reversed-host URL key, page id, archive,
offset, length), sorted over all archives by ranges. Lines are packed in
compressed blocks of ``BLOCK_LINES``; a sparse directory beside each index file
keeps the first line and the place of each block, and a table with one row for
each index file keeps its first line. A lookup searches that table, the
directory and one block by bisection, then reads the record's range only.

Files have names of their own attempt, and only those in a table that Spark
has committed are read, so lost or repeated tasks leave nothing behind that counts.

A null page has an empty payload; a null URL has the empty key. Rows with a
null id are revisits if a row with an id has their payload, else responses.
Rows that repeat an id are records of their own; all rows of the largest id are
responses. Extra columns are ignored. An empty table has an empty index.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RowsByFile, byte_length, make_folder, row_position, slices, utf8, write_by_file, write_table

MIN_REVISIT = 1000
ARCHIVE_BYTES = 1 << 28
BLOCK_LINES = 1000
#: Captures of an index file, and lookups of a task, on average.
INDEX_ROWS, LOOKUP_ROWS = 1 << 17, 1 << 14
CAPTURE_DATE = "2024-01-01T00:00:00Z"
#: Archives that a reading task holds open.
OPEN_FILES = 64

_PORTS = {"http": 80, "https": 443}
#: A page id as sortable text; null sorts first.
_NO_ID = ""


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``https://a.example.com:443/x?y#z`` is ``com,example,a)/x?y``."""
    text = quote(url or "", safe="".join(chr(c) for c in range(33, 127)) + "%")
    if not text:
        return ""
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return ")" + text
    name = ",".join(reversed(host.split(".")))
    if port and port != _PORTS.get(parts.scheme.lower()):
        name += f":{port}"
    return f"{name}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _sort_id(page_id: int | None) -> str:
    """Fixed width, in order of the numbers, after null."""
    return _NO_ID if page_id is None else f"{page_id + (1 << 63):020d}"


def _from_sort_id(text: str) -> int | None:
    return int(text) - (1 << 63) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record as one gzip member. A revisit keeps only the HTTP header,
    which names the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {CAPTURE_DATE}",
             f"WARC-Target-URI: {quote(url or '', safe=''.join(chr(c) for c in range(33, 127)))}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def parse_record(member: bytes) -> dict:
    """The fields of a record; the digest and length are of the full payload."""
    data = zlib.decompress(member, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("the payload does not match its digest")
    else:
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {"page_id": None if page is None else int(page), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": None if refers is None else int(refers)}


def _archived(folder: str, revisits: RowsByFile):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, uri, place = None, "", 0
        for batch in slices(batches):
            at, latest = revisits.among(batch.column(3), batch.column(4))
            refers = dict(zip(at.tolist(), latest.tolist(), strict=True))
            out: list[list] = [[], [], [], [], []]
            for i, (page, url, html) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True)):
                if sink is None:
                    uri, place = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    fs, where = pafs.FileSystem.from_uri(uri)
                    sink = fs.open_output_stream(where, compression=None)
                member = record(page, url, html, refers.get(i))
                sink.write(member)
                for column, value in zip(out, (url_key(url), _sort_id(page), uri.rsplit("/", 1)[1], place, len(member)), strict=True):
                    column.append(value)
                place += len(member)
                if place >= ARCHIVE_BYTES:
                    sink.close()
                    sink = None
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                             ["key", "id", "archive", "place", "size"])
        if sink is not None:
            sink.close()
    return run


def write_archives(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> tuple[str, DataFrame]:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as archives in the
    shared folder; the folder and the captures (``key, id, archive, place, size``)."""
    spark = pages.sparkSession
    placed, file, row = row_position(pages)
    rows = placed.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"), F.col(file).alias("file"), F.col(row).alias("row"))
    html = F.coalesce("html", F.lit(""))
    prints = write_table(spark, rows.select("page_id", "file", "row", F.sha1(html).alias("digest"), byte_length(html).alias("size"))
                         .where(F.col("size") >= min_revisit), "payloads")
    latest = prints.groupBy("digest").agg(F.max("page_id").alias("value"), F.count(F.lit(1)).alias("n")).where("n > 1")
    older = prints.join(latest, "digest").where("not (page_id <=> value)")
    revisits = write_by_file(spark, older.select("file", "row", "value"), "revisits")
    folder = make_folder(spark, "warc")
    return folder, write_table(spark, rows.mapInArrow(
        _archived(folder, revisits), "key string, id string, archive string, place long, size long"), "captures")


def _indexed(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sink, place, directory, lines, total = uuid.uuid4().hex, None, 0, [], [], 0

        def flush() -> None:
            nonlocal place
            data = zlib.compress("\n".join("\t".join(line) for line in lines).encode(), 6)
            sink.write(data)
            directory.append("\t".join((*lines[0][:2], str(place), str(len(data)))))
            place += len(data)
            lines.clear()

        for batch in batches:
            if sink is None and batch.num_rows:
                fs, where = pafs.FileSystem.from_uri(f"{folder}/{name}.cdx")
                sink = fs.open_output_stream(where, compression=None)
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines.append((*line[:3], str(line[3]), str(line[4])))
                total += 1
                if len(lines) == block_lines:
                    flush()
        if sink is None:
            return
        if lines:
            flush()
        # the directory follows the blocks, and its place ends the file
        data = zlib.compress("\n".join(directory).encode(), 6)
        sink.write(data + struct.pack("<QQ", place, len(data)))
        sink.close()
        key, page = directory[0].split("\t")[:2]
        yield pa.RecordBatch.from_pydict({"name": [name], "key": [key], "id": [page], "lines": [total]})
    return run


def _ranges(rows: DataFrame, each: int) -> int:
    """Ranges to cut ``rows`` in: keys are small, so their bytes say nothing of the work."""
    return max(1, -(-rows.count() // each))


def write_index(folder: str, captures: DataFrame, block_lines: int = BLOCK_LINES) -> list[tuple[tuple[str, str], str]]:
    """Write the index files of ``captures``; the top of the index: the first
    line and the file of each, in order (one entry for each partition)."""
    spark = captures.sparkSession
    ordered = captures.select("key", "id", "archive", "place", "size").repartitionByRange(
        _ranges(captures, INDEX_ROWS), "key", "id").sortWithinPartitions("key", "id")
    files = write_table(spark, ordered.mapInArrow(_indexed(folder, block_lines), "name string, key string, id string, lines long"), "index")
    return sorted(((r["key"], r["id"]), f"{folder}/{r['name']}.cdx") for r in files.select("key", "id", "name").collect())


class IndexReader:
    """Point lookups in an index. It keeps one directory and one block, so
    lookups in order of their keys read each of them once."""

    def __init__(self, top: list[tuple[tuple[str, str], str]]):
        self.firsts, self.files = [t[0] for t in top], [t[1] for t in top]
        self._directory: tuple[str, list, object] = ("", [], None)
        self._block: tuple[tuple, list] = ((), [])

    def _blocks(self, uri: str) -> list[tuple[tuple[str, str], int, int]]:
        if self._directory[0] != uri:
            fs, path = pafs.FileSystem.from_uri(uri)
            file = fs.open_input_file(path)
            size = file.size()
            place, length = struct.unpack("<QQ", file.read_at(16, size - 16))
            lines = zlib.decompress(file.read_at(length, place)).decode().split("\n")
            entries = [(tuple(x[:2]), int(x[2]), int(x[3])) for x in (line.split("\t") for line in lines)]
            self._directory = uri, entries, file
        return self._directory[1]

    def _lines(self, uri: str, place: int, length: int) -> list[tuple]:
        if self._block[0] != (uri, place):
            data = zlib.decompress(self._directory[2].read_at(length, place)).decode()
            self._block = (uri, place), [(tuple(x[:2]), x[2], int(x[3]), int(x[4])) for x in (line.split("\t") for line in data.split("\n"))]
        return self._block[1]

    def find(self, key: str, page: str) -> Iterator[tuple[str, int, int]]:
        """Archive, place and size of each record of this key and id."""
        want = (key, page)
        for f in range(max(0, bisect_left(self.firsts, want) - 1), bisect_right(self.firsts, want)):
            blocks = self._blocks(self.files[f])
            starts = [b[0] for b in blocks] if len(blocks) < 64 else _Starts(blocks)
            for b in range(max(0, bisect_left(starts, want) - 1), bisect_right(starts, want)):
                lines = self._lines(self.files[f], *blocks[b][1:])
                for line in lines[bisect_left(lines, want, key=lambda x: x[0]) : bisect_right(lines, want, key=lambda x: x[0])]:
                    yield line[1:]


class _Starts:
    """The first lines of blocks as a sequence to bisect, without a copy."""

    def __init__(self, blocks: list):
        self.blocks = blocks

    def __len__(self) -> int:
        return len(self.blocks)

    def __getitem__(self, i: int) -> tuple[str, str]:
        return self.blocks[i][0]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([url_key(u) for u in batch.column(1).to_pylist()], pa.string()),
            "id": pa.array([_sort_id(p) for p in batch.column(0).to_pylist()], pa.string())})


def _fetched(folder: str, top: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, archives = IndexReader(top), {}
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in slices(batches):
            out = []
            for key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for archive, place, size in reader.find(key, page):
                    if archive not in archives:
                        if len(archives) >= OPEN_FILES:
                            archives.pop(next(iter(archives))).close()
                        fs, where = pafs.FileSystem.from_uri(f"{folder}/{archive}")
                        archives[archive] = fs.open_input_file(where)
                    out.append(parse_record(archives[archive].read_at(size, place)))
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def lookup(wanted: DataFrame, folder: str, top: list[tuple[tuple[str, str], str]]) -> DataFrame:
    """The records of ``wanted`` (``page_id``, ``url``; each pair once), read
    through the index: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    keys = (wanted.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
            .mapInArrow(_keys, "key string, id string").distinct()
            .repartitionByRange(_ranges(wanted, LOOKUP_ROWS), "key", "id").sortWithinPartitions("key", "id"))
    return keys.mapInArrow(_fetched(folder, top),
                           "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
