"""Token ids in binary shards with Re-Pair grammar compression.

Documents are dealt to shards by ranges of ``doc_id`` and encoded in that
order; each ends with an end id. A shard's ids are cut in blocks of fixed size.
In a block, Re-Pair works in rounds: all id pairs that occur often enough
become nonterminals at once, from the left where they overlap, until a round
saves too little. A block stores its rules, the length that each rule expands
to, and the remaining symbols, so that any run of ids is decoded from the
symbols that cover it and nothing else.

File: blocks, then the documents' ids and first tokens, then a directory of
blocks (place and first token of each) and a fixed trailer. A task writes its
file under a name of its own attempt; only files in the manifest, which Spark
commits, count, so a lost or repeated task leaves nothing that is read.

A null text is empty and has only the end id. Null ids come first; rows that
repeat an id stay rows of their own, ordered by text. Extra columns are
ignored. An empty table gives no files and an empty result. Memory: one block
of ids and two integers for each document of a shard.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import make_folder, slices, utf8, write_table

END_ID = 2
BLOCK_TOKENS = 1 << 20
#: A pair becomes a rule if it occurs so often in its block.
MIN_COUNT = 4
#: The rounds end when one saves less than this share of the symbols.
MIN_SAVING = 0.005
#: Pieces of words whose ids an encoder remembers.
CACHE_WORDS = 1_200_000

#: Texts of so many bytes, or one, are encoded together.
ENCODE_BYTES = 1 << 23
#: Words whose ids are copied together: arrays of these stay in a core's cache.
WORDS_AT_ONCE = 1 << 13
#: Pieces of words that the library encodes in one call.
PIECES_AT_ONCE = 1 << 14
_MAGIC = b"RPT1"
_HEAD = "<QIIIII"  # tokens, base, rules, symbols, width, bytes of the block's body
_TRAILER = "<QQQ4s"  # bytes of the documents and the directory, numbers of documents and of blocks


def _table(*kinds: bytes) -> bytes:
    """For ``bytes.translate``: the number (from 1) of the kind that a byte is in, else 0."""
    return bytes(next((n for n, kind in enumerate(kinds, 1) if c in kind), 0) for c in range(256))


#: Kinds of bytes: 1 what begins a word (a blank, a line end, and the zero byte before a text), 2 other white space, 3 what
#: may begin it in UTF-8.
_KIND = _table(b"\0\n ", bytes([9, 11, 12, 13, 28, 29, 30, 31]), bytes([0xC2, 0xE1, 0xE2, 0xE3]))
#: 1 ASCII letters and digits, 2 ASCII punctuation, 3 what begins a two-byte letter from U+00C0 to U+023F.
_LETTER = _table(bytes(c for c in range(33, 127) if chr(c).isalnum()), bytes(c for c in range(33, 127) if not chr(c).isalnum()),
                 bytes(range(0xC3, 0xC9)))


def _kinds(joined: bytes, table: bytes) -> np.ndarray:
    return np.frombuffer(joined.translate(table), np.uint8)


def _pieces(joined: bytes) -> np.ndarray:
    """Where the pieces of texts begin, each text with a zero byte before it:
    at a blank, a line end or the zero byte, and at punctuation after a letter or digit."""
    kind = _kinds(joined, _LETTER)
    begins = _kinds(joined, _KIND) == 1
    begins[1:] |= (kind[1:] == 2) & (kind[:-1] == 1)
    wide = np.flatnonzero((kind[2:] == 2) & (kind[:-2] == 3))
    second = np.frombuffer(joined, np.uint8)[wide + 1]
    begins[wide[(second != 0x97) & (second != 0xB7)] + 2] = True  # the signs for times and divided are no letters
    return np.flatnonzero(begins)


def _distinct(joined: bytes, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """For each piece the number of its bytes, and the distinct pieces. Up to eight bytes are compared as one integer
    (no piece ends with a zero byte, so zeros can fill it)."""
    edges = np.append(starts, len(joined))
    size = np.diff(edges)
    eight = np.ndarray(len(joined), "<u8", joined + bytes(8), strides=(1,))
    short, long = np.flatnonzero(size <= 8), np.flatnonzero(size > 8)
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    small = pa.array(eight[starts[short]] & masks[size[short]]).dictionary_encode()
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(joined)])
    large = pieces.take(pa.array(long)).dictionary_encode()
    inverse = np.empty(len(starts), np.int64)
    inverse[short] = small.indices.to_numpy()
    inverse[long] = large.indices.to_numpy() + np.int64(len(small.dictionary))
    found = small.dictionary.to_numpy().astype("<u8").view("S8").tolist()
    return inverse, found + large.dictionary.to_numpy(zero_copy_only=False).tolist()


def _odd_spaces(joined: bytes, heads: np.ndarray) -> np.ndarray:
    """Where there is white space other than a single blank or line end
    between two words; texts begin at ``heads``, each with a zero byte, and
    the buffer ends with three more."""
    buf, kind = np.frombuffer(joined, np.uint8), _kinds(joined, _KIND)
    at = np.flatnonzero(kind != 0)
    kind = kind[at]
    blank = at[kind == 1]
    lead = at[kind == 3]
    a, b, c = buf[lead], buf[lead + 1], buf[lead + 2]
    wide = (((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x80))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))
    zeros = blank[buf[blank] == 0]
    return np.concatenate([at[kind == 2], lead[wide], blank[:-1][np.diff(blank) == 1], np.setdiff1d(zeros, heads, assume_unique=True)])


class Encoder:
    """Ids of whole texts. Byte-level BPE never merges across a blank or line
    end between two words, nor from a letter or digit to punctuation after it.
    Texts are cut there, and each distinct piece is encoded once and remembered
    (with the blank or line end before it, or a zero byte at the start of a
    text). Texts with other runs of white space, and tokenizers of another kind,
    are encoded whole."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        before = self.tokenizer.pre_tokenizer
        self.by_word = (isinstance(before, pre_tokenizers.ByteLevel) and not before.add_prefix_space and before.use_regex
                        and self.tokenizer.normalizer is None)
        self._added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self._bytes = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, np.int64)  # that a token stands for
        for token, k in vocabulary.items():  # it has a letter for each
            self._bytes[k] = len(token)
        self._newline = vocabulary.get("\u010a", -1)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}  # numbers of pieces
        self._flat, self._counts = np.empty(0, np.uint32), np.empty(0, np.int64)  # ids of all pieces, and of each how many

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """The ids of all pieces, and how many each has. Pieces are encoded as
        one text, and the bytes that a token stands for tell where each ends;
        one without a blank or line end gets a line end, whose id is dropped."""
        lone = np.array([p[0] not in b" \n" for p in pieces])
        texts = [b"\n" + p.lstrip(b"\0") if add else p for p, add in zip(pieces, lone.tolist(), strict=True)]
        found = self.tokenizer.encode_batch_fast([b"".join(texts).decode()], add_special_tokens=False)[0]
        ids, edges = np.array(found.ids, np.uint32), np.cumsum([len(t) for t in texts])
        ends = np.cumsum(self._bytes[ids])
        if len(ids) and ends[-1] == edges[-1]:
            last = np.searchsorted(ends, edges)
            counts = np.diff(last, prepend=-1)
            extra = (last - counts + 1)[lone]
            if (ends[last] == edges).all() and (ids[extra] == self._newline).all():
                return np.delete(ids, extra), (counts - lone).tolist()
        each = [self.whole(p.lstrip(b"\0").decode()) for p in pieces]  # tokens that do not stand for bytes
        return np.frombuffer(b"".join(each), np.uint32), [len(e) // 4 for e in each]

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of pieces among those that are remembered; new ones are encoded."""
        found = np.fromiter(map(self._known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(found < 0)
        if len(new):
            flat, counts, n = [self._flat], [], len(self._known)
            words = [pieces[i] for i in new.tolist()]
            for a in range(0, len(words), PIECES_AT_ONCE):
                ids, sizes = self._encoded(words[a : a + PIECES_AT_ONCE])
                flat.append(ids)
                counts += sizes
            self._flat, self._counts = np.concatenate(flat), np.append(self._counts, counts)
            found[new] = np.arange(n, n + len(new))
            self._known.update(zip(words, range(n, n + len(new)), strict=True))
        return found

    def _by_word(self, texts: list[bytes]) -> np.ndarray:
        """Which texts can be encoded word by word; one that is empty or begins or ends with white space cannot."""
        if not self.by_word:
            return np.zeros(len(texts), bool)
        joined = b"".join(b"\0" + t for t in texts) + b"\0\0\0"
        size = np.array([len(t) + 1 for t in texts])
        heads = np.cumsum(size) - size
        odd = _odd_spaces(joined, heads)
        ok = np.ones(len(texts) + 1, bool)
        ok[np.searchsorted(heads, odd[odd < len(joined) - 3], "right") - 1] = False
        for added in self._added:
            if added in joined:
                ok[:-1] &= [added not in t for t in texts]
        return ok[:-1]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, as little-endian 32-bit integers."""
        if len(self._known) > CACHE_WORDS:
            self._forget()
        by_word = self._by_word(texts).tolist()
        out = [b"" if ok else self.whole(t.decode()) for t, ok in zip(texts, by_word, strict=True)]
        joined = b"".join(b"\0" + t for t, ok in zip(texts, by_word, strict=True) if ok)
        if joined:
            starts = _pieces(joined)
            inverse, pieces = _distinct(joined, starts)
            number = self._numbers(pieces)
            count = self._counts[number][inverse]
            found = _runs(self._flat, (np.cumsum(self._counts) - self._counts)[number][inverse], count).tobytes()
            cuts = [*(4 * (np.cumsum(count) - count)[np.frombuffer(joined, np.uint8)[starts] == 0]).tolist(), len(found)]
            at = 0
            for i, ok in enumerate(by_word):
                if ok:
                    out[i] = found[cuts[at] : cuts[at + 1]]
                    at += 1
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _slots(pairs: np.ndarray) -> np.ndarray:
    """Hashes of 18 bits."""
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)).view(np.int64)


def repair(ids: np.ndarray, base: int, min_count: int = MIN_COUNT, min_saving: float = MIN_SAVING) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (n, 2) and the rules' lengths; symbol ``base + i`` is rule i."""
    seq = ids.astype(np.uint64)
    rules, lengths = [np.empty((0, 2), np.uint32)], [np.empty(0, np.int64)]
    top = base
    while len(seq) > 1:
        pairs = (seq[:-1] << np.uint64(32)) | seq[1:]
        # only pairs whose hash occurs often enough can do so themselves; the others need no sorting
        slot = _slots(pairs)
        at = np.flatnonzero((np.bincount(slot, minlength=1 << 18) >= min_count)[slot])
        pairs, slot = pairs[at], slot[at]
        found, counts = np.unique(pairs, return_counts=True)
        frequent = counts >= min_count
        least = max(1, min_saving * len(seq))
        if counts[frequent].sum() < least:  # overlaps can only lower what a round saves
            break
        found = found[frequent]
        # a table of hashed pairs finds the rule of each place; pairs that share a slot but one wait for the next round
        table = np.zeros(1 << 18, np.int32)
        table[_slots(found)] = np.arange(len(found))
        rule = table[slot]
        fits = found[rule] == pairs
        at, rule = at[fits], rule[fits]
        # of neighbouring places, every second one from the left
        run = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
        odd = np.repeat((run & 1).astype(np.uint8), np.diff(np.append(run, len(at))))
        odd[1::2] ^= 1
        kept = np.flatnonzero(odd == 0)
        at, rule = at[kept], rule[kept]
        if len(at) < least:
            break
        taken = np.zeros(len(found), bool)
        taken[rule] = True
        used, number = np.flatnonzero(taken), (np.cumsum(taken) - 1)[rule]
        made = np.stack([found[used] >> np.uint64(32), found[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        known = np.concatenate(lengths)
        rules.append(made)
        lengths.append(np.where(made < base, 1, known[np.maximum(made.astype(np.int64) - base, 0)] if len(known) else 1).sum(1))
        seq[at] = (top + number).astype(np.uint64)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        top += len(used)
    return seq.astype(np.uint32), np.concatenate(rules), np.concatenate(lengths)


def _runs(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    parts = [flat[:0]]
    for a in range(0, len(starts), WORDS_AT_ONCE):
        count = counts[a : a + WORDS_AT_ONCE]
        reach = np.cumsum(count)
        parts.append(flat[np.repeat(starts[a : a + WORDS_AT_ONCE] - (reach - count), count) + np.arange(reach[-1])])
    return np.concatenate(parts)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for. Each rule among them is expanded once."""
    big = np.flatnonzero(symbols >= base)
    rule = symbols[big].astype(np.int64) - base
    used = np.zeros(len(rules), bool)
    used[rule] = True
    seq = np.flatnonzero(used) + base
    counts = np.ones(len(symbols), np.int64)
    counts[big] = lengths[rule]
    starts = np.arange(len(symbols))
    starts[big] = len(symbols) + (np.cumsum(lengths * used) - lengths)[rule]
    while len(seq) and seq.max() >= base:
        at = np.flatnonzero(seq >= base)
        width = np.ones(len(seq), np.int64)
        width[at] = 2
        first = np.cumsum(width) - width
        out = np.empty(len(seq) + len(at), np.int64)
        out[first] = seq
        out[first[at]], out[first[at] + 1] = rules[seq[at] - base].T
        seq = out
    return _runs(np.concatenate([symbols.astype("<u4"), seq.astype("<u4")]), starts, counts)


def _packed(symbols: np.ndarray, width: int) -> bytes:
    """The lower 16 bits of all symbols, then one plane for each higher bit."""
    planes = [np.packbits((symbols >> b) & 1 == 1).tobytes() for b in range(16, width)]
    return b"".join([symbols.astype("<u2").tobytes(), *planes])


def _unpacked(body: bytes, n: int, width: int) -> np.ndarray:
    out = np.frombuffer(body, "<u2", n).astype(np.uint32)
    size = -(-n // 8)
    for k, b in enumerate(range(16, width)):
        out |= np.unpackbits(np.frombuffer(body, np.uint8, size, 2 * n + k * size), count=n).astype(np.uint32) << np.uint32(b)
    return out


def block_bytes(ids: np.ndarray, base: int) -> bytes:
    symbols, rules, lengths = repair(ids, base)
    width = max(16, int(base + len(rules)).bit_length())
    body = zlib.compress(rules.astype("<u4").tobytes() + lengths.astype("<u4").tobytes(), 1)
    body = struct.pack("<I", len(body)) + body + _packed(symbols, width)
    return struct.pack(_HEAD, len(ids), base, len(rules), len(symbols), width, len(body)) + body


class ShardFile:
    """Reads a shard: its documents, and the ids of any range of tokens."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size, end = self.file.size(), struct.calcsize(_TRAILER)
        length, n_docs, n_blocks, magic = struct.unpack(_TRAILER, self.file.read_at(end, size - end))
        if magic != _MAGIC:
            raise ValueError(f"{uri} is no token shard")
        tail = zlib.decompress(self.file.read_at(length, size - end - length))
        numbers = np.frombuffer(tail, "<i8", 2 * n_docs + 2 * n_blocks + 1)
        self.ids = numbers[:n_docs]
        self.starts = numbers[n_docs : 2 * n_docs]
        self.places = numbers[2 * n_docs : 2 * n_docs + n_blocks]
        self.first = numbers[2 * n_docs + n_blocks :]  # first token of each block, and the number of tokens
        self.null = np.frombuffer(tail, np.uint8, n_docs, numbers.nbytes).astype(bool)

    def close(self) -> None:
        self.file.close()

    @property
    def ends(self) -> np.ndarray:
        return np.append(self.starts[1:], self.first[-1])[: len(self.starts)]

    def block(self, k: int):
        """Symbols, rules, lengths and base of a block."""
        head = struct.calcsize(_HEAD)
        _, base, n_rules, n_symbols, width, size = struct.unpack(_HEAD, self.file.read_at(head, int(self.places[k])))
        body = self.file.read_at(size, int(self.places[k]) + head)
        (packed,) = struct.unpack_from("<I", body)
        numbers = np.frombuffer(zlib.decompress(body[4 : 4 + packed]), "<u4")
        return _unpacked(body[4 + packed :], n_symbols, width), numbers[: 2 * n_rules].reshape(-1, 2), numbers[2 * n_rules :], base

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """The ids of tokens ``lo`` to ``hi`` (without): of each block only the symbols that cover them are expanded."""
        out = [np.empty(0, "<u4")]
        for k in range(int(np.searchsorted(self.first, lo, "right")) - 1, len(self.places)):
            if self.first[k] >= hi:
                break
            symbols, rules, lengths, base = self.block(k)
            wide = symbols.astype(np.int64)
            size = np.where(wide < base, 1, lengths[np.maximum(wide - base, 0)] if len(lengths) else 1)
            ends = np.cumsum(size)
            a, b = max(0, lo - self.first[k]), min(int(ends[-1]), hi - self.first[k])
            i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b - 1, "right")) + 1
            skip = int(a - (ends[i] - size[i]))
            out.append(expand(symbols[i:j], rules, lengths, base)[skip : skip + b - a])
        return np.concatenate(out)


def _lots(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    lot, size = [], 0
    for text in texts:
        if lot and size + len(text) > ENCODE_BYTES:
            yield lot
            lot, size = [], 0
        lot.append(text)
        size += len(text)
    if lot:
        yield lot


def _written(folder: str, path: str, end_id: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        base = max(encode.tokenizer.get_vocab_size(), end_id + 1)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        sink, uri = None, f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.rpt"
        ids, null, starts, places, first, held = [], [], [], [], [0], bytearray()
        place = tokens = 0

        def flush(n: int) -> None:
            nonlocal place
            data = block_bytes(np.frombuffer(bytes(held[: 4 * n]), "<u4"), base)
            del held[: 4 * n]
            sink.write(data)
            places.append(place)
            first.append(first[-1] + n)
            place += len(data)

        for batch in slices(batches):
            if sink is None and batch.num_rows:
                fs, where = pafs.FileSystem.from_uri(uri)
                sink = fs.open_output_stream(where, compression=None)
            numbers = iter(batch.column(0).to_pylist())
            for texts in _lots(utf8(batch.column(1))):
                for found in encode(texts):
                    doc_id = next(numbers)
                    ids.append(doc_id or 0)
                    null.append(doc_id is None)
                    starts.append(tokens)
                    tokens += len(found) // 4 + 1
                    held += found + end
                    while len(held) >= 4 * block:
                        flush(block)
        if sink is None:
            return
        if held:
            flush(len(held) // 4)
        tail = zlib.compress(np.array([*ids, *starts, *places, *first], "<i8").tobytes() + np.array(null, np.uint8).tobytes(), 1)
        sink.write(tail)
        sink.write(struct.pack(_TRAILER, len(tail), len(ids), len(places), _MAGIC))
        sink.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "uri": [uri], "docs": pa.array([len(ids)], pa.int64()),
                                          "tokens": pa.array([tokens], pa.int64()), "bytes": pa.array([place], pa.int64())})
    return run


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block: int = BLOCK_TOKENS) -> DataFrame:
    """Write the shards of ``docs`` (``doc_id``, ``text``) in the shared
    folder; the manifest: ``part, uri, docs, tokens, bytes`` and ``before``, the tokens of all shards before."""
    spark = docs.sparkSession
    folder = make_folder(spark, "token-shards")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sorted_rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = write_table(spark, sorted_rows.mapInArrow(
        _written(folder, tokenizer, end_id, block), "part long, uri string, docs long, tokens long, bytes long"), "manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    return manifest.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = ShardFile(uri)
            ends, crcs = shard.ends, np.zeros(len(shard.ids), np.int64)
            for k in range(len(shard.places)):
                symbols, rules, lengths, base = shard.block(k)
                data = memoryview(expand(symbols, rules, lengths, base).tobytes())
                lo, hi = int(shard.first[k]), int(shard.first[k + 1])
                a = int(np.searchsorted(ends, lo, "right"))
                b = int(np.searchsorted(shard.starts, hi))
                for d in range(a, b):
                    cut = data[4 * max(0, int(shard.starts[d]) - lo) : 4 * (min(hi, int(ends[d])) - lo)]
                    crcs[d] = zlib.crc32(cut, int(crcs[d]))
            shard.close()
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(shard.ids, mask=shard.null), "start": pa.array(shard.starts + before),
                "n_tokens": pa.array(ends - shard.starts), "ids_crc32": pa.array(crcs)})


def read_shards(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, decoded from the files of a manifest."""
    n = max(1, manifest.count())
    return manifest.select("uri", "before").repartitionByRange(n, "uri").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")
