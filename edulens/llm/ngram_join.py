"""N-gram Jaccard join: a blocked sparse product of the document by shingle matrix.

Documents are sets of 5-word shingles (hashed to 64 bits). Two documents link
when their Jaccard similarity reaches a threshold. Equal sets form one class,
so copies are never compared with each other.

1. *Bound by size.* A document of n shingles links only to one that shares at
   least ``ceil(t n)`` of them. In one fixed order of all shingles, the first
   ``n - ceil(t n) + k`` of both documents then share at least k (k is a
   fifth of the set). Only these are exchanged first. A class survives when
   enough of them occur in another class.
2. The full sets of the survivors are exchanged. Each scan task reads which of
   its file's rows survive, so no text is shuffled. A class goes on when
   ``ceil(t n)`` of its shingles occur in another survivor; the others have no
   partner. Its *keys* are the rarest shingles, as many as the bound asks for.
3. Classes that share keys form clusters. A cluster is cut in blocks of rows of
   similar set size. Each pair of blocks that the sizes allow is multiplied in
   one task: overlap counts accumulate over columns, rare ones first, and rows
   whose best possible overlap falls below the bound leave.
4. Each product returns a star per local component and link counts per class,
   never the pairs. Stars of all products are joined to components.

No step holds a group as a whole: shingles travel as packed arrays dealt by
hash, where a task sends a shingle at most once for each slice of rows, and hot
clusters are split in blocks. The work of step 3 grows with the square of the
number of *different* near copies in a cluster, as every pair must be decided.

Null or empty texts and texts without words have no shingles, keep their own
``doc_id`` as component and link to nothing. Rows with a null ``doc_id`` take
part; the smallest ``doc_id`` ignores nulls. Repeated rows are rows of their
own. Extra columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RowsByFile, row_position, slices, utf8, without_rows, write_by_file, write_table
from .graph import components
from .words import U, mixed, shingle_set

WORDS = 5
THRESHOLD = 80  # per cent
BLOCK_ROWS = 1024
BLOCK_ENTRIES = 2_000_000
#: One in so many shingles of a set is exchanged beyond the bound. Shingles that
#: are shared by chance grow more common with the corpus; as more have to be
#: shared, documents without a partner still go early.
EXTRA = 5
#: Shingles that a task of the exchange holds, about.
RANGE_ENTRIES = 2_000_000


def least_overlap(n: int, threshold: int) -> int:
    """Shingles that a set of ``n`` shares with any partner, at least."""
    return -(-threshold * n // 100)


def _extra(n: int) -> int:
    return max(1, n // EXTRA)


def prefix_length(n: int, threshold: int) -> int:
    return min(n, n - least_overlap(n, threshold) + _extra(n))


def _six(hashes: np.ndarray) -> bytes:
    """The lower 48 bits of each hash."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _fingerprints(words: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, classes, prefixes = [], [], []
            for text in utf8(batch.column(3)):
                s = shingle_set(text, words)
                sizes.append(len(s))
                classes.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                               if len(s) else None)
                prefixes.append(_six(s[: prefix_length(len(s), threshold)]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(prefixes, pa.binary())],
                ["doc_id", "file", "row", "n_shingles", "class", "prefix"])
    return run


def _deal(classes: np.ndarray, sets: list[np.ndarray], ranges: int, pack) -> pa.RecordBatch:
    """Entries of the incidence matrix, one packed row for each range of hashes."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes = np.concatenate(sets) if sets else np.empty(0, U)
    to = mixed(hashes & U(0xFFFFFFFFFFFF)) % U(ranges)
    order = np.argsort(to, kind="stable")
    owner, hashes, to = owner[order], hashes[order], to[order]
    at = np.searchsorted(to, np.arange(ranges + 1, dtype=U))
    out: list[list] = [[], [], [], []]
    for r in np.flatnonzero(at[1:] > at[:-1]):
        lo, hi = at[r], at[r + 1]
        own, local = np.unique(owner[lo:hi], return_inverse=True)
        for column, value in zip(out, (int(r), pack(hashes[lo:hi]), local.astype("<u2").tobytes(),
                                       classes[own].astype("<i8").tobytes()), strict=True):
            column.append(value)
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                      ["range", "hashes", "owners", "classes"])


_DEALT = "range int, hashes binary, owners binary, classes binary"


def _deal_prefixes(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            classes, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            packed = batch.column(1).take(pa.array(first)).to_pylist()
            yield _deal(classes, [_from_six(p) for p in packed], ranges, _six)
    return run


def _deal_texts(wanted: RowsByFile, words: int, ranges: int):
    """Entries of the wanted rows of ``file, row, text``; other texts are passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, classes = wanted.among(batch.column(0), batch.column(1))
            sets = [shingle_set(t, words) for t in utf8(batch.column(2).take(pa.array(at)))]
            yield _deal(classes, sets, ranges, lambda h: h.astype("<u8").tobytes())
    return run


def _entries(table: pa.Table, unpack) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, class) entries of a range that several classes share,
    in that order, and the number of classes that have the entry's hash."""
    hashes, classes = [], []
    for h, o, c in zip(*(table.column(k).to_pylist() for k in ("hashes", "owners", "classes")), strict=True):
        hashes.append(unpack(h))
        classes.append(np.frombuffer(c, "<i8")[np.frombuffer(o, "<u2")])
    h, c = np.concatenate(hashes), np.concatenate(classes)
    order = np.lexsort((c, h))
    h, c = h[order], c[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    h, c = h[new], c[new]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    count = np.diff(np.r_[starts, len(h)])
    df = np.repeat(count, count)
    return h[df > 1], c[df > 1], df[df > 1]


def _count_shared(buckets: int):
    """How many entries of a range each class shares, packed by bucket of classes."""
    def run(table: pa.Table) -> pa.Table:
        _, classes, _ = _entries(table, _from_six)
        found, n = np.unique(classes, return_counts=True)
        to = mixed(found.view(U)) % U(buckets)
        order = np.argsort(to, kind="stable")
        found, n, to = found[order], n[order], to[order]
        at = np.searchsorted(to, np.arange(buckets + 1, dtype=U))
        used = np.flatnonzero(at[1:] > at[:-1])
        return pa.table({"bucket": pa.array(used, pa.int32()),
                         "classes": pa.array([found[at[k] : at[k + 1]].astype("<i8").tobytes() for k in used], pa.binary()),
                         "counts": pa.array([n[at[k] : at[k + 1]].astype("<i4").tobytes() for k in used], pa.binary())})
    return run


def _sum_shared(table: pa.Table) -> pa.Table:
    classes, counts = (np.frombuffer(b"".join(table.column(k).to_pylist()), kind) for k, kind in (("classes", "<i8"), ("counts", "<i4")))
    found, inverse = np.unique(classes, return_inverse=True)
    return pa.table({"class": pa.array(found, pa.int64()), "shared": pa.array(np.bincount(inverse, counts, len(found)).astype(np.int64))})


def _list_shared(table: pa.Table) -> pa.Table:
    h, c, df = _entries(table, lambda b: np.frombuffer(b, "<u8"))
    order = np.argsort(c, kind="stable")
    h, c, df = h[order], c[order], np.minimum(df[order], 255).astype(np.uint8)  # an order is all that the keys need
    found, at = np.unique(c, return_index=True)
    ends = np.r_[at[1:], len(c)]
    return pa.table({"class": pa.array(found, pa.int64()),
                     "hashes": pa.array([h[a:b].astype("<u8").tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()),
                     "counts": pa.array([df[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())})


def _keys(threshold: int):
    """Of each class: its shared shingles, rarest first, and its keys. A class
    that shares too few of its shingles has no partner and goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sets, keys = [], [], []
            for i, (n, parts) in enumerate(zip(batch.column("n_shingles").to_pylist(), batch.column("parts").to_pylist(),
                                               strict=True)):
                h = np.frombuffer(b"".join(p["hashes"] for p in parts), "<u8")
                if len(h) < (need := least_overlap(n, threshold)):
                    continue
                df = np.frombuffer(b"".join(p["counts"] for p in parts), np.uint8)
                h = h[np.lexsort((h, df))]
                keep.append(i)
                sets.append(h.tobytes())
                keys.append(h[: len(h) - need + 1].view("<i8"))
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("class"), rows.column("n_shingles"), rows.column("members"), pa.array(sets, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["class", "n_shingles", "members", "hashes", "keys"])
    return run


def _expand(a_rows, a_cols, b_rows, b_cols, n_b: int, out: np.ndarray) -> None:
    """Add the products of sparse columns; entries are sorted by column."""
    lo, hi = np.searchsorted(b_cols, a_cols), np.searchsorted(b_cols, a_cols, "right")
    reach = np.cumsum(hi - lo)
    at = 0
    while at < len(a_cols):
        done = reach[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(reach, done + 4_000_000, "right")))
        n = (hi - lo)[at:end]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs = np.repeat(a_rows[at:end], n) * n_b + b_rows[np.repeat(lo[at:end], n) + offset]
        out += np.bincount(pairs, minlength=out.size).reshape(out.shape)
        at = end


def overlaps(a: list[np.ndarray], b: list[np.ndarray], need: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``;
    below ``need`` a count may be too small. Sparse columns are expanded, dense
    ones multiplied in chunks; rows whose best case is below the bound leave."""
    shape = (len(a), len(b))
    total = np.zeros(shape, np.float32)
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b)]
    flat = [np.concatenate([*s, np.empty(0, U)]) for s in (a, b)]
    ids, cols = np.unique(np.concatenate(flat), return_inverse=True)
    cols = [cols[: len(flat[0])], cols[len(flat[0]):]]
    seen = [np.bincount(c, minlength=len(ids)) for c in cols]
    weight = seen[0] * seen[1]
    dense = weight * 100 > total.size if total.size > 4096 else weight > 0
    sparse = (weight > 0) & ~dense
    if sparse.any():
        pick = [np.flatnonzero(sparse[c]) for c in cols]
        pick = [p[np.argsort(c[p], kind="stable")] for p, c in zip(pick, cols, strict=True)]
        _expand(rows[0][pick[0]], cols[0][pick[0]], rows[1][pick[1]], cols[1][pick[1]], len(b), total)
    order = np.flatnonzero(dense)
    order = order[np.argsort(weight[order], kind="stable")]
    place = np.full(len(ids), -1)
    place[order] = np.arange(len(order))
    spots = [place[c] for c in cols]
    left = [np.bincount(r[s >= 0], minlength=n) for r, s, n in zip(rows, spots, shape, strict=True)]
    alive = [np.arange(n) for n in shape]
    step = 1024
    for at in range(0, len(order), step):
        width, chunk = min(step, len(order) - at), []
        for side in (0, 1):
            entry = np.flatnonzero((spots[side] >= at) & (spots[side] < at + step))
            x = np.zeros((shape[side], width), np.float32)
            x[rows[side][entry], spots[side][entry] - at] = 1
            left[side] = left[side] - x.sum(1).astype(np.int64)
            chunk.append(x[alive[side]])
        total[np.ix_(*alive)] += chunk[0] @ chunk[1].T
        if at + step < len(order):
            best = total[np.ix_(*alive)] + np.minimum(left[0][alive[0]][:, None], left[1][alive[1]][None, :])
            may = best >= need[np.ix_(*alive)]
            alive = [alive[0][may.any(1)], alive[1][may.any(0)]]
            if not len(alive[0]):
                break
    return total.astype(np.int64)


def _local_roots(link: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column reaches."""
    most = np.iinfo(np.int64).max
    while True:
        a_new = np.minimum(a_ids, np.where(link, b_ids[None, :], most).min(1, initial=most))
        b_new = np.minimum(b_ids, np.where(link, a_new[:, None], most).min(0, initial=most))
        if (a_new == a_ids).all() and (b_new == b_ids).all():
            return a_ids, b_ids
        a_ids, b_ids = a_new, b_new


def _no_links() -> pa.Table:
    return pa.table({name: pa.array([], pa.int64()) for name in ("class", "root", "links")})


def _product(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        classes, n, members = (table.column(k).to_numpy() for k in ("class", "n_shingles", "members"))
        sets = [np.frombuffer(h, "<u8") for h in table.column("hashes").to_pylist()]
        a = np.flatnonzero(side == 0)
        i, j, across = (table.column(k)[0].as_py() for k in ("i", "j", "across"))
        same = i == j and not across
        b = a if same else np.flatnonzero(side == 1)
        if not len(a) or not len(b):  # a block that no class was dealt to
            return _no_links()
        sizes = n[a][:, None] + n[b][None, :]
        need = -(-threshold * sizes // (100 + threshold))
        count = overlaps([sets[i] for i in a], [sets[i] for i in b], need)
        link = 100 * count >= threshold * (sizes - count)
        if same:
            np.fill_diagonal(link, False)
        a_root, b_root = _local_roots(link, classes[a], classes[b])
        out = [(classes[a], a_root, link @ members[b])]
        if not same:
            out.append((classes[b], b_root, link.T @ members[a]))
        vertex, root, links = (np.concatenate(x) for x in zip(*out, strict=True))
        keep = links > 0
        return pa.table({"class": pa.array(vertex[keep], pa.int64()), "root": pa.array(root[keep], pa.int64()),
                         "links": pa.array(links[keep], pa.int64())})
    return run


def _blocks(clustered: DataFrame) -> DataFrame:
    """The block products that each class (``cluster, class, n_shingles,
    entries``) takes part in. A cluster
    that fits one block is one product. Else rows are cut by the band of their
    set size (a band is a factor of 1.25 wide) and a hash; a block meets the
    blocks of its own band and of the two next to it, as sizes further apart
    cannot link."""
    limit = lambda rows, entries: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(entries / BLOCK_ENTRIES)).cast("int")
    banded = clustered.withColumn("band", F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1.25))).cast("int"))
    bands = (banded.groupBy("cluster", "band")
             .agg(F.count(F.lit(1)).alias("rows"), F.sum("entries").alias("entries")))
    whole = (bands.groupBy("cluster").agg(limit(F.sum("rows"), F.sum("entries")).alias("parts"))
             .withColumn("single", F.col("parts") <= 1).select("cluster", "single"))
    sized = bands.select("cluster", "band", limit(F.col("rows"), F.col("entries")).alias("cuts"))
    near = [sized.select("cluster", (F.col("band") - d).alias("band"), F.col("cuts").alias(name))
            for d, name in ((0, "own"), (1, "above"), (-1, "below"))]
    plan = near[0]
    for other in near[1:]:
        plan = plan.join(other, ["cluster", "band"], "left")
    plan = plan.join(whole, "cluster").na.fill(0, ["above", "below"])
    rows = banded.join(plan.hint("merge"), ["cluster", "band"]).withColumn("cut", F.pmod(F.xxhash64("class"), F.col("own")).cast("int"))
    meets = F.expr("""case when single then array(struct(0 as lo, 0 as i, 0 as j, false as across, 0 as side))
        else concat(
          transform(sequence(0, own - 1), x -> struct(band as lo, least(cut, x) as i, greatest(cut, x) as j, false as across,
                                                      if(cut <= x, 0, 1) as side)),
          if(above > 0, transform(sequence(0, above - 1), x -> struct(band as lo, cut as i, x as j, true as across, 0 as side)), array()),
          if(below > 0, transform(sequence(0, below - 1), x -> struct(band - 1 as lo, x as i, cut as j, true as across, 1 as side)), array()))
        end""")
    return rows.select("cluster", "class", F.explode(meets).alias("at")).select("cluster", "at.*", "class")


def joined(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame, str, str]:
    """One row per row of ``docs`` (``doc_id, file, row, n_shingles, class,
    root, component_id, n_links``), and the positioned documents with the names
    of their position columns. ``root`` names the component, null for none."""
    placed, file, row = row_position(docs)
    text = placed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(file).alias("file"), F.col(row).alias("row"),
                         F.col("text").alias("text"))
    prints = write_table(spark, text.mapInArrow(_fingerprints(words, threshold),
                                                "doc_id long, file string, row long, n_shingles long, class long, prefix binary"),
                         "prints")
    classes = write_table(spark, prints.where("class is not null").groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("least"),
        F.min(F.struct("file", "row")).alias("one")), "classes")

    entries = prints.agg(F.sum(F.octet_length("prefix") / 6)).first()[0] or 0
    ranges = max(4, int(entries // RANGE_ENTRIES))
    shared = (prints.where("class is not null").select("class", "prefix").mapInArrow(_deal_prefixes(ranges), _DEALT)
              .groupBy("range").applyInArrow(_count_shared(ranges), "bucket int, classes binary, counts binary")
              .groupBy("bucket").applyInArrow(_sum_shared, "class long, shared long"))
    wanted = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n_shingles") * threshold / 100) / EXTRA))
    survivors = write_table(spark, shared.join(classes, "class").where(F.col("shared") >= wanted), "survivors")

    entries = survivors.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = max(4, int(entries // RANGE_ENTRIES))
    wanted = write_by_file(spark, survivors.select("one.file", "one.row", F.col("class").alias("value")), "wanted")
    parts = (text.select("file", "row", "text").mapInArrow(_deal_texts(wanted, words, ranges), _DEALT)
             .groupBy("range").applyInArrow(_list_shared, "class long, hashes binary, counts binary")
             .groupBy("class").agg(F.collect_list(F.struct("hashes", "counts")).alias("parts")))
    rows = write_table(spark, parts.join(survivors.hint("merge"), "class").select("class", "n_shingles", "members", "parts")
                       .mapInArrow(_keys(threshold), "class long, n_shingles long, members long, hashes binary, keys array<long>"),
                       "rows")

    keys = rows.select("class", F.explode("keys").alias("key"))
    lead = keys.groupBy("key").agg(F.min("class").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    near = keys.join(lead.hint("merge"), "key").select(F.col("class").alias("a"), F.col("lead").alias("b")).where("a <> b").distinct()
    clusters = components(spark, near).select(F.col("vertex").alias("class"), F.col("root").alias("cluster"))
    # joins of what grows with the data are merge joins at any size, so that plans do not change with it
    small = rows.select("class", "n_shingles", (F.octet_length("hashes") / 8).alias("entries"))
    blocks = _blocks(small.join(clusters.hint("merge"), "class"))
    found = write_table(spark, rows.drop("keys").join(blocks.hint("merge"), "class")
                        .groupBy("cluster", "lo", "i", "j", "across")
                        .applyInArrow(_product(threshold), "class long, root long, links long"), "links")

    roots = components(spark, found.select(F.col("class").alias("a"), F.col("root").alias("b"))) \
        .select(F.col("vertex").alias("class"), "root")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    of_class = classes.join(roots, "class", "left").join(links, "class", "left").select(
        "class", F.coalesce("root", "class").alias("root"), "least", "members", "links")
    least = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = write_table(spark, of_class.join(least, "root").select(
        "class", "root", "component_id", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links")), "of_class")

    columns = ["doc_id", "file", "row", "n_shingles", "class", "root", "component_id", "n_links"]
    none = prints.where("class is null").select(
        "doc_id", "file", "row", "n_shingles", "class", F.lit(None).cast("long").alias("root"),
        F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    some = prints.where("class is not null").drop("prefix").join(of_class, "class").select(*columns)
    return some.union(none.select(*columns)), placed, file, row


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of each row of ``docs``
    (``doc_id``, ``text``); ``n_links`` counts the other rows that link to it."""
    out, *_ = joined(spark, docs, words, threshold)
    return out.select("doc_id", "n_shingles", "component_id", "n_links")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest
    ``doc_id`` (nulls last), then the first by place in the files. Rows without
    shingles all stay."""
    out, placed, file, row = joined(spark, docs, words, threshold)
    out = write_table(spark, out.where("root is not null").select("root", "doc_id", "file", "row"), "grouped")
    first = out.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias("first"))
    gone = write_by_file(spark, out.join(first, "root").where("file <> first.file or row <> first.row")
                         .select("file", "row", F.lit(0).cast("long").alias("value")), "gone")
    return without_rows(placed, file, row, gone, docs)
