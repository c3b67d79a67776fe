"""Steps that go level by level: schedules of many sources, differencing of
many lots, sums of many tasks; and the schedule and verdicts from their definitions."""

import math
import random
import zlib

import numpy as np
import pytest
from edulens.llm import mixing, quality, sharding, toxicity, warc_index
from pyspark.sql import functions as F


def plain_edf(blocks):
    """Slots of each source of one period, by the definition."""
    period, done, slots = sum(blocks), [0] * len(blocks), [[] for _ in blocks]
    for t in range(period):
        due = [(-(-(done[i] + 1) * period // c), i) for i, c in enumerate(blocks) if done[i] < c and done[i] * period // c <= t]
        i = min(due)[1]
        slots[i].append(t)
        done[i] += 1
    return slots


@pytest.mark.parametrize("blocks", [[1], [3, 3, 3], [7, 1, 2, 2, 1], [40, 1, 1, 9, 9, 30, 2], [5] * 9 + [60]])
def test_period_equals_plain_schedule(spark, blocks):
    weights = spark.createDataFrame([(f"s{i:02d}", c) for i, c in enumerate(blocks)], "source string, blocks int")
    got = mixing.one_period(weights).orderBy("source", "place").collect()
    slots = plain_edf(blocks)
    assert [(r["source"], r["place"], r["slot"]) for r in got] == [(f"s{i:02d}", k, t) for i, s in enumerate(slots) for k, t in enumerate(s)]


def test_fractional_weights_by_largest_remainders(spark):
    weights = [("big", 1000.0), *((f"s{i:02d}", 10.5) for i in range(19)), ("none", None), ("zero", 0.0)]
    (level,) = mixing.schedule(spark.createDataFrame(weights, "source string, blocks double"))
    got = {r["node"]: (r["blocks"], r["period"]) for r in level.collect()}
    total = 1000 + 19 * 10.5
    assert len(got) == 20 and sum(b for b, _ in got.values()) == mixing.MAX_PERIOD
    for s, w in weights[:20]:
        assert abs(got["1" + s][0] - w / total * mixing.MAX_PERIOD) < 1


def test_whole_weights_are_the_blocks(spark):
    rows = [("a", 5), ("b", 3), (None, 2), ("b", 1)]  # rows of one source are added
    (level,) = mixing.schedule(spark.createDataFrame(rows, "source string, blocks int"))
    assert {r["node"]: (r["blocks"], r["period"]) for r in level.collect()} == {"1a": (5, 11), "1b": (4, 11), "0": (2, 11)}


def test_many_sources_in_bundles(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)
    monkeypatch.setattr(mixing, "MAX_PERIOD", 64)
    rng = random.Random(2)
    names = [f"s{i:02d}" for i in range(60)] + [None]
    weight = {s: rng.choice([1, 1, 2, 3, 5]) for s in names} | {"s07": 300, "s08": 90}
    rows = [(i, s) for i, s in enumerate(rng.choices(names, [weight[s] for s in names], k=4000))]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    weights = spark.createDataFrame(list(weight.items()), "source string, blocks int")
    levels = [{r["node"]: r for r in t.collect()} for t in mixing.schedule(weights)]
    assert len(levels) > 2
    got = mixing.mix(docs, weights, block_rows=1).collect()
    assert sorted((r["doc_id"], r["source"]) for r in got) == sorted(rows)
    assert len({r["slot"] for r in got}) == len(got)
    for s in names:
        node, rate, bound = "0" if s is None else "1" + s, 1.0, 0.0
        for level in levels:
            of = level[node]
            if of["blocks"] < of["period"]:
                bound += rate  # less than one block of each bundle on the way, in the source's blocks
            node, rate = of["bundle"], rate
            rate = rate * of["blocks"] / of["period"]
        # from the whole down: a source's blocks are off by one, and by its share of what its bundle is off
        path, node = [], "0" if s is None else "1" + s
        for level in levels:
            path.append(level[node]["blocks"] / level[node]["period"])
            node = level[node]["bundle"]
        off = 0.0
        for share in reversed(path):
            off = off * share + (1 if share < 1 else 0)
        slots = sorted(r["slot"] for r in got if r["source"] == s)
        assert all(k - off <= t * math.prod(path) and (t + 1) * math.prod(path) <= k + 1 + off for k, t in enumerate(slots)), s
    heavy = [r for r in got if r["source"] == "s07"]  # alone on every level: within the windows of one block
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in heavy)


def test_rows_without_weight_have_no_slot(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, source string").repartition(1)
    weights = spark.createDataFrame([("a", 1.5), ("b", 0.0)], "source string, blocks double")
    assert {r["doc_id"]: r["slot"] for r in mixing.mix(docs, weights).collect()} == {1: 0, 2: None, 3: None}


def test_differencing_in_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LOT", 100)
    monkeypatch.setattr(sharding, "FAN", 3)
    monkeypatch.setattr(sharding, "SMALL", 2)
    rng = random.Random(3)
    texts = ["x" * rng.randint(0, 60) + str(i % 370) for i in range(600)] + ["hot"] * 750 + [None, ""]  # one group of almost a shard
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = sharding.shard_by_bytes(docs, shards=4).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == [
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)]
    home, size = {}, [0] * 4
    for r in got:
        home.setdefault(texts[r["doc_id"]] or "", set()).add(r["shard"])
        size[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in home.values())
    assert 750 * 11 > 0.7 * sum(size) / 4 and max(size) - min(size) < 0.02 * sum(size)
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_sums_in_levels(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FAN", 3)
    rng = np.random.default_rng(1)
    parts = rng.integers(0, 9, (20, 2, 5))
    rows = [(r, bytearray(parts[p, r].astype("<i8").tobytes()), p) for p in range(20) for r in range(2)]
    got = toxicity._levels(spark.createDataFrame(rows, "range int, packed binary, part int")).collect()
    assert {r["range"]: np.frombuffer(r["packed"], "<i8").tolist() for r in got} == {r: parts[:, r].sum(0).tolist() for r in range(2)}
    assert toxicity._levels(spark.createDataFrame([], "range int, packed binary, part int")).count() == 0


def test_kept_rows_are_the_judged_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("__row", F.lit(1))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}


def test_posterior_from_its_definition():
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, 3**quality.N_RULES, 40))
    counts = rng.integers(1, 500, len(codes)).astype(float)
    good, rate = quality.fit(codes, counts)
    # plain expectation and maximisation, a pattern at a time
    weight = max(10.0, counts.sum() / 100)
    p_good, p = 0.9, [[0.6] * quality.N_RULES, [0.01] * quality.N_RULES]
    said = [[int(c) // 3**r % 3 for r in range(quality.N_RULES)] for c in codes]
    for _ in range(4000):
        post = []
        for v in said:
            likely = [(1 - p_good), p_good]
            for k in (0, 1):
                for r, x in enumerate(v):
                    likely[k] *= p[k][r] if x == 1 else 1 - p[k][r] if x == 2 else 1
            post.append(likely[1] / sum(likely))
        new = []
        for k, prior, strength in ((0, 0.6, weight * 0.1), (1, 0.01, weight * 0.9)):
            mass = [n * (q if k else 1 - q) for n, q in zip(counts, post)]
            new.append([(sum(m for m, v in zip(mass, said) if v[r] == 1) + strength * prior)
                        / (sum(m for m, v in zip(mass, said) if v[r]) + strength) for r in range(quality.N_RULES)])
        new_good = (sum(n * q for n, q in zip(counts, post)) + weight * 0.9) / (counts.sum() + weight)
        moved = max(abs(new_good - p_good), max(abs(a - b) for x, y in zip(new, p) for a, b in zip(x, y)))
        p_good, p = new_good, new
        if moved < 1e-10:
            break
    assert abs(good - p_good) < 1e-5 and np.abs(rate - np.array(p)).max() < 1e-5
    assert np.abs(quality.posterior(codes, good, rate) - np.array(post)).max() < 1e-4


def test_lookups_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc_index, "INDEX_ROWS", 40)
    monkeypatch.setattr(warc_index, "LOOKUP_ROWS", 25)
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    folder, captures = warc_index.write_archives(pages)
    top = warc_index.write_index(folder, captures)
    assert len(top) > 1
    got = warc_index.lookup(pages, folder, top).collect()
    sizes = {r["page_id"]: len((r["html"] or "").encode()) for r in pages.select("page_id", F.col("html").cast("string").alias("html")).collect()}
    assert {r["page_id"]: r["payload_bytes"] for r in got} == sizes and len(got) == len(sizes)
