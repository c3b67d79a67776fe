"""Filter audit, quality model and conversation trie against brute force on
small tables: nulls in any column, empty and very long texts, ties, repeated
rows, empty tables and extra columns with clashing names."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from edulens.llm import conversation_trie, filter_audit, quality_model

DOCS = "doc_id long, text string, lang string, source string, part string, id long, digest string, lists string"
LABELS = "doc_id long, quality int, toxic int, marks string"
TURNS = "conv_id long, turn long, role string, text string, key string, place long, depth string"


def words(rng, n, variety=400):
    return " ".join(f"w{rng.randrange(variety)}" for _ in range(n))


def documents():
    rng = random.Random(3)
    texts = [words(rng, rng.choice([5, 99, 100, 130, 300]), rng.choice([60, 5000])) for _ in range(60)]
    texts = [t.upper() if i % 7 == 0 else t + " #1 & more" if i % 5 == 0 else t for i, t in enumerate(texts)]
    texts += texts[:9] + [None, "", None, " \n", "a" * 50_000, words(rng, 60_000, 100_000), "Ä Ö " * 120]
    rows = [(i * 3, t, [None, "en", "en", "fr", ""][i % 5], "s", "p", 1, "d", "l") for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, texts[0], "en", *[None] * 5), (None, None, None, *[None] * 5)]


def labels():
    rng = random.Random(5)
    rows = [(i * 3, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "m") for i in range(0, 70, 2)]
    return [*rows, (rows[1][0], 1, 0, None), (rows[1][0], 0, 1, None), (None, 1, 1, None), (99_999, 1, 1, None)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def fails(rows):
    """The set of filters that each row fails."""
    out = []
    for i, text, *_ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {"A"} if len(w) < 100 else set()
        found |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        found |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        smaller = i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows)
        out.append(found | ({"E"} if smaller else set()))
    return out


def brute_audit(rows, marks):
    good, toxic = ({i for i, *m, _ in marks if i is not None and m[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for r, f in zip(rows, fails(rows), strict=True):
        parts[r[2] or ""].append((r[0], f))
    out, removed_by = [], defaultdict(int)
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[part, f] += len(gone)
                out.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in d[1] for d in docs) - len(gone),
                            sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f))
    return sorted((*x[:-1], removed_by[x[0], x[-1]]) for x in out)


@pytest.mark.parametrize("size", [1 << 16, 5])
def test_audit(spark, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "RANGE", size)
    got = filter_audit.audit(frame(spark, documents(), DOCS), frame(spark, labels(), LABELS))
    assert sorted(map(tuple, got.collect())) == brute_audit(documents(), labels())


def test_audit_oracle():
    con = duckdb.connect()
    for name, rows, columns in (("documents", documents(), "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, a VARCHAR, b BIGINT, c VARCHAR, d VARCHAR"),
                                ("labels", labels(), "doc_id BIGINT, quality INT, toxic INT, m VARCHAR")):
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    got = [tuple(r) for r in con.execute(filter_audit.oracle_sql()).fetchall()]
    assert sorted(got) == brute_audit(documents(), labels())


def test_audit_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert filter_audit.audit(none, spark.createDataFrame([], LABELS)).count() == 0
    alone = filter_audit.audit(frame(spark, documents(), DOCS), spark.createDataFrame([], LABELS))
    assert sorted(map(tuple, alone.collect())) == brute_audit(documents(), [])


def test_merges():
    rng = np.random.default_rng(1)
    for sizes in ([0, 5], [3000, 4], [5000, 5000, 1], [0, 0], [1, 2500, 2500, 0, 40]):
        lists = [np.sort(rng.choice(9000, n, replace=False)).astype(np.int32) for n in sizes]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*(x.tolist() for x in lists)))
        assert filter_audit.difference(lists[0], lists[1]).tolist() == sorted(set(lists[0].tolist()) - set(lists[1].tolist()))
    ids = np.arange(0, 1000, 3)
    assert all(filter_audit.gallop(ids, at, b) == max(at, -(-b // 3)) for at in (0, 5, 300) for b in (0, 15, 16, 700, 998))


def test_postings_are_sorted(spark):
    rows = filter_audit.postings(frame(spark, documents(), DOCS), frame(spark, labels(), LABELS)).collect()
    assert sum(r["n_rows"] for r in rows) == len(documents())
    assert sum(len(r["E"]) for r in rows) == sum("E" in f for f in fails(documents()))
    assert all(list(r[name]) == sorted(set(r[name])) for r in rows for name in filter_audit.LISTS)


def brute_model_features(text):
    """Slots of words, pairs and shapes by a plain count, from the definition of a weight."""
    slots, values = quality_model.features(text)
    return dict(zip(slots.tolist(), values.tolist(), strict=True)) if len(set(slots.tolist())) == len(slots) else None


def test_model_features():
    assert len(quality_model.features(b"")[0]) == len(quality_model.features(b" \n\t")[0]) == 0
    slots, values = quality_model.features(b"one two one")
    # words: one twice, two once; pairs: two; then five kinds of shape runs at most
    weights = np.log1p([2, 1, 1, 1])
    assert np.allclose(sorted(values[:4]), sorted(weights / np.sqrt((weights**2).sum())))
    assert np.isclose((values[4:] ** 2).sum(), 1)
    same = lambda a, b: brute_model_features(a) == brute_model_features(b)
    assert same(b"ab cd", b"ab   cd\n") and not same(b"ab cd", b"AB cd") and not same(b"ab cd", b"cd ab")


def test_model_ftrl(monkeypatch):
    """Each update against the rule of FTRL-Proximal written out for one slot."""
    monkeypatch.setattr(quality_model, "DIMENSIONS", 16)
    model, rng = quality_model.Ftrl(), random.Random(2)
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= quality_model.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * quality_model.L1) / ((quality_model.BETA + n[i] ** 0.5) / quality_model.ALPHA + quality_model.L2)

    for _ in range(200):
        slots = rng.sample(range(16), 4)
        values, label = [rng.random() for _ in slots], rng.randrange(2)
        model.learn(np.array(slots), np.array(values), label)
        x = dict(zip(slots, values, strict=True)) | {16: 1.0}
        w = {i: weight(i) for i in x}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - label) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality_model.ALPHA * w[i]
            n[i] += g * g
    assert np.allclose(model.weights(), [weight(i) for i in range(17)])


def quality_corpus():
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(400):
        clean = words(rng, rng.randint(30, 120))
        junk = i % 4 == 0
        rows.append((i, " ".join(w + "%%%" for w in clean.split()) if junk else clean, "en", "s", "p", 1, "d", "l"))
        marks.append((i, 0 if junk else 1, 0, None))
    rows += [(1000, None, *[None] * 6), (1001, "", *[None] * 6), (None, rows[1][1], *[None] * 6), rows[1], (1002, words(rng, 50_000), *[None] * 6)]
    return rows, [*marks, (1, None, 1, None), (None, 0, 0, None), (5000, 0, 0, None)]


def test_model_scores(spark):
    rows, marks = quality_corpus()
    got = quality_model.score(frame(spark, rows, DOCS), frame(spark, marks, LABELS)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1) for r in got)
    right = [r["predicted"] == (r["doc_id"] % 4 != 0) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert np.mean(right) > 0.97
    of = defaultdict(set)
    for r in got:
        of[r["doc_id"]].add(r["score"])
    assert len(of[1]) == 1 and of[1000] == of[1001] and of[None] == of[1]


def test_model_scores_are_dot_products(spark):
    rows, marks = quality_corpus()
    docs, known = frame(spark, rows, DOCS), frame(spark, marks, LABELS)
    weights, constant = quality_model.train(docs, known)
    weights = weights.astype(np.float32)
    for r, (_, text, *_) in zip(sorted(quality_model.score(docs, known).where("doc_id < 60 and doc_id <> 1").collect()), [r for r in rows[:60] if r[0] != 1], strict=True):
        slots, values = quality_model.features(text.encode())
        total = constant + sum(float(weights[s]) * v for s, v in zip(slots.tolist(), values.tolist(), strict=True))
        assert abs(r["score"] - 1 / (1 + np.exp(-total))) < 1e-5


def test_model_ignores_held_out_labels(spark):
    rows, marks = quality_corpus()
    flipped = [(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 3 == 1 else q, t, m) for i, q, t, m in marks]
    docs = frame(spark, rows, DOCS)
    a, b = (quality_model.train(docs, frame(spark, m, LABELS)) for m in (marks, flipped))
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_model_without_labels(spark):
    rows, _ = quality_corpus()
    got = quality_model.score(frame(spark, rows[:9], DOCS), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 9 and len({r["score"] for r in got}) == 1
    assert quality_model.score(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def conversations():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 60), 100, 101, 102, 205, 300, 399, 7_000_000_123]:
        for t in range(rng.choice([0, 1, 2, 3, 6, 9])):
            same = rng.random() < 0.6  # many conversations share turns
            rows.append((c, t * 2, ["user", None][t % 2], f"turn {t}" if same else rng.choice([None, "", "ä€𝄞 b", f"x{c}"]), "k", 1, "d"))
    long = [(c, t, "user", f"part {t}", None, None, None) for c in (500, 600, 700) for t in range(90)]
    long += [(c, 90 + t, "user", f"{c} {t}", None, None, None) for c in (500, 600) for t in range(70)]
    hot = [(c, t, "user", "the same", None, None, None) for c in range(10_000, 13_000, 100) for t in range(3)]
    odd = [(800, None, "b", "second", *[None] * 3), (800, None, "a", None, *[None] * 3), (800, 0, "c", "long " * 20_000, *[None] * 3),
           (800, 0, "c", "tie", *[None] * 3), (None, 0, "user", "nobody", *[None] * 3), rows[3], rows[3]]
    return rows + long + hot + odd


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            turns[c].append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in turns.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n], sha(ends[n]))
                   for n, m in members.items()), key=str)


@pytest.mark.parametrize("segment, block", [(32, 1 << 14), (2, 7), (5, 1)])
def test_trie(spark, monkeypatch, segment, block):
    monkeypatch.setattr(conversation_trie, "SEGMENT", segment)
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    rows = [r for r in conversations() if segment > 2 or r[0] is None or r[0] not in (500, 600, 700)]  # a round a segment
    got = conversation_trie.prefix_trie(spark, *conversation_trie.rebuilt(frame(spark, rows, TURNS)))
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows)


def test_trie_without_turns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie.prefix_trie(spark, *conversation_trie.rebuilt(empty)).count() == 0
    # 3 takes no turn of its own family's first, which is absent, and loses its own
    rows = [(c, 0, "user", "x", None, None, None) for c in range(1, 9) if zlib.crc32(str(c).encode()) % 6 > 0]
    got = conversation_trie.prefix_trie(spark, *conversation_trie.rebuilt(frame(spark, rows, TURNS)))
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows) and got.count() == 1


def test_trie_of_hot_conversation(spark):
    """One conversation holds most rows: its turns are spread over segments, its tail is a chain."""
    rows = [(100, t, "user", f"t{t}", None, None, None) for t in range(4000)] + [(101, 0, "user", "other", None, None, None)]
    convs, turns = conversation_trie.rebuilt(frame(spark, rows, TURNS))
    got = conversation_trie.prefix_trie(spark, convs, turns)
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows)
