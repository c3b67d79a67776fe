"""Re-Pair on the ids of real texts: rules within rules, and every range decodes."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from edulens.llm import token_files


def test_grammar_of_a_block():
    texts = [t.encode() for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    encode = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids = np.frombuffer(b"".join(encode(texts)), "<u4")[:1_000_000]
    base = encode.tokenizer.get_vocab_size()
    symbols, rules, lengths = token_files.repair(ids, base)
    assert (rules >= base).any(1).sum() > 1000 and lengths.max() >= 8
    assert len(symbols) + 3 * len(rules) < 0.6 * len(ids)  # a rule is two symbols and a length
    assert (token_files.expand(symbols, rules, lengths, base) == ids).all()
    # what stays has no pair that a round would have replaced at a profit
    again = token_files.repair(symbols, base + len(rules))[0]
    assert len(again) > (1 - 2 * token_files.MIN_SAVING) * len(symbols)


def test_lots_hold_every_text(monkeypatch):
    monkeypatch.setattr(token_files, "ENCODE_BYTES", 10)
    texts = [b"", b"123456", b"1234", b"5", b"x" * 50, b"", b"y"]
    lots = list(token_files._lots(iter(texts)))
    assert [t for lot in lots for t in lot] == texts and all(len(lot) == 1 or sum(map(len, lot)) <= 10 for lot in lots)


def test_pieces_are_encoded_once():
    encode = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}é" for k in range(300)]
    texts = [" ".join(w + mark for w in words) for mark in ("", ",", ".", "!!", "'s", "***", "'", ".'")]
    assert encode([t.encode() for t in texts]) == [encode.whole(t) for t in texts]
    assert len(encode._known) < 330  # words without the punctuation after them, and each punctuation


def test_pieces_equal_whole_texts():
    encode, rng = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(8)
    letters = ["a", "Z", "7", "é", "ÿ", "×", "÷", "ȿ", "ɀ", "ė", "ª", "²", "é", "”", "中", "€", "'", "'s", "'ll", ".", ",", "-", "$", "<|", "|>", " ", "\n"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    expect = [encode.whole(t) for t in texts]
    assert encode([t.encode() for t in texts]) == expect
    encode._forget()
    encode._bytes[:] = 0  # as if the tokens did not stand for bytes: each piece by itself
    assert encode([t.encode() for t in texts]) == expect


def test_rules_that_are_used_expand_once():
    ids = np.tile(np.arange(64, dtype="<u4"), 64)
    symbols, rules, lengths = token_files.repair(ids, 64)
    assert lengths.max() > 32
    for lo in range(len(symbols)):
        assert (token_files.expand(symbols[:lo], rules, lengths, 64) == ids[: lengths[symbols[:lo] - 64].sum()]).all()
