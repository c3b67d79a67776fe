"""Token counts under a unigram model, with a trie of pre-tokens.

The vocabulary and its order are those of a public sentencepiece file. The file
holds merge ranks, not probabilities, so a piece of rank r has the
log-probability ``-ln(1 + r)`` (Zipf's law); a character outside of the
vocabulary costs its UTF-8 bytes, each at the rank of ``BYTE_RANK``.

A pre-token is a run of characters other than ASCII white space, with the
word mark in front. Its segmentation is the one of the best forward score (ties:
fewest tokens). A slice's distinct pre-tokens in sorted order are the depth-first
walk of their trie: the forward scores of a prefix are computed once and shared
by all pre-tokens below, and the count at the end of each pre-token is kept.
A worker remembers counts over slices, up to a bound. Texts are not shuffled.

Null and empty texts have no tokens. Repeated rows are counted alike. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8

MARK = "▁"
BYTE_RANK = 1_000_000
#: Pre-tokens that a worker remembers.
CACHE_WORDS = 400_000
#: Rows whose pre-tokens share a trie.
TRIE_ROWS = 2048


class Vocabulary:
    """Pieces with log-probabilities, as a trie of reversed pieces."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score = {model.id_to_piece(i): -math.log(1 - model.get_score(i)) for i in range(model.get_piece_size())
                      if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.byte = -math.log(1 + BYTE_RANK)
        # node: children by character, score of the piece that is complete here or None
        self.root: tuple[dict, list] = ({}, [None])
        for piece, score in self.score.items():
            node = self.root
            for c in reversed(piece):
                node = node[0].setdefault(c, ({}, [None]))
            node[1][0] = score

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each word; words are sorted."""
        best, used, out = [0.0], [0], []
        before, root, byte = "", self.root[0], self.byte
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], used[shared + 1 :]
            for end in range(shared, len(word)):
                # the last character alone, as bytes if it is no piece
                children, at, top, n = root, end, None, 0
                while at >= 0 and (node := children.get(word[at])):
                    children, (score,) = node
                    if score is not None:
                        total, m = best[at] + score, used[at] + 1
                        if top is None or total > top or (total == top and m < n):
                            top, n = total, m
                    at -= 1
                if word[end] not in self.score:
                    size = len(word[end].encode())
                    total, m = best[end] + byte * size, used[end] + size
                    if top is None or total > top or (total == top and m < n):
                        top, n = total, m
                best.append(top)
                used.append(n)
            out.append(used[-1])
            before = word
        return out


_vocabularies: dict[str, tuple[Vocabulary, dict[bytes, int]]] = {}


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _vocabularies:
            _vocabularies[path] = Vocabulary(path), {}
        vocabulary, known = _vocabularies[path]
        for whole in slices(batches):
            for at in range(0, whole.num_rows, TRIE_ROWS):
                batch = whole.slice(at, TRIE_ROWS)
                if len(known) > CACHE_WORDS:
                    known.clear()
                texts = [t.split() for t in utf8(batch.column(1))]
                fresh = sorted((MARK + w.decode(), w) for w in set().union(*texts) - known.keys())
                for (_, w), n in zip(fresh, vocabulary.counts([f for f, _ in fresh]), strict=True):
                    known[w] = n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([sum(map(known.__getitem__, t)) for t in texts], pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of each row of ``docs`` (``doc_id``, ``text``)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _counted(vocabulary), "doc_id long, n_pretokens long, n_tokens long")
