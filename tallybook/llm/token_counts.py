"""Greedy longest-match word pieces, counted in time linear in the text and without building a piece.

The vocabulary is a trie. Every node has a failure link to where matching goes on once the pieces before are
given off, and the number of pieces that the link gives off; both are computed once, level by level. A word
is read character by character; what the links give off on the way adds up to its number of pieces.

Words are counted once per worker: a table of fixed size remembers the counts of words by hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybook.llm.textkit import words

SLOTS = 1 << 20
CODE_BITS = 21  # a code point
NOWHERE = -1


class Automaton:
    """Pieces of a word under greedy longest match; a word with a part that no piece covers is unknown."""

    def __init__(self, pieces: Iterable[str], start: str = "▁"):
        """``start`` stands before every word; pieces that begin with it match at the beginning of a word only."""
        self.start = start
        edges: dict[int, int] = {}
        parent, label, ends = [0], [0], [False]
        levels: list[list[int]] = [[]]
        for piece in pieces:
            node = 0
            for depth, c in enumerate(map(ord, piece), 1):
                key = node << CODE_BITS | c
                child = edges.get(key)
                if child is None:
                    child = edges[key] = len(parent)
                    parent.append(node)
                    label.append(c)
                    ends.append(False)
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append(child)
                node = child
            ends[node] = node != 0
        link, popped = [NOWHERE] * len(parent), [0] * len(parent)
        for level in levels:
            for node in level:
                if ends[node]:
                    link[node], popped[node] = 0, 1
                    continue
                at, count = link[parent[node]], popped[parent[node]]
                while at != NOWHERE and (at << CODE_BITS | label[node]) not in edges:
                    count += popped[at]
                    at = link[at]
                if at != NOWHERE:
                    link[node], popped[node] = edges[at << CODE_BITS | label[node]], count
        self.edges, self.link, self.popped = edges, link, popped

    def count(self, word: str) -> int:
        """Number of pieces, or -1 for an unknown word."""
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for c in map(ord, self.start + word):
            while (child := edges.get(node << CODE_BITS | c)) is None:
                total += popped[node]
                node = link[node]
                if node == NOWHERE:
                    return -1
            node = child
        while node:
            total += popped[node]
            node = link[node]
            if node == NOWHERE:
                return -1
        return total


class WordCounter:
    """Counts of many words at once; ``keys`` and ``counts`` remember words by the slot of their hash."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.keys, self.counts = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)

    def __call__(self, piece: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        counts = self.counts[slot]
        fresh = np.flatnonzero(self.keys[slot] != hashes)
        if len(fresh):
            distinct, first, back = np.unique(hashes[fresh], return_index=True, return_inverse=True)
            first = fresh[first]
            own = np.array([self.automaton.count(piece[a:b].decode("utf-8", "replace"))
                            for a, b in zip(starts[first].tolist(), ends[first].tolist())], np.int64)
            counts[fresh] = own[back]
            self.keys[slot[first]], self.counts[slot[first]] = distinct, own
        return counts


_loaded: dict[str, WordCounter] = {}


def load(model_path: str) -> WordCounter:
    """One counter per worker process, for the text pieces of a sentence-piece vocabulary."""
    if model_path not in _loaded:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        _loaded[model_path] = WordCounter(Automaton(
            model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))))
    return _loaded[model_path]


def count_pieces(docs: DataFrame, model_path: str, text_column: str = "text") -> DataFrame:
    """``docs`` with n_words, n_pieces and n_unknown (long) of the whole text.

    Words are runs without white space (ASCII); an unknown word counts as one piece. Null and empty texts count
    0. Every row is kept; an empty table stays empty; columns of docs with the new names are replaced.
    """
    names = ["n_words", "n_pieces", "n_unknown"]
    columns = [c for c in docs.columns if c not in names]
    where = columns.index(text_column)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(model_path)
        for batch in batches:
            found = [np.zeros((3, 0), np.int64)]
            for first, last, codes, starts, ends, text, hashes in words(batch.column(where), fold=None):
                pieces, n = counter(codes.tobytes(), starts, ends, hashes), last - first
                found.append(np.array([np.bincount(text, minlength=n), np.bincount(text, np.abs(pieces), n),
                                       np.bincount(text, pieces < 0, n)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, np.concatenate(found, axis=1))],
                                             names=[*columns, *names])

    schema = docs.select(*columns).schema
    for name in names:
        schema = schema.add(name, "long")
    return docs.select(*columns).mapInArrow(count, schema)
