"""Runs of repeated words, found by catchers over completed power-of-two blocks.

For each level k the text is cut into blocks of b = 2**k words. A block that is complete gets a catcher, which
looks for squares whose half is b to 2b - 1 words long: each appended word closes one suffix of b words, and that
suffix is compared with the last block that was complete when it began. If they are equal, the distance d between
them is the half of a possible square. Catches of one distance in neighbouring blocks chain up into one stretch;
it grows at both ends by less than a block, word by word, and becomes a run if it is long enough. What lies in a run of
a lower level is merged into it.

Levels need nothing from each other but the runs found before. So a whole stretch of texts is appended at once:
one vector comparison per level does the suffix comparisons of all its words. The cost is words times levels,
whatever repeats, and memory is that of one stretch of texts (or of one text, where that is longer).

Suffixes are compared by 64-bit names that are built by doubling; each run found is then checked word by word.
A run of period q and at least 4q words holds a whole block of its level together with its copy q words on,
so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybook.llm.textkit import SPACES, chunks, mix, span_hashes, spans, text_buffer

LEAST_POWER = 4  # what the catchers are sure to find: runs of at least four periods
GROW_CELLS = 1 << 20  # words compared in one step, over all stretches that still grow
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _name_pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of the joined stretches from those of their halves."""
    h = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _grow(words: np.ndarray, at: np.ndarray, other: np.ndarray, room: int, step: int) -> np.ndarray:
    """How many words, up to ``room``, agree from ``at`` and ``other`` on in the direction of ``step``."""
    n = len(words)
    grown = np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    width = 1
    while room and len(active):
        width = min(width, room)
        i = at[active, None] + step * (grown[active, None] + np.arange(width))
        j = other[active, None] + step * (grown[active, None] + np.arange(width))
        inside = (i >= 0) & (j >= 0) & (i < n) & (j < n)
        same = inside & (words[np.where(inside, i, 0)] == words[np.where(inside, j, 0)])
        more = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        grown[active] += more
        active = active[(more == width) & (grown[active] < room)]
        room_left = room - (grown[active].max() if len(active) else 0)
        width = max(min(2 * width, room_left, GROW_CELLS // max(len(active), 1)), 1)
    return np.minimum(grown, room)


def find_runs(words: np.ndarray, longest: int | None = None, least: int = 6, power: int = LEAST_POWER) -> list[tuple]:
    """(start, end, period) of each run of at least ``max(least, power * period)`` of ``words`` (64-bit names).

    A run is a longest stretch in which words ``period`` apart are equal, with its smallest period. ``longest``: no
    stretch of equal texts is longer (the longest text, where several stand in ``words`` with a name of its own
    between them). ``power`` is four or more.
    """
    if power < LEAST_POWER:
        raise ValueError(f"runs of fewer than {LEAST_POWER} periods can be missed")
    n = len(words)
    limit = min(n, longest or n) // power  # no period is longer
    names, b = words, 1
    runs: list[tuple] = []
    covered = np.zeros(n, np.int64)  # furthest end of the runs found so far that hold this word
    while b <= limit and len(names) > b:
        blocks = np.repeat(names[::b], b)[:len(names) - b]
        caught = np.flatnonzero(names[b:] == blocks)  # caught + b is where the suffix begins
        if len(caught):
            block = caught // b * b
            distance = caught + b - block
            new = covered[block] < block + distance + b
            runs += _new_runs(words, block[new], distance[new], b, least, power, covered)
        if 2 * b <= limit:
            names = _name_pairs(names[:-b], names[b:])
        b *= 2
    return sorted(runs)


def _new_runs(words: np.ndarray, block: np.ndarray, distance: np.ndarray, b: int, least: int, power: int,
              covered: np.ndarray) -> list[tuple]:
    """The runs that catches (block start, distance) of one level belong to; ``covered`` is brought up to date."""
    if not len(block):
        return []
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    head = np.flatnonzero(np.r_[True, (np.diff(distance) != 0) | (np.diff(block) != b)])
    first, d = block[head], distance[head]
    matched = np.diff(np.r_[head, len(block)]) * b
    # At most b - 1 more words agree at each end, as the next block there was not caught.
    wide = matched + 2 * (b - 1) + d >= np.maximum(least, power * d)
    first, d, matched = first[wide], d[wide], matched[wide]
    left = _grow(words, first - 1, first + d - 1, b - 1, -1)
    right = _grow(words, first + matched, first + matched + d, b - 1, 1)
    start, end = first - left, first + matched + right + d
    long = end - start >= np.maximum(least, power * d)
    found: dict[tuple, int] = {}
    for s, e, q in zip(start[long].tolist(), end[long].tolist(), d[long].tolist()):
        if not np.array_equal(words[s:e - q], words[s + q:e]):  # two stretches with one name: look at the words
            for s2, e2 in _plain_stretches(words[s:e], q, max(least, power * q)):
                found[s + s2, s + e2] = min(q, found.get((s + s2, s + e2), q))
            continue
        found[s, e] = min(q, found.get((s, e), q))  # a multiple of the period gives the same stretch
    for s, e in found:
        np.maximum(covered[s:e], e, out=covered[s:e])
    return [(s, e, q) for (s, e), q in found.items()]


def _plain_stretches(words: np.ndarray, q: int, least: int) -> list[tuple]:
    same = np.r_[False, words[q:] == words[:-q], False]
    edges = np.flatnonzero(same[1:] != same[:-1])
    return [(s, e + q) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()) if e + q - s >= least]


def _text_runs(data: np.ndarray, offsets: np.ndarray, least: int, power: int) -> Iterator[tuple]:
    """Per text: number of words, runs, and the text's kept words joined by blanks."""
    count = len(offsets) - 1
    starts, ends, text = spans(SPACES[data], offsets)
    per_text = np.bincount(text, minlength=count)
    # A name of its own after each text keeps runs from reaching into the next.
    names = np.empty(len(starts) + count, np.uint64)
    place = np.arange(len(starts)) + text
    names[place] = span_hashes(data, starts, ends)
    gaps = np.cumsum(per_text) + np.arange(count)
    names[gaps] = mix(np.arange(count).astype(np.uint64) + np.uint64(1 << 62))
    begin = np.r_[0, gaps[:-1] + 1] if count else gaps
    runs = find_runs(names, int(per_text.max(initial=0)), least, power)
    owner = np.searchsorted(begin, [r[0] for r in runs], side="right") - 1 if runs else []
    mine: dict[int, list[tuple]] = {}
    for k, (s, e, q) in zip(np.asarray(owner).tolist(), runs):
        mine.setdefault(k, []).append((s - int(begin[k]), e - s, q))
    raw = data.tobytes()
    for k in range(count):
        pieces = raw[offsets[k]:offsets[k + 1]].split()
        own = mine.get(k, [])
        if own:
            kept = np.ones(len(pieces), bool)
            for s, length, q in own:
                kept[s + q:s + length] = False
            pieces = [pieces[i] for i in np.flatnonzero(kept).tolist()]
        yield int(per_text[k]), own, b" ".join(pieces)


def detect_runs(docs: DataFrame, text_column: str = "text", least: int = 6, power: int = LEAST_POWER) -> DataFrame:
    """``docs`` with n_words (long), runs (start, length, period; by start, then period) and collapsed (string).

    Words are what stands between ASCII white space, numbered from 0. ``collapsed``: the words joined by one blank,
    without those that a run holds after its first ``period`` words. A null or empty text has no words, no runs and an
    empty ``collapsed``. Every row is kept, repeated rows and null ids too; an empty table stays empty; a text is
    read whole, whatever its length. Columns of ``docs`` called n_words, runs or collapsed are replaced.
    """
    names = ["n_words", "runs", "collapsed"]
    columns = [c for c in docs.columns if c not in names]
    where = columns.index(text_column)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def detect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(where))
            for first, last in chunks(offsets, 1 << 20):
                found = list(_text_runs(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first],
                                        least, power))
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in own] for _, own, _ in found]
                new = [pa.array([f[0] for f in found], pa.int64()), pa.array(runs, kind),
                       pa.array([f[2] for f in found], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns, *new], names=[*columns, *names])

    schema = docs.select(*columns).schema
    schema = schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    return docs.select(*columns).mapInArrow(detect, schema)
