"""Best-fit packing of tokenised documents into sequences of a fixed length.

Method: bounded-space online best fit. A fixed number of sequences is open at a time. The open ones are
keyed by their free space in one bitset (bit f set: some open sequence has f places free), so the tightest
one that takes a piece is found by a shift and a lowest set bit. When none takes it and all are open, the
fullest is closed. At the end of a partition the pieces of the sequences still open are laid out once more,
longest first, which fills the tail. Where the order of the documents counts (``keep_order``) they are left as
they are and numbered by the first document in each.

Each partition of the input packs for itself, while it is tokenised: no shuffle, memory of the open
sequences only, and a lost task gives the same sequences again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.bpe import tokenizer
from tallybook.llm.textkit import lean

SEQUENCE_BITS = 33  # sequences of one partition; the number of the partition stands above them


class OpenBins:
    """At most ``limit`` open sequences of ``capacity`` places; add() returns those that had to be closed."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: dict[int, list[list]] = {}
        self.bits = 0
        self.count = 0

    def _put(self, free: int, bin_: list) -> None:
        if free in self.by_free:
            self.by_free[free].append(bin_)
        else:
            self.by_free[free] = [bin_]
            self.bits |= 1 << free
        self.count += 1

    def _take(self, free: int) -> list:
        stack = self.by_free[free]
        bin_ = stack.pop()
        if not stack:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.count -= 1
        return bin_

    def add(self, length: int, item) -> list[list]:
        closed = []
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.count >= self.limit:
                fullest = (self.bits & -self.bits).bit_length() - 1
                closed.append(self._take(fullest))
            free, bin_ = self.capacity, []
        bin_.append((length, item))
        if free == length:
            closed.append(bin_)
        else:
            self._put(free - length, bin_)
        return closed

    def rest(self) -> list[list]:
        return [bin_ for stack in self.by_free.values() for bin_ in stack]

    def finish(self) -> list[list]:
        """Close the rest: its pieces packed anew, longest first (best fit decreasing)."""
        rest = [piece for bin_ in self.rest() for piece in bin_]
        again = OpenBins(self.capacity, len(rest) + 1)
        closed = []
        for length, item in sorted(rest, key=lambda piece: -piece[0]):
            closed += again.add(length, item)
        return closed + again.rest()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of n ids; only the first may be shorter than the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, *, id_column: str = "doc_id",
                   text_column: str = "text", capacity: int = 1024, end_id: int = 2,
                   open_bins: int = 512, keep_order: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids, sequence_id, offset.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit values. A null text counts as
    empty and gives one piece with the end id alone. Repeated rows are packed one by one. An empty table
    gives no rows; other columns of ``docs`` are left out. A null id stays null. With ``keep_order`` ascending
    sequence_id follows the partitions and the rows in each, as far as a sequence stays open.
    """
    schema = (f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, piece int, start long, length long, "
              "ids binary, sequence_id long, offset long")
    limit = 1 << 23  # ids in one batch of rows

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(json_path, ranks_path)
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        rows: list[tuple] = []
        sequence = held = turn = 0
        names = [id_column, "piece", "start", "length", "ids", "sequence_id", "offset"]
        id_type = None

        def emit():
            arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                [id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()])]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def close(bin_):
            nonlocal sequence, held
            offset = 0
            for length, (_, key, piece, start, ids) in bin_:
                rows.append((key, piece, start, length, ids, base + sequence, offset))
                offset += length
            held += offset
            sequence += 1

        for batch in batches:
            id_type = batch.column(0).type
            keys = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for begin in range(0, len(texts), 256):
                part = [t or "" for t in texts[begin:begin + 256]]
                ids, counts = tokens.encode(part)
                at = 0
                for key, n in zip(keys[begin:begin + 256], counts.tolist()):
                    own = np.append(ids[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for piece, (start, length) in enumerate(cut(n + 1, capacity)):
                        item = (turn, key, piece, start, own[start:start + length].tobytes())
                        turn += 1
                        for bin_ in bins.add(length, item):
                            close(bin_)
                if held >= limit:
                    yield emit()
                    rows, held = [], 0
        tokens.release()
        for bin_ in sorted(bins.rest(), key=lambda b: b[0][1][0]) if keep_order else bins.finish():
            close(bin_)
        if rows:
            yield emit()

    return docs.select(F.col(id_column), F.col(text_column)).mapInArrow(lean(pack), schema)
