"""Vector bin packing of examples under limits on tokens, segments and loss-bearing tokens.

Each example asks for a vector: its tokens, one segment, its loss-bearing tokens (those of the answer, for instruction
data). A sequence has a limit for each of them. One sequence is filled at a time: among the waiting examples that fit,
the one with the greatest dot product of its demand and what is left (both as shares of the limits) goes in. So
an example that needs much of what is left in plenty is taken before one that needs what is scarce.

A bounded number of examples waits. Where none of them fits and cutting is allowed, the one that the dot product names
is cut to the room that is left; its rest waits again. A sequence that no example can fill to the token limit is
cut back to a power of two, since batches of those need no padding, and so are the last ones of a partition.

Each partition packs for itself while it is tokenised: no shuffle, bounded memory, and a lost task gives the same
sequences again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallybook.llm.bpe import PieceTokenizer
from tallybook.llm.textkit import spans
from tallybook.llm.token_alignment import byte_values

SEQUENCE_BITS = 33  # sequences of one partition; the number of the partition stands above them
MOST_TOKENS = 1 << 22  # of waiting examples together; bounds memory where texts are long
LAST_BYTE = b"\xff"  # stands for the end of a word: no UTF-8 text holds this byte
BLANK, LETTER, DIGIT, MARK, ODD = range(5)
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^A-Za-zÀ-ÖØ-öø-ÿ0-9'|\\s\x00-\x1f\x7f-\U0010ffff]+")


def character_classes() -> np.ndarray:
    """Class of each code point below 256. ODD ones, and all above, may mean more than one word can tell."""
    kinds = np.full(256, MARK, np.uint8)
    kinds[[*range(32), *range(127, 192), 39, 124]] = ODD  # the apostrophe ends words early, the bar is in special tokens
    kinds[[9, 10, 11, 12, 13, 32]] = BLANK
    kinds[48:58] = DIGIT
    kinds[[*range(65, 91), *range(97, 123), *range(192, 256)]] = LETTER
    kinds[[0xD7, 0xF7]] = MARK
    return kinds


class WordTokenizer(PieceTokenizer):
    """Ids by a tokenizer that folds case, drops white space and marks the ends of words.

    A run of letters, a digit or a run of marks of a word of plain characters is encoded alone as in its text; so is a
    whole word with other characters, as normalisation, special tokens and pieces do not reach across white space. Each
    distinct one is encoded once. Words with other characters go through the library itself, plain ones through the
    same merges as byte ranks, with the end of the word as a last byte that is merged first.
    """

    def __init__(self, json_path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_path)
        with open(json_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ranks, ids = self._ranks(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.byte_pairs = Encoding("words", pat_str="", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.id_of = ids
        self.kinds = character_classes()
        self.clear()

    @staticmethod
    def _ranks(vocab: dict[str, int], merges: list, suffix: str) -> tuple[dict[bytes, int], list[int]]:
        """Byte ranks of the merges, and the id of each rank."""
        value = byte_values()

        def entry(text: str) -> bytes:
            last = text.endswith(suffix)
            return bytes(value[c] for c in (text.removesuffix(suffix))) + (LAST_BYTE if last else b"")

        singles = [bytes([b]) for b in range(256)]
        ranks = {x: i for i, x in enumerate([*singles, *[x + LAST_BYTE for x in singles[:-1]]])}
        ids = [-1] * len(ranks)
        for merge in merges:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            ranks[entry(left + right)] = len(ids)
            ids.append(vocab[left + right])
        for text, i in vocab.items():
            if len(text.removesuffix(suffix)) == 1 and not entry(text).startswith(LAST_BYTE):
                ids[ranks[entry(text)]] = i
        return ranks, ids

    def one(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if PLAIN.fullmatch(text):
            return [self.id_of[r] for r in self.byte_pairs(text.lower().encode() + LAST_BYTE)]
        return self.exact.encode(text, add_special_tokens=False).ids

    def _encode_chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
        kinds = self.kinds[np.minimum(codes, 255)]
        kinds[codes > 255] = ODD
        starts, ends, _ = spans(kinds == BLANK, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        odd = np.diff(np.r_[0, np.cumsum(kinds == ODD)][np.stack([starts, ends])], axis=0)[0] > 0
        whole = np.repeat(odd, ends - starts)  # of each character of a word
        inside = np.flatnonzero(kinds != BLANK)
        first = np.zeros(len(codes) + 1, bool)
        first[starts] = True
        before = np.r_[np.uint8(BLANK), kinds[:-1]]
        first[inside] |= ~whole & ((kinds != before) | (kinds == DIGIT))[inside]
        fold = np.zeros(len(codes), bool)
        fold[inside] = ~whole & (kinds[inside] == LETTER)
        upper = fold & (((codes >= 65) & (codes <= 90)) | ((codes >= 192) & (codes <= 222)))
        begins = np.flatnonzero(first)
        stops = np.minimum(np.r_[begins[1:], len(codes)], ends[np.searchsorted(starts, begins, side="right") - 1])
        source, size = self.places(joined, codes + np.uint32(32) * upper, begins, stops)
        total = np.cumsum(size)
        ids = self.pool[np.repeat(source - total + size, size) + np.arange(total[-1])]
        text = np.searchsorted(offsets, begins, side="right") - 1
        return ids, np.bincount(text, size, len(texts)).astype(np.int64)


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(json_path: str) -> WordTokenizer:
    """One tokenizer per worker process."""
    if json_path not in _loaded:
        _loaded[json_path] = WordTokenizer(json_path)
    return _loaded[json_path]


@dataclass
class Limits:
    """What a sequence holds at most."""

    tokens: int = 4096
    segments: int = 64
    loss_tokens: int = 4096


class Packer:
    """Waiting examples and the sequences made of them.

    An example is (item, tokens, bare): ``bare`` tokens at its beginning bear no loss, all others do. A piece of it is
    (item, start, length). ``add`` and ``finish`` give finished sequences as lists of pieces.
    """

    def __init__(self, limits: Limits, waiting: int = 512, cut: bool = True):
        if min(limits.tokens, limits.segments, limits.loss_tokens, waiting) < 1:
            raise ValueError("each limit has to be one at least")
        self.limits, self.most, self.cut = limits, waiting, cut
        self.scale = 1.0 / np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.items: list = [None] * (waiting + 1)
        # Of each waiting example: where its rest starts, tokens left, bare tokens left.
        self.start = np.zeros(waiting + 1, np.int64)
        self.left = np.zeros(waiting + 1, np.int64)
        self.bare = np.zeros(waiting + 1, np.int64)
        self.count = 0
        self.total = 0

    def add(self, item, tokens: int, bare: int = 0) -> list[list[tuple]]:
        """Let an example wait; where too many examples or tokens wait, sequences are filled."""
        done = []
        self._put(item, 0, tokens, min(bare, tokens))
        while self.count > self.most or self.total > MOST_TOKENS:
            done.append(self._fill(self.limits.tokens))
        return done

    def finish(self) -> list[list[tuple]]:
        """Sequences of all that waits."""
        done = []
        while self.count:
            goal = self.limits.tokens
            if self.cut and self.total < goal:
                goal = 1 << (self.total.bit_length() - 1)
            done.append(self._fill(goal))
        return done

    def _put(self, item, start: int, left: int, bare: int) -> None:
        i = self.count
        if i == len(self.items):
            self.items.append(None)
            self.start, self.left, self.bare = (np.append(a, 0) for a in (self.start, self.left, self.bare))
        self.items[i], self.start[i], self.left[i], self.bare[i] = item, start, left, bare
        self.count += 1
        self.total += left

    def _drop(self, i: int) -> None:
        self.total -= int(self.left[i])
        last = self.count - 1
        self.items[i], self.items[last] = self.items[last], None
        for column in (self.start, self.left, self.bare):
            column[i] = column[last]
        self.count = last

    def _take(self, i: int, length: int) -> tuple:
        """The first ``length`` tokens left of an example, as a piece; the rest waits on."""
        item, start, left, bare = self.items[i], int(self.start[i]), int(self.left[i]), int(self.bare[i])
        if length == left:
            self._drop(i)
        else:
            self.start[i], self.left[i], self.bare[i] = start + length, left - length, max(bare - length, 0)
            self.total -= length
        return item, start, length, bare

    def _fill(self, goal: int) -> list[tuple]:
        room, segments, loss_room = goal, self.limits.segments, self.limits.loss_tokens
        pieces: list[tuple] = []
        while room and segments and self.count:
            left = self.left[:self.count]
            loss = left - self.bare[:self.count]
            weight = np.array([room, segments, loss_room], float) * self.scale * self.scale
            score = left * weight[0] + loss * weight[2] + weight[1]
            fits = (left <= room) & (loss <= loss_room)
            if segments == 1 and self.cut:
                fits &= left == room
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                length = int(left[i])
            elif self.cut or not pieces:  # an example beyond the limits is cut even where none else may be
                able = np.minimum(np.minimum(left, room), self.bare[:self.count] + loss_room)
                if self.cut:
                    i = int(np.argmax(np.where(able == able.max(), score, -1.0)))
                else:
                    i = int(np.argmax(left))
                length = int(able[i])
                if not length:
                    break
            else:
                break
            piece = self._take(i, length)
            pieces.append(piece)
            room -= length
            segments -= 1
            loss_room -= max(length - piece[3], 0)
        if room and self.cut:
            self._cut_back(pieces, goal - room)
        return [piece[:3] for piece in pieces]

    def _cut_back(self, pieces: list[tuple], tokens: int) -> None:
        """Give back tokens from the end until a power of two is left."""
        surplus = tokens - (1 << (tokens.bit_length() - 1))
        while surplus:
            item, start, length, bare = pieces.pop()
            kept = max(length - surplus, 0)
            surplus -= length - kept
            if kept:
                pieces.append((item, start, kept, bare))
            self._give_back(item, start + kept, length - kept, max(bare - kept, 0))

    def _give_back(self, item, start: int, length: int, bare: int) -> None:
        """The returned end of a piece joins what is left of its example, or waits by itself."""
        for i in range(self.count):
            if self.items[i] is item and self.start[i] == start + length:
                self.start[i], self.left[i] = start, self.left[i] + length
                self.bare[i] = min(bare, length) + (int(self.bare[i]) if bare >= length else 0)
                self.total += length
                return
        self._put(item, start, length, min(bare, length))


def pack_examples(docs: DataFrame, json_path: str, *, id_column: str = "doc_id", text_column: str = "text",
                  answer_column: str | None = None, limits: Limits | None = None, end_id: int = 2, waiting: int = 512,
                  cut: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids, loss_tokens, doc_tokens, sequence_id, offset.

    An example's ids are those of its text, then of its answer if there is such a column, then ``end_id``. Loss-bearing
    are the ids of the answer and the end id; without an answer column, all. ``ids``: little-endian unsigned 32-bit.
    Without ``cut`` only examples beyond a limit are cut. A null text or answer counts as empty; such a row still has
    the end id. Repeated rows are packed one by one, a null id stays null, an empty table gives no rows, other columns
    of ``docs`` are left out. Texts are read whole; one that is longer than a sequence gives several pieces. Ties in
    the dot product go to the example that stands first in the waiting list, which depends on the rows before only.
    """
    bounds = limits or Limits()
    names = [id_column, "start", "length", "ids", "loss_tokens", "doc_tokens", "sequence_id", "offset"]
    schema = (f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, start long, length long, ids binary, "
              "loss_tokens long, doc_tokens long, sequence_id long, offset long")
    texts = [text_column] + ([answer_column] if answer_column else [])
    full = 1 << 22  # ids in one batch of rows

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(json_path).encode
        packer = Packer(bounds, waiting, cut)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        columns: list[list] = [[] for _ in names]
        id_type = None
        sequence = held = 0

        def emit() -> pa.RecordBatch:
            nonlocal columns, held
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            columns, held = [[] for _ in names], 0
            return batch

        def write(sequences: list[list[tuple]]) -> None:
            nonlocal sequence, held
            for pieces in sequences:
                offset = 0
                for (key, ids, bare), start, length in pieces:
                    row = (key, start, length, ids[start:start + length].tobytes(),
                           length - min(max(bare - start, 0), length), len(ids), base + sequence, offset)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += length
                held += offset
                sequence += 1

        for batch in batches:
            id_type = batch.column(0).type
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                coded = []
                for column in part.columns[1:]:
                    ids, counts = encode([t or "" for t in column.to_pylist()])
                    coded.append((ids, np.r_[0, np.cumsum(counts)]))
                for k, key in enumerate(part.column(0).to_pylist()):
                    own = [ids[at[k]:at[k + 1]] for ids, at in coded]
                    bare = len(own[0]) if answer_column else 0
                    item = (key, np.concatenate([*own, [end_id]]).astype("<u4"), bare)
                    write(packer.add(item, len(item[1]), bare))
                if held >= full:
                    yield emit()
        write(packer.finish())
        if held:
            yield emit()

    return docs.select(id_column, *texts).mapInArrow(pack, schema)
