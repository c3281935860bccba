"""Alignment of the tokens of two tokenizers over the same text, and how often their ids overlap.

A is a byte-level vocabulary of the ``tokenizers`` library, which gives character offsets; B a ``sentencepiece`` model, whose
immutable proto gives spans. Both are coarse: the bytes of one character may belong to several tokens, and all of those
claim the character's end (A) or none but the last does (B). A token that closes a character takes its end from
the offset; the ends of the others are counted from the last coarse cut by the bytes that the tokens decode to. The
decoded bytes of all tokens have to be the text itself, otherwise the text has no tokens.

Tokenising is done once per distinct stretch: A within the vocabulary's own word pieces, B between characters that are
neighbours in no piece of the model.

Two tokens are linked if their byte ranges overlap; ends of A and B together cut a text into as many stretches as there
are links. How often a pair of ids is linked in the whole corpus takes two passes: texts are aligned in blocks of
bounded size, whose distinct pairs are counted, written and summed over all blocks; each block then gets the sums of its
own pairs only. So no table of pairs is ever broadcast or sent to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.bpe import UNKNOWN, PieceTokenizer, category_table
from tallybook.llm.textkit import span_hashes
from tallybook.session import scratch_dir

SLOTS = 1 << 20  # the cache of stretches: a newer one takes the slot of an older one
POOL = 1 << 22  # tokens kept for cached stretches; beyond it the cache starts anew. Both bound memory, not results
TOGETHER = 256  # stretches that go to B in one text
CHUNK_CHARS = 1 << 17
BLOCK_LINKS = 1 << 20  # links of one block; a longer text is a block by itself
BLOCK_BITS = 33  # blocks of one partition; the number of the partition stands above them
FENCE = "\x01"  # stands before each stretch that is given to B; no longer piece holds it
LOW_LINE = "▁"  # what a piece of B has for a blank
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Stretches:
    """Tokens (id, first, end: offsets from the stretch's start) of stretches of text, each distinct one encoded once.

    ``encode(stretches)`` gives how many tokens each has, and the three lists for all of them.
    """

    def __init__(self, encode: Callable):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at, self.size = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.pool = np.empty((3, POOL + POOL // 4), np.int32)
        self.used = 0

    def tokens(self, joined: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, first, end) of all tokens, and how many each stretch has."""
        keys = span_hashes(codes, starts, ends) ^ (ends - starts).astype(np.uint64)
        if self.used > POOL:
            self.clear()
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        at, size = self.at[slot], self.size[slot]
        fresh = np.flatnonzero(self.keys[slot] != keys)
        if len(fresh):
            distinct, first, back = np.unique(keys[fresh], return_index=True, return_inverse=True)
            first = fresh[first]
            sizes, *rows = self.encode([joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            new_size = np.asarray(sizes, np.int64)
            new_at = self.used + np.cumsum(new_size) - new_size
            end = self.used + int(new_size.sum())
            if end > self.pool.shape[1]:
                self.pool = np.concatenate([self.pool, np.empty((3, end - self.pool.shape[1] + POOL // 4), np.int32)], axis=1)
            self.pool[:, self.used:end] = rows
            self.used = end
            at[fresh], size[fresh] = new_at[back], new_size[back]
            spot = slot[first]
            self.keys[spot], self.at[spot], self.size[spot] = distinct, new_at, new_size
        total = np.cumsum(size)
        where = np.repeat(at - total + size, size) + np.arange(total[-1] if len(total) else 0)
        return self.pool[:, where].astype(np.int64), size


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevelTokens:
    """Tokens of A over chunks of texts; offsets are characters."""

    def __init__(self, json_path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(json_path)
        self.model.encode_special_tokens = True
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
        value = byte_values()
        entries = {i: t for t, i in self.model.get_vocab(with_added_tokens=False).items()}
        self.bytes = [bytes(value[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.kinds = category_table()
        self.cache = Stretches(self._encode)

    def _encode(self, stretches: list[str]) -> tuple[list, list, list, list]:
        sizes, ids, spans = [], [], []
        encode = self.model.encode
        for text in stretches:
            got = encode(text, add_special_tokens=False)
            own = got.ids
            sizes.append(len(own))
            ids += own
            spans += got.offsets
        first, end = zip(*spans) if spans else ((), ())
        return sizes, ids, first, end

    def tokens(self, joined: str, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(id, first, end) of all tokens, offsets within the chunk."""
        kinds = self.kinds[np.minimum(codes, 0xFFFF)]
        kinds[codes > 0xFFFF] = UNKNOWN
        cuts = PieceTokenizer.piece_starts(codes, kinds, offsets)
        # Texts with characters whose class is not known here go to the library as a whole.
        odd = np.unique(np.searchsorted(offsets, np.flatnonzero(kinds == UNKNOWN), side="right") - 1)
        for k in odd.tolist():
            cuts[offsets[k] + 1:offsets[k + 1]] = False
        starts = np.flatnonzero(cuts)
        (ids, first, end), size = self.cache.tokens(joined, codes, starts, np.r_[starts[1:], len(codes)])
        base = np.repeat(starts, size)
        return ids, first + base, end + base


class PieceTokens:
    """Tokens of B over chunks of texts that begin with the blank which B adds; offsets are bytes."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        special = [i for i in range(len(pieces)) if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(LOW_LINE, " ").encode()
                      for i, p in enumerate(pieces)]
        text = [p.replace(LOW_LINE, " ") for i, p in enumerate(pieces) if i not in set(special)]
        # Neighbours in a piece, of characters below 256: between two others no piece goes on. So what stands on the two
        # sides is encoded alike alone and together.
        self.joins = np.zeros((257, 257), bool)
        self.joins[256, :] = self.joins[:, 256] = True
        for p in text:
            for x, y in zip(p, p[1:]):
                if ord(x) < 256 and ord(y) < 256:
                    self.joins[ord(x), ord(y)] = True
        if any(FENCE in p and p != FENCE for p in text):
            raise ValueError(f"{model_path} has longer pieces with the character U+0001")
        fence = self._spans(FENCE)[0]
        if len(fence) != 1:
            raise ValueError(f"{model_path} has no token for the character U+0001")
        self.fence = int(fence[0])
        self.cache = Stretches(self._encode)

    @cached_property
    def proto(self) -> dict:
        """How this release of the library calls its immutable proto."""
        for setting in ({"out_type": "immutable_proto"}, {"return_type": "proto"}):
            try:
                self.model.encode(["a"], num_threads=1, **setting)
                return setting
            except ValueError:
                continue
        raise RuntimeError("this release of sentencepiece gives no spans")

    def _spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and byte offsets of the tokens of a text, without the blank that B adds to one that begins with a fence."""
        pieces = self.model.encode([text], num_threads=1, **self.proto)[0].pieces
        n = len(pieces)
        return (np.fromiter((p.id for p in pieces), np.int64, n)[1:], np.fromiter((p.begin for p in pieces), np.int64, n)[1:],
                np.fromiter((p.end for p in pieces), np.int64, n)[1:])

    def _encode(self, stretches: list[str]) -> tuple[np.ndarray, ...]:
        """Stretches go to B together, each behind a fence, so that B adds no blank to it; those that hold one go alone."""
        sizes = np.zeros(len(stretches), np.int64)
        order, parts = [], []
        plain = [i for i, t in enumerate(stretches) if FENCE not in t]
        for begin in range(0, len(plain), TOGETHER):
            some = plain[begin:begin + TOGETHER]
            ids, first, end = self._spans("".join(FENCE + stretches[i] for i in some))
            fences = np.flatnonzero(ids == self.fence)
            counts = np.diff(np.r_[fences, len(ids)]) - 1
            start = np.repeat(end[fences], counts)
            own = ids != self.fence
            sizes[some] = counts
            order += some
            parts.append((ids[own], first[own] - start, end[own] - start))
        for i in set(range(len(stretches))) - set(plain):
            ids, first, end = self._spans(FENCE + stretches[i])
            sizes[i] = len(ids) - 1
            order.append(i)
            parts.append((ids[1:], first[1:] - 1, end[1:] - 1))
        rows = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 3
        if order != sorted(order):  # back into the order of the stretches
            of = np.repeat(order, sizes[order])
            rows = [r[np.argsort(of, kind="stable")] for r in rows]
        return sizes, *rows

    def tokens(self, joined: str, codes: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """(id, first, end) of all tokens; ``places``: the byte at which each character begins."""
        low = np.minimum(codes, 256)
        cuts = np.r_[np.zeros(min(1, len(codes)), bool), ~self.joins[low[:-1], low[1:]]]
        cuts[offsets[:-1]] = True
        starts = np.flatnonzero(cuts)
        (ids, first, end), size = self.cache.tokens(joined, codes, starts, np.r_[starts[1:], len(codes)])
        base = np.repeat(places[starts], size)
        return ids, first + base, end + base


def refined_ends(first: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The byte at which each token ends, from coarse offsets (bytes) and the number of bytes that each decodes to.

    A token whose offsets are not empty and not shared with the next one ends at a character: there its offset holds.
    The others end as many bytes after the last such cut as the tokens since then decode to.
    """
    if not len(end):
        return end
    sure = (end > first) & np.r_[first[1:] >= end[:-1], True]
    at = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(end)), -1))
    counted = at - np.where(last >= 0, at[last], 0)
    return np.where(last >= 0, end[last], 0) + counted


def _id_texts(n: int) -> np.ndarray:
    texts = np.empty(n, object)
    texts[:] = [str(i) for i in range(n)]
    return texts


class Aligner:
    """Aligned tokens of texts: counts, groups and links."""

    def __init__(self, json_path: str, model_path: str):
        self.a, self.b = ByteLevelTokens(json_path), PieceTokens(model_path)
        self.size_a = np.array([len(t) for t in self.a.bytes])
        self.size_b = np.array([len(t) for t in self.b.bytes])
        self.ids_of_b = len(self.size_b)
        text_a, text_b = _id_texts(len(self.size_a)), _id_texts(self.ids_of_b)
        self.text_a = [text_a + ",", text_a + "|"]  # inside a group, at its end
        self.text_b = [text_b + ",", text_b + ";"]

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text n_a, n_b, n_groups, n_links; its groups; then of all links the pair (A id * ids of B + B id)."""
        joined = "".join(" " + t if t else "" for t in texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.r_[0, np.cumsum([len(t) + 1 if t else 0 for t in texts])].astype(np.int64)
        width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        places = np.r_[0, np.cumsum(width)].astype(np.int64)
        real = np.unique(offsets)  # empty texts have no place of their own
        ids_a, first_a, end_a = self.a.tokens(joined, codes, real)
        ids_b, first_b, end_b = self.b.tokens(joined, codes, real, places)
        end_a = refined_ends(places[first_a], places[end_a], self.size_a[ids_a])
        end_b = refined_ends(first_b, end_b, self.size_b[ids_b])
        edges = places[offsets]
        data = joined.encode()
        ids_a, end_a = self._whole(data, edges, ids_a, end_a, self.a.bytes, self.size_a)
        ids_b, end_b = self._whole(data, edges, ids_b, end_b, self.b.bytes, self.size_b)
        if ids_a is None or ids_b is None:
            if len(texts) > 1:  # find the texts concerned
                half = len(texts) // 2
                return self._joined(self.align(texts[:half]), self.align(texts[half:]))
            return np.zeros((4, 1), np.int64), [""], np.empty(0, np.int64)
        return self._linked(edges, ids_a, end_a, ids_b, end_b)

    @staticmethod
    def _joined(one: tuple, two: tuple) -> tuple:
        return np.concatenate([one[0], two[0]], axis=1), one[1] + two[1], np.concatenate([one[2], two[2]])

    @staticmethod
    def _whole(data: bytes, edges: np.ndarray, ids: np.ndarray, end: np.ndarray, entries: list[bytes],
               sizes: np.ndarray) -> tuple:
        """ids and ends, or nothing where the tokens' bytes are not the texts'."""
        right = b"".join(map(entries.__getitem__, ids.tolist())) == data and np.array_equal(end, np.cumsum(sizes[ids]))
        if right and len(data):
            ends = np.zeros(len(data) + 1, bool)
            ends[end] = True
            right = bool(ends[edges[edges > 0]].all())
        return (ids, end) if right else (None, None)

    def _linked(self, edges: np.ndarray, ids_a: np.ndarray, end_a: np.ndarray, ids_b: np.ndarray, end_b: np.ndarray):
        total = int(edges[-1])
        in_a, in_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        in_a[end_a], in_b[end_b] = True, True
        cuts = np.flatnonzero(in_a | in_b)
        # A link for each stretch between neighbouring ends: the tokens that it lies in.
        a_at = np.searchsorted(end_a, cuts)
        b_at = np.searchsorted(end_b, cuts)
        pairs = ids_a[a_at] * self.ids_of_b + ids_b[b_at]
        common_a, common_b = in_b[end_a], in_a[end_b]
        group_ends = end_a[common_a]
        numbers = np.diff([np.searchsorted(e, edges, side="right") for e in (end_a, end_b, group_ends, cuts)], axis=1)
        # The groups' texts: A's tokens of a group stand before B's.
        group_a = np.cumsum(common_a) - common_a
        group_b = np.cumsum(common_b) - common_b
        b_before = np.searchsorted(group_b, group_a)
        a_before = np.searchsorted(group_a, group_b, side="right")
        words = np.empty(len(ids_a) + len(ids_b), object)
        for ids, common, before, texts in ((ids_a, common_a, b_before, self.text_a), (ids_b, common_b, a_before, self.text_b)):
            at = np.arange(len(ids)) + before
            words[at[~common]] = texts[0][ids[~common]]
            words[at[common]] = texts[1][ids[common]]
        words = words.tolist()
        edge = np.r_[0, np.cumsum(numbers[0] + numbers[1])].tolist()
        groups = ["".join(words[i:j])[:-1] for i, j in zip(edge, edge[1:])]
        return numbers, groups, pairs


_loaded: dict[tuple, Aligner] = {}


def aligner(json_path: str, model_path: str) -> Aligner:
    """One aligner per worker process."""
    key = (json_path, model_path)
    if key not in _loaded:
        _loaded[key] = Aligner(json_path, model_path)
    return _loaded[key]


PARTS = """block bigint, row bigint, {id} {type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,
groups_sha256 string, links binary, place int, a int, b int, n bigint"""


def align_blocks(docs: DataFrame, json_path: str, model_path: str, id_column: str = "doc_id",
                 text_column: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """The first pass: a row for each text and one for each distinct pair of ids of its block.

    Text rows hold the counts, the hash of the groups and ``links``: the places in the block's list of pairs, as
    little-endian unsigned numbers of 16 bits, or of 32 where the list is longer. Pair rows hold the place, the two ids and their links in the block.
    """
    schema = PARTS.format(id=f"`{id_column}`", type=docs.schema[id_column].dataType.simpleString())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(json_path, model_path)
        base = TaskContext.get().partitionId() << BLOCK_BITS
        block = row = links = 0
        texts: list[tuple] = []
        pairs: list[np.ndarray] = []
        kinds = None

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal block, row, links, texts, pairs
            distinct, where, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            ends = np.cumsum([t[4] for t in texts])
            where = where.astype("<u2" if len(distinct) <= 1 << 16 else "<u4")
            own = [where[e - t[4]:e].tobytes() for t, e in zip(texts, ends.tolist())]
            number = pa.array(np.full(len(texts), base + block), pa.int64())
            columns = [number, pa.array(range(row, row + len(texts)), pa.int64()), pa.array([t[0] for t in texts], kinds),
                       *[pa.array([t[i] for t in texts], pa.int64()) for i in (1, 2, 3, 4)],
                       pa.array([t[5] for t in texts], pa.string()), pa.array(own, pa.binary()),
                       *[pa.nulls(len(texts), k) for k in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            for begin in range(0, len(distinct), 1 << 16):
                part, count = distinct[begin:begin + (1 << 16)], n[begin:begin + (1 << 16)]
                m = len(part)
                columns = [pa.array(np.full(m, base + block), pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, kinds),
                           *[pa.nulls(m, pa.int64())] * 4, pa.nulls(m, pa.string()), pa.nulls(m, pa.binary()),
                           pa.array(np.arange(begin, begin + m), pa.int32()), pa.array(part // work.ids_of_b, pa.int32()),
                           pa.array(part % work.ids_of_b, pa.int32()), pa.array(count, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            row += len(texts)
            block, links, texts, pairs = block + 1, 0, [], []

        names = ["block", "row", id_column, *COUNTS[:4], "groups_sha256", "links", "place", "a", "b", "n"]
        for batch in batches:
            kinds = batch.column(0).type
            keys, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = 0
            while begin < len(keys):
                end, chars = begin, 0
                while end < len(keys) and (end == begin or chars + len(values[end] or "") <= CHUNK_CHARS):
                    chars += len(values[end] or "")
                    end += 1
                numbers, groups, found = work.align([v or "" for v in values[begin:end]])
                for k, key, digest, one in zip(range(end - begin), keys[begin:end], groups, numbers.T.tolist()):
                    texts.append((key, *one, hashlib.sha256(digest.encode()).hexdigest() if one[0] else ""))
                pairs.append(found)
                links += len(found)
                begin = end
                if links >= block_links:
                    yield from emit()
        if texts:
            yield from emit()

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def align_tokens(docs: DataFrame, json_path: str, model_path: str, id_column: str = "doc_id",
                 text_column: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """Per text: n_a, n_b (tokens), n_groups, n_links, n_best, count_sum (long) and groups_sha256.

    A pair's count is the number of links that hold it in all of ``docs``; n_best: links whose count is the highest of
    their B id, ties included; count_sum: the counts summed over the text's links. groups_sha256 hashes
    ``a1,a2|b1;a3|b2,b3``, the ids of each group. A null or empty text, and one that a tokenizer does not give back
    byte for byte (a U+2581 of its own), has no tokens: zeros and an empty groups_sha256. Every row is kept, repeated rows and
    null ids too; an empty table gives no rows; other columns are left out. Texts are read whole.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "alignment")
    parts = align_blocks(docs, json_path, model_path, id_column, text_column, block_links)
    parts.write.parquet(f"{folder}/parts")
    texts, pairs = (spark.read.schema(parts.schema).parquet(f"{folder}/parts") for _ in range(2))
    pairs = pairs.where("place is not null").select("block", "place", "a", "b", "n")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts.write.parquet(f"{folder}/counts")
    counts = spark.read.schema(counts.schema).parquet(f"{folder}/counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    known = counts.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))
    looked_up = pairs.select("block", "place", "a", "b").join(known, ["a", "b"]).select("block", "place", "n", "best")
    texts = texts.where("place is null").select("block", "row", id_column, *COUNTS[:4], "groups_sha256", "links")
    kept = [id_column, *COUNTS[:4], "n_best", "count_sum", "groups_sha256"]
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", groups_sha256 string"

    def sums(rows: pa.Table, found: pa.Table) -> pa.Table:
        count, best = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        place = found.column("place").to_numpy()
        count[place], best[place] = found.column("n").to_numpy(), found.column("best").to_numpy()
        sizes = zip(rows.column("links").to_pylist(), rows.column("n_links").to_pylist())
        own = [np.frombuffer(links, "<u2" if len(links) == 2 * n else "<u4") for links, n in sizes]
        rows = rows.append_column("n_best", pa.array([int(best[w].sum()) for w in own], pa.int64()))
        return rows.append_column("count_sum", pa.array([int(count[w].sum()) for w in own], pa.int64())).select(kept)

    return (texts.groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(sums, schema))
