"""Token ids of whole texts for a public byte-level BPE vocabulary.

Texts are cut into the vocabulary's word pieces by vector operations over code points; each distinct
piece is encoded once by the tokenizer library and its ids are copied to all its places. Texts that hold a
special token, or characters newer than the category table, go through the tokenizer as they are.
"""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain

import numpy as np

from tallybook.llm.textkit import span_hashes

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)
CHUNK_CHARS = 1 << 17
SLOTS = 1 << 20  # the cache of pieces: a newer piece takes the slot of an older one
POOL_IDS = 1 << 22  # ids kept for cached pieces; beyond it the cache starts anew. Both bound memory, not results
# White space of the Unicode standard (property White_Space).
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def category_table() -> np.ndarray:
    """Class of each code point below 65,536; unassigned ones and surrogates are UNKNOWN."""
    first = {"L": LETTER, "N": NUMBER, "C": OTHER}
    table = np.full(1 << 16, OTHER, np.uint8)
    for code in range(1 << 16):
        category = unicodedata.category(chr(code))
        table[code] = UNKNOWN if category in ("Cn", "Cs") else first.get(category[0], OTHER)
    table[WHITE] = SPACE
    return table


class PieceTokenizer:
    """encode(texts) gives (ids of all texts, number of ids per text)."""

    def __init__(self, json_path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.one = self.fast._core_bpe.encode_single_piece
        self.table = category_table()
        self.release()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at = np.zeros(SLOTS, np.int64)
        self.size = np.zeros(SLOTS, np.int64)
        self.pool = np.empty(POOL_IDS + POOL_IDS // 2, np.uint32)
        self.used = 0

    def release(self) -> None:
        """Let go of the cache; the next text begins a new one."""
        self.keys = self.at = self.size = self.pool = None

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, counts = [], np.zeros(len(texts), np.int64)
        begin = 0
        while begin < len(texts):
            end, chars = begin + 1, len(texts[begin])
            while end < len(texts) and chars + len(texts[end]) <= CHUNK_CHARS:
                chars += len(texts[end])
                end += 1
            ids, n = self._encode_chunk(texts[begin:end])
            parts.append(ids)
            counts[begin:end] = n
            begin = end
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), counts

    def _encode_chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.table[np.minimum(codes, 0xFFFF)]
        kinds[codes > 0xFFFF] = UNKNOWN
        plain = self.fast is not None and not (kinds == UNKNOWN).any() and not any(s in joined for s in self.special)
        if not plain:
            if self.fast is not None and len(texts) > 1:  # only the texts concerned take the slow way
                one = [self._encode_chunk([t]) for t in texts]
                return np.concatenate([i for i, _ in one]), np.concatenate([n for _, n in one])
            got = [self.exact.encode(t, add_special_tokens=False).ids for t in texts]
            return (np.array([i for ids in got for i in ids], np.uint32), np.array([len(i) for i in got], np.int64))
        lengths = np.array([len(t) for t in texts], np.int64)
        offsets = np.r_[0, np.cumsum(lengths)]
        if not len(codes):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        starts = np.flatnonzero(self.piece_starts(codes, kinds, offsets))
        ends = np.r_[starts[1:], len(codes)]
        source, size = self.places(joined, codes, starts, ends)
        total = np.r_[0, np.cumsum(size)]
        ids = self.pool[np.repeat(source - total[:-1], size) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    @staticmethod
    def piece_starts(codes: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of the vocabulary's pattern begin."""
        n = len(codes)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.r_[np.uint8(255), kinds[:-1]]
        space = kinds == SPACE
        start = edge[:-1] | (kinds != before)
        last_space = space & ~np.r_[space[1:], False] & ~edge[1:]  # followed by a word of the same text
        start |= last_space
        blank = codes == 32
        joins = np.r_[False, (last_space & blank)[:-1]] & ~edge[:-1]  # the blank before a word belongs to it
        start &= ~joins
        # The short endings 's 't 'm 'd 're 've 'll after a lone apostrophe that begins a piece.
        quotes = np.flatnonzero((codes == 39) & start)
        for q in quotes:
            end = offsets[np.searchsorted(offsets, q, side="right")]
            tail = "".join(map(chr, codes[q + 1:min(q + 3, end)]))
            width = 1 if tail[:1] in ("s", "t", "m", "d") else 2 * (tail in ("re", "ve", "ll"))
            if width:
                start[q + 1:q + 1 + width] = False
                if q + 1 + width < end and kinds[q + 1 + width] == LETTER:
                    start[q + 1 + width] = True
        return start

    def places(self, joined: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where in the pool the ids of each piece begin, and how many they are; new pieces are encoded and added."""
        keys = span_hashes(codes, starts, ends) ^ (ends - starts).astype(np.uint64)
        if self.keys is None or self.used > POOL_IDS:
            self.clear()
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        at, size = self.at[slot], self.size[slot]
        fresh = np.flatnonzero(self.keys[slot] != keys)
        if len(fresh):
            distinct, first, back = np.unique(keys[fresh], return_index=True, return_inverse=True)
            first = fresh[first]
            got = [self.one(joined[a:b].encode()) for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            new_size = np.fromiter(map(len, got), np.int64, len(got))
            new_at = self.used + np.cumsum(new_size) - new_size
            ids = np.fromiter(chain.from_iterable(got), np.uint32)
            if self.used + len(ids) > len(self.pool):
                self.pool = np.r_[self.pool, np.empty(len(ids) + POOL_IDS // 2, np.uint32)]
            self.pool[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            at[fresh], size[fresh] = new_at[back], new_size[back]
            spot = slot[first]
            self.keys[spot], self.at[spot], self.size[spot] = distinct, new_at, new_size
        return at, size


_loaded: dict[tuple, PieceTokenizer] = {}


def tokenizer(json_path: str, ranks_path: str | None = None) -> PieceTokenizer:
    """One tokenizer per worker process."""
    key = (json_path, ranks_path)
    if key not in _loaded:
        _loaded[key] = PieceTokenizer(json_path, ranks_path)
    return _loaded[key]
