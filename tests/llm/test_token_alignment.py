"""Aligned tokens against a plain version that works on the decoded bytes of every token of a whole text."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallybook.llm import queries
from tallybook.llm.token_alignment import Aligner, align_tokens, byte_values, refined_ends

BYTES, PIECES = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
        self.a.encode_special_tokens = True
        self.value = byte_values()

    def tokens(self, text):
        """(id, bytes) of A and of B; nothing where the joined bytes are not the text's."""
        if not text:
            return [], []
        a = [(i, bytes(self.value[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode())
             for i in self.b.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def one(self, text):
        """Numbers of tokens, groups' text and the linked pairs of one text."""
        a, b = self.tokens(text)
        spans = [(np.cumsum([0, *[len(x) for _, x in t]]).tolist(), [i for i, _ in t]) for t in (a, b)]
        (at_a, ids_a), (at_b, ids_b) = spans
        links = [(ids_a[i], ids_b[j]) for i in range(len(a)) for j in range(len(b))
                 if at_a[i] < at_b[j + 1] and at_b[j] < at_a[i + 1]]
        groups, last = [], 0
        for end in sorted((set(at_a) & set(at_b)) - {0}):
            inside = [",".join(str(i) for i, e in zip(ids, at[1:]) if last < e <= end) for at, ids in spans]
            groups.append("|".join(inside))
            last = end
        return len(a), len(b), groups, links

    def all(self, texts):
        found = [self.one(t) for t in texts]
        count = Counter(p for f in found for p in f[3])
        highest = {}
        for (_, b), n in count.items():
            highest[b] = max(highest.get(b, 0), n)
        return [(a, b, len(groups), len(links), sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links),
                 hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "") for a, b, groups, links in found]


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def work():
    return Aligner(BYTES, PIECES)


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b   c", "é", "日本語 テスト", "🦥🦥 x🦥", "naïve café́", "<|endoftext|> <s> </s> <unk>",
         "<0x0A>", "a\nb\r\n\tc", "x\x00y", "a▁b", "▁", "I'll we've 'tis IT'S", "مرحبا بالعالم", "한국어 문장", " x y\u0085z", "👩‍👩‍👧‍👦",
         "1234567 3.14", "=" * 300, "a" * 2000, " \n" * 40, "\U0001FAE8 new", "͸ ͸x", "ΣΑΣ x", "a​b", "﻿x", "ab" * 700 + "é" * 90]


def check(work, plain, texts):
    numbers, groups, pairs = work.align(texts)
    at = 0
    for k, text in enumerate(texts):
        a, b, want, links = plain.one(text)
        assert numbers[:, k].tolist() == [a, b, len(want), len(links)], text
        assert groups[k] == ";".join(want)
        assert pairs[at:at + len(links)].tolist() == [i * work.ids_of_b + j for i, j in links]
        at += len(links)
    assert at == len(pairs)


def test_texts_of_every_kind(work, plain):
    check(work, plain, TEXTS)
    for text in TEXTS:
        check(work, plain, [text])


@given(st.lists(st.text(st.sampled_from("ab é\n'sŁ日🦥▁  .1"), max_size=30), min_size=1, max_size=5))
@settings(max_examples=250, deadline=None)
def test_any_text(work, plain, texts):
    check(work, plain, texts)


@given(st.lists(st.text(max_size=25), min_size=1, max_size=4))
@settings(max_examples=250, deadline=None)
def test_any_characters(work, plain, texts):
    check(work, plain, [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)] or [""])


def test_offsets_are_refined_by_decoded_bytes():
    # Two tokens that both claim a character of three bytes; a token that claims none; all before a sure one.
    first, end = np.array([0, 1, 1, 4, 4]), np.array([1, 4, 4, 4, 6])
    assert refined_ends(first, end, np.array([1, 1, 2, 1, 1])).tolist() == [1, 2, 4, 5, 6]


def test_nulls_repeats_clashing_columns_and_an_empty_table(spark, plain):
    texts = [None, *TEXTS, TEXTS[8], "word " * 60_000]
    rows = [(None if i % 7 == 3 else i % 20, t, 1.5, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_a double, block string, links string")
    got = align_tokens(docs.repartition(3), BYTES, PIECES, block_links=200)
    assert got.columns == ["doc_id", *COLUMNS]
    small = [r for r in texts[:-1]]
    counts = got.collect()
    assert len(counts) == len(rows)
    assert sorted(map(repr, ((r.doc_id, r.n_a, r.groups_sha256) for r in counts if r.n_a < 50_000))) == sorted(
        map(repr, ((d, w[0], w[6]) for (d, *_), w in zip(rows, plain.all(small)))))
    assert align_tokens(docs.limit(0), BYTES, PIECES).count() == 0


def test_counts_do_not_depend_on_blocks(spark, plain):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id long, text string")
    want = sorted((i, *w) for i, w in enumerate(plain.all(TEXTS * 2)))
    for blocks, parts in ((1, 5), (1 << 20, 1)):
        got = align_tokens(docs.repartition(parts), BYTES, PIECES, block_links=blocks).collect()
        assert sorted(tuple(r) for r in got) == want


def test_query_equals_brute_force(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = [(d, t) for d, t in docs if len(t or "") < 3000]
    frame = spark.createDataFrame(short, "doc_id long, text string")
    want = sorted((d, *w) for (d, _), w in zip(short, plain.all([t for _, t in short])))
    assert sorted(tuple(r) for r in align_tokens(frame, BYTES, PIECES).collect()) == want
    whole = queries.op12_token_alignment(spark, folder).collect()
    assert len(whole) == len(docs) and {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in whole if r.doc_id in dict(short)} \
        == {w[0]: (*w[1:5], w[7]) for w in want}


def test_a_block_with_more_pairs_than_sixteen_bits_count(spark, plain):
    """Many different words in one block: places take 32 bits there."""
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(60_000)]
    docs = spark.createDataFrame([(i, " ".join(words[i::40])) for i in range(40)], "doc_id long, text string").coalesce(1)
    wide = {r.doc_id: tuple(r) for r in align_tokens(docs, BYTES, PIECES).collect()}
    narrow = {r.doc_id: tuple(r) for r in align_tokens(docs, BYTES, PIECES, block_links=2000).collect()}
    assert wide == narrow and len(wide) == 40
