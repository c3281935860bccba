"""Vector packing: whole examples, the three limits, padding, and ids against the tokenizer library."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tallybook.llm import queries
from tallybook.llm.vector_packing import Limits, Packer, WordTokenizer, pack_examples

FOLDER, WORDS = "/root/testdata/sf0.01", path("word_bpe_49k.json")


def pack(examples, limits, waiting, cut):
    packer = Packer(limits, waiting, cut)
    sequences = [s for i, (n, bare) in enumerate(examples) for s in packer.add(i, n, bare)]
    return sequences + packer.finish()


def check_whole(examples, sequences):
    seen = defaultdict(list)
    for pieces in sequences:
        assert pieces
        for item, start, length in pieces:
            seen[item].append((start, length))
    for i, (n, _) in enumerate(examples):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at and length > 0
            at += length
        assert at == n


def loss_of(examples, pieces):
    return sum(max(start + length - max(start, examples[i][1]), 0) for i, start, length in pieces)


example = st.integers(1, 90).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n)))


@given(st.lists(example, max_size=60), st.integers(1, 70), st.integers(1, 6), st.integers(1, 70), st.integers(1, 9))
@settings(max_examples=600, deadline=None)
def test_cut_examples_stay_whole_within_all_limits(examples, tokens, segments, loss, waiting):
    sequences = pack(examples, Limits(tokens, segments, loss), waiting, True)
    check_whole(examples, sequences)
    for pieces in sequences:
        n = sum(p[2] for p in pieces)
        assert n <= tokens and len(pieces) <= segments and loss_of(examples, pieces) <= loss
        assert n == tokens or n & (n - 1) == 0  # full, or a power of two


@given(st.lists(example, max_size=60), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_uncut_examples_are_cut_only_beyond_a_limit(examples, waiting):
    limits = Limits(64, 4, 48)
    sequences = pack(examples, limits, waiting, False)
    check_whole(examples, sequences)
    pieces_of = defaultdict(int)
    for pieces in sequences:
        assert sum(p[2] for p in pieces) <= 64 and len(pieces) <= 4 and loss_of(examples, pieces) <= 48
        for p in pieces:
            pieces_of[p[0]] += 1
    for i, (n, bare) in enumerate(examples):
        assert pieces_of[i] == 1 or n > 64 or n - bare > 48


def test_the_dot_product_pairs_what_is_scarce_with_what_is_not():
    """Long questions go with long answers where the loss limit would else leave half of each sequence empty."""
    examples = [(50, 50), (50, 0)] * 40
    sequences = pack(examples, Limits(100, 9, 50), 16, False)
    assert len(sequences) <= 42 and sum(len(s) == 2 for s in sequences) >= 38


def test_limits_of_nothing_are_refused():
    with pytest.raises(ValueError):
        Packer(Limits(segments=0))


def test_words_are_encoded_as_in_their_texts():
    texts = ["", "  ", "It's THE 12 İstanbul ΣΑΣ café café", "á ́b", "<|endoftext|>x y<|startoftext|>", "日本 語 x y",
             "x" * 5000, "it 's don't\r\n\tDON'T", "\x00a \x1c b", " ".join(map(str, range(3000)))]
    library = Tokenizer.from_file(WORDS)
    ids, counts = WordTokenizer(WORDS).encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def placed(rows):
    """The rows of each sequence in their order; offsets have no gap."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
    return sequences


def test_nulls_empty_texts_repeats_and_an_empty_table(spark):
    long = "word " * 9000
    rows = [(1, "a b c", None), (1, "a b c", None), (None, None, "x"), (4, "", "y"), (5, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    got = pack_examples(docs, WORDS).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in got if r.start == 0) == [(0, 1), (1, 4), (1, 4), (4, 1), (5, 9001)]
    assert sum(r.length for r in got) == 4 + 4 + 1 + 1 + 9001
    assert all(n == 4096 or n & (n - 1) == 0 for n in (sum(r.length for r in s) for s in placed(got).values()))
    assert pack_examples(docs.limit(0), WORDS).count() == 0


def test_conversations_as_instruction_data(spark):
    """The last answer of each conversation bears loss; what leads up to it does not."""
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    from pyspark.sql import functions as F
    one = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    examples = one.select("conv_id", F.expr("array_join(transform(slice(t, 1, size(t) - 1), x -> coalesce(x.text, '')), '\\n')").alias("prompt"),
                          F.expr("t[size(t) - 1].text").alias("answer"))
    limits = Limits(tokens=512, segments=8, loss_tokens=160)
    got = pack_examples(examples, WORDS, id_column="conv_id", text_column="prompt", answer_column="answer", limits=limits,
                        cut=False).collect()
    library = Tokenizer.from_file(WORDS)
    texts = {r.conv_id: r for r in examples.collect()}
    assert {r.conv_id for r in got} == set(texts)
    for pieces in placed(got).values():
        assert sum(r.length for r in pieces) <= 512 and len(pieces) <= 8 and sum(r.loss_tokens for r in pieces) <= 160
    for r in got:
        if r.length == r.doc_tokens:
            answer = library.encode(texts[r.conv_id].answer or "", add_special_tokens=False).ids
            assert r.loss_tokens == len(answer) + 1
            assert np.frombuffer(r.ids, "<u4")[-len(answer) - 1:].tolist() == [*answer, 2]


def test_query_holds_every_id_once_and_pads_nothing(spark):
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {d: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in docs}
    rows = queries.op11_vector_packing(spark, FOLDER).collect()
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(want[r.doc_id]) and len(ids) == r.length
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        at[r.doc_id] += r.length
    assert at == {d: len(i) for d, i in want.items()}
    sizes = [sum(r.length for r in pieces) for pieces in placed(rows).values()]
    assert all(n == 4096 or n & (n - 1) == 0 for n in sizes)
    assert sum(n < 4096 for n in sizes) < 13 + sum(sizes) // 4096 // 20
