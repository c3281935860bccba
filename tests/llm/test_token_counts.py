"""Word pieces by the automaton against greedy search for the longest piece."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

from tallybook.llm import queries
from tallybook.llm.token_counts import Automaton, count_pieces

MODEL = path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.01"


def greedy(pieces, word, start="▁"):
    word, at, n = start + word, 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


@given(st.sets(st.text("ab▁", min_size=1, max_size=5), max_size=14), st.lists(st.text("abc", max_size=12), max_size=20))
@settings(max_examples=400, deadline=None)
def test_automaton_equals_greedy(pieces, words):
    automaton = Automaton(pieces)
    assert [automaton.count(w) for w in words] == [greedy(pieces, w) for w in words]


@pytest.fixture(scope="module")
def vocabulary():
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=MODEL)
    return {m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))}


def plain(vocabulary, text):
    counts = [greedy(vocabulary, w) for w in (text or "").replace("\x0b", " ").split()] if (text or "").isascii() else [
        greedy(vocabulary, w) for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    return len(counts), sum(map(abs, counts)), sum(c < 0 for c in counts)


def test_edge_cases(spark, vocabulary):
    texts = [None, "", " \n", "a", "déjà vu 漢字 \U000e0001x", "word " * 5000, "x" * 3000, "It's 100% — ▁ ok so"]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    for r in count_pieces(docs, MODEL).collect():
        assert (r.n_words, r.n_pieces, r.n_unknown) == plain(vocabulary, texts[r.doc_id])
    assert count_pieces(docs.limit(0), MODEL).count() == 0


def test_query(spark, vocabulary):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_token_counts"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_pieces, r.n_unknown) == plain(vocabulary, texts[r.doc_id])
