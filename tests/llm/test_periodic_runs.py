"""Runs by catchers over blocks against a plain search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm import queries
from tallybook.llm.periodic_runs import detect_runs, find_runs
from tallybook.llm.textkit import mix

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, least=6, power=4):
    """Every stretch with equal words at distance q, for every q; the smallest q of a stretch stands."""
    found, n = {}, len(words)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


part = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 12), st.integers(0, 8))


@given(st.lists(part, max_size=6), st.integers(1, 5), st.integers(4, 6))
@settings(max_examples=600, deadline=None)
def test_runs_equal_plain_search(parts, nested, power):
    words = [w for base, times, rest in parts for w in base * times + base[:rest]]
    words = words * nested
    names = mix(np.array(words, np.uint64) + np.uint64(1))
    got = [(s, e - s, q) for s, e, q in find_runs(names, power=power)]
    assert got == plain_runs(words, power=power)


def test_cost_does_not_depend_on_what_repeats():
    for period in (1, 3, 1 << 12, 1 << 17):
        names = np.tile(mix(np.arange(period, dtype=np.uint64)), (1 << 20) // period)[:1 << 20]
        assert find_runs(names) == [(0, len(names), period)]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError, match="four|4"):
        find_runs(np.zeros(9, np.uint64), power=2)


def test_texts_of_every_kind(spark):
    texts = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "a a a a a a", "x a b a b\ta b a b a y", "é é é é é é\x0bé",
             "b " * 70_000, " ".join(f"{i % 5000}" for i in range(30_000)), "a a a a a a a a"]
    rows = [(None if i == 3 else i, t, "kept", 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, other int")
    got = {(r.doc_id, r.text, r.other): r for r in detect_runs(docs).collect()}
    assert len(got) == len(texts)
    for i, text, _, seven in rows:
        r = got[i, text, seven]
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want = ([(0, len(words), 1)] if words[:1] == ["b"] else [(0, 30_000, 5000)] if len(words) == 30_000 else plain_runs(words))
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), want)
        assert r.collapsed == collapsed(words, want)
    assert detect_runs(docs.limit(0)).count() == 0


def test_a_run_does_not_reach_into_the_next_text(spark):
    docs = spark.createDataFrame([(1, "x x x"), (2, "x x x"), (3, ""), (4, "x x")], "doc_id int, text string").coalesce(1)
    assert [r.runs for r in detect_runs(docs).collect()] == [[], [], [], []]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, folder).collect()}
    assert len(got) == len(docs)
    with_runs = 0
    for doc_id, text in docs:
        words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if len(words) > 1200:  # the plain search is quadratic; the long ones are left to the other test
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        with_runs += bool(runs)
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert with_runs > len(docs) // 40
