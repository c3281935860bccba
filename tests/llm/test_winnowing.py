"""Winnowing against a plain version: window by window, rightmost least hash."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallybook.llm import queries
from tallybook.llm.winnowing import BASE, PRIME, edit_check, fingerprints

SF_DIR = "/root/testdata/sf0.001"


BLANK, CUTS = r"\x20\x09-\x0D", "eAEQW05/_еоαאاाา\u3000-\U0010FFFF"


def plain(text, k=4, w=8, unit=8):
    units = re.findall(f"[^{BLANK}{CUTS}]{{0,{unit - 1}}}[^{BLANK}]", text or "")
    h = [xxhash.xxh64_intdigest(u.encode(), seed=42) & PRIME for u in units]
    if not h:
        return [], []
    grams = []
    for i in range(max(len(h) - k + 1, 1)):
        value = h[i]
        for j in range(1, k):
            value = (value * BASE + (h[i + j] if i + j < len(h) else 0)) % PRIME
        grams.append(value)
    kept = []
    for i in range(max(len(grams) - w + 1, 1)):
        window = list(enumerate(grams[i:i + w], i))
        place, value = min(window, key=lambda g: (g[1], -g[0]))
        if (place, value) not in kept:
            kept.append((place, value))
    return [v for _, v in kept], [p for p, _ in kept]


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


CASES = [None, "", " \n", "a", "one two", "x" * 500, "déjà vu 漢字漢字漢字漢字漢字漢字 😀😀😀 end", "same same " * 40,
         "abcdefgh " * 3, " ".join(random.Random(3).choices(["the", "ofthst", "onhave", "rést"], k=4000))]


def test_fingerprints_equal_plain_version(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(CASES)], "doc_id long, text string, hashes int")
    for row in fingerprints(docs).collect():
        assert (row.hashes, row.positions) == plain(CASES[row.doc_id])


@pytest.mark.parametrize("k,w,unit", [(1, 2, 3), (3, 16, 5)])
def test_other_parameters(spark, k, w, unit):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for row in fingerprints(docs, k=k, w=w, unit=unit).collect():
        assert (row.hashes, row.positions) == plain(CASES[row.doc_id], k, w, unit)


def test_match_guarantee(spark):
    shared = "this passage of twenty words or so stands in both texts and has to be seen"
    docs = spark.createDataFrame([(1, "alpha beta gamma " + shared), (2, shared + " delta epsilon")], "doc_id long, text string")
    a, b = (set(r.hashes) for r in fingerprints(docs).collect())
    assert a & b


SCRIPTS = {"letters": "abcdefghijklmnopqrstuvwxyz", "key": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
           "han": "".join(map(chr, range(0x4E00, 0x9000))), "digits": "0123456789", "cyrillic": "".join(map(chr, range(0x430, 0x450)))}


@pytest.mark.parametrize("script", list(SCRIPTS))
def test_a_passage_without_blanks_is_matched_at_any_offset(spark, script):
    rng = random.Random(5)
    passage = "".join(rng.choices(SCRIPTS[script], k=2000))
    before = "".join(rng.choices("xyz", k=30))
    docs = [(i, before[:i] + passage + before[i:]) for i in range(12)]
    rows = fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("doc_id").collect()
    first = set(rows[0].hashes)
    assert all(len(first & set(r.hashes)) >= 0.9 * len(first) for r in rows)


def test_short_shared_passages_share_a_hash(spark):
    """From its first blank or cut character on a passage of w + k - 1 units has one."""
    rng = random.Random(6)
    letters = SCRIPTS["letters"]
    docs, want = [], []
    for i in range(60):
        passage = "e" + " ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(11))
        docs += [(2 * i, "".join(rng.choices(letters, k=rng.randint(0, 9))) + passage + " " + "".join(rng.choices(letters, k=40))),
                 (2 * i + 1, "".join(rng.choices(letters, k=rng.randint(0, 9))) + passage + " z" * 30)]
        want.append(i)
    got = {r.doc_id: set(r.hashes) for r in fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[2 * i] & got[2 * i + 1] for i in want)


def rows_of(docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    out = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        new = edited(text, following)
        own = plain(text)[0]
        out.append((key, len(text), new, own, jaccard(own, plain(new)[0]), jaccard(own, plain(following)[0])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("docs", [
    [(5, "a b c d e f g h i j k l")], [(i, f"word{i} and some more text number {i * i}") for i in range(40)],
    [(7, None), (None, "no id here"), (3, ""), (3, "twice"), (3, "twice"), (-9, "x" * 300), (1 << 60, "far away " * 9)]])
def test_edit_check_small(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cell", F.lit(9)).withColumn("sub", F.lit(1))
    got = [tuple(r) for r in edit_check(frame).select("doc_id", "n_chars", "edited", "hashes", "near_edited", "near_next").collect()]
    assert sorted(got, key=repr) == rows_of(docs)


def test_empty_table(spark):
    assert edit_check(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = {r[0]: r for r in rows_of(docs)}
    got = queries.QUERIES["op3_winnowing_fingerprints"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for row in got:
        _, n, new, own, near, far = want[row.doc_id]
        assert (row.n_chars, row.edited_sha256) == (n, hashlib.sha256(new.encode()).hexdigest())
        assert row.fingerprint == " ".join(f"{h:X}" for h in own)
        assert (row.near_edited, row.near_next) == pytest.approx((near, far))
