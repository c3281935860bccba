"""Near-duplicate classes against all pairs of plain shingle sets."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import ngram_join, queries
from tallybook.llm.components import _with_least, connected_components
from tallybook.llm.ngram_join import near_duplicate_classes
from tallybook.session import scratch_dir


def shingles(text, width=5):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, 1)))


def plain(docs, percent=75):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) or percent < 75:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((key, len(s), least[find(i)]) for i, ((key, _), s) in enumerate(zip(docs, sets)))


def family(seed, n, words=60, edits=3, vocabulary=400):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"w{rng.randrange(vocabulary)}"
        out.append(" ".join(own[:words - rng.randrange(4)]))
    return out


def run(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    return sorted(map(tuple, near_duplicate_classes(frame).collect()))


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b c d e"), (8, "A B C D E"),
            (9, "a b c d e f"), (9, "a b c d e f"), (10, "x y " * 500), (11, "y x " * 400), (12, "é É"), (13, "É é"), (-5, "A b c d E")]
    assert run(spark, docs) == plain(docs)


@pytest.mark.parametrize("small_group", [64, 3])
def test_families_equal_all_pairs(spark, monkeypatch, small_group):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small_group)
    texts = [t for s in range(12) for t in family(s, 12, words=20 + 9 * s, edits=1 + s % 5)] + family(99, 120, edits=6)
    texts += [f"all rights reserved by nobody in particular {t}" for t in family(7, 30, words=12, edits=8)]
    random.Random(5).shuffle(texts)
    docs = list(enumerate(texts))
    want = plain(docs)
    assert run(spark, docs) == want
    assert len({c for _, _, c in want}) < len(docs) - 100


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.QUERIES["op1_ngram_jaccard_join"](spark, folder).collect()))
    assert got == plain(docs)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    nodes = rng.sample(range(-10**6, 10**6), 300)
    links = [(a, b) for chain in (nodes[:180], nodes[180:]) for a, b in zip(chain, chain[1:])] + [(5, 5)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in connected_components(frame, scratch_dir(spark, "chain")).collect()}
    for chain in (nodes[:180], nodes[180:]):
        assert {got.get(x, x) for x in chain} == {min(chain)}


def test_no_growing_table_is_broadcast(spark):
    """However few the rows are here: what grows with the documents stays with the executors."""
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(40)], "id long, text string")
    job = ngram_join.JaccardJoin(docs, 5, 75)
    job.reps = docs.select((F.col("id") + 100).alias("h"), "id")
    texts = job.with_text(spark.createDataFrame([(h, True) for h in (101, 117, 117, 139, 999)], "h long, probe boolean"), "some")
    edges = _with_least(spark.createDataFrame([(9, 1), (9, 2), (4, 2)], "u long, v long"))
    assert sorted((r.id, r.h, r.text) for r in texts.collect()) == [(k, k + 100, f"text number {k}") for k in (1, 17, 17, 39)]
    assert sorted(map(tuple, edges.select("u", "v", "low").collect())) == [(4, 2, 2), (9, 1, 1), (9, 2, 1)]
    for frame in (texts, edges):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 3, 5000, 60_000])
def test_the_table_of_bits_has_all_that_it_was_made_of(spark, monkeypatch, n):
    monkeypatch.setattr(ngram_join, "FILTER_BITS", 19)
    rows = spark.range(100_000).withColumn("at", F.xxhash64("id"))
    table = ngram_join.marked(rows.where(F.col("id") < n).select("at"), n)
    assert len(table) == 1 << min(19, max(10, (16 * n).bit_length())) - 3
    found = {r.id for r in ngram_join.among(rows, type("Held", (), {"value": table})).collect()}
    assert found >= set(range(n)) and len(found) - n <= (100_000 - n) * min(1.2 * n / (8 * len(table)), 1) + 20
    assert np.unpackbits(table).sum() <= n


def test_few_bits_give_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FILTER_BITS", 10)
    docs = list(enumerate(t for s in range(150) for t in family(s, 6, words=30)))
    assert run(spark, docs) == plain(docs)
