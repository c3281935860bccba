"""Toxicity chain and quality network: held-out accuracy, edge cases, and what may enter a score."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import queries
from tallybook.llm.quality import Network, index_vectors, score_quality, train_quality
from tallybook.llm.toxicity import fit_chain, score_toxicity, train_toxicity

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_toxicity_on_held_out_labels(spark, tables):
    docs, labels = tables
    held_out = F.col("doc_id") % 5 == 0
    chain = train_toxicity(docs, labels.where(~held_out), ["toxic"])
    assert chain.categories == ["severe", "toxic"] and chain.models[1].v.shape == (1,)
    rows = score_toxicity(docs.where(held_out), chain).join(labels, "doc_id").select("toxic", "quality", "p_toxic", "p_severe").collect()
    toxic = [r.p_toxic >= 0.5 for r in rows if r.toxic == 1 and r.quality == 1]
    clean = [r.p_toxic >= 0.5 for r in rows if r.toxic == 0]
    assert np.mean(toxic) > 0.95 and np.mean(clean) < 0.005
    # Of junk that is marked toxic many texts hold no such word, so that nothing in them tells.
    every = [r.p_toxic >= 0.5 for r in rows if r.toxic == 1]
    print(f"recall of toxic rows: {np.mean(toxic):.3f} of quality 1, {np.mean(every):.3f} of all")
    assert np.mean(every) > 0.85
    assert all(0 <= r.p_severe <= 1 for r in rows)


def test_later_models_see_out_of_fold_predictions():
    rng = np.random.default_rng(0)
    n = 400
    doc = np.repeat(np.arange(n), 6)
    term = rng.integers(0, 300, 6 * n).astype(np.uint32)
    noise = rng.integers(0, 2, n)  # nothing to learn: in-fold predictions would look telling all the same
    chain = fit_chain(doc, term, {"first": noise, "second": noise}, np.arange(n) % 5)
    assert abs(chain.models[1].v[0]) < 2  # out of fold they look useless, or a little worse
    assert len(chain.models) == 2 and chain.categories == ["first", "second"]


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "fine words here", "x"), (3, "fine words here", "x"),
                                  (None, "you moron " * 4000, "x")], "doc_id long, text string, p_toxic string")
    marks = spark.createDataFrame([(i % 2, i) for i in range(0)], "toxic int, doc_id long")
    none = score_toxicity(docs, train_toxicity(docs, marks, ["toxic"])).collect()
    assert [(r.p_toxic, r.p_severe) for r in none] == [(0.0, 0.0)] * 5
    many = spark.createDataFrame([(i, "you moron" if i % 2 else "kind words") for i in range(60)] + [(99, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, None), (1, 1), (None, 1), (99, 0)], "doc_id long, toxic int")
    got = score_toxicity(docs, train_toxicity(many, marks, ["toxic"])).collect()
    assert len(got) == 5 and got[-1].p_toxic > 0.5 > got[2].p_toxic
    assert score_toxicity(docs.limit(0), train_toxicity(many, marks, ["toxic"])).count() == 0


def test_toxicity_query(spark, tables):
    rows = queries.QUERIES["op9_toxicity_chain"](spark, FOLDER)
    assert rows.columns == ["doc_id", "p_toxic", "p_severe", "toxic"] and rows.count() == tables[0].count()


def test_quality_query_on_held_out_labels(spark, tables):
    rows = queries.QUERIES["op10_quality_classifier"](spark, FOLDER)
    assert dict(rows.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = rows.join(tables[1], "doc_id", "left").collect()
    assert len(rows) == tables[0].count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    good, bad = (np.array([r.score for r in held if r.quality == q]) for q in (1, 0))
    assert (good >= 0.5).mean() > 0.98 and (bad < 0.5).mean() > 0.9
    assert (good[:, None] > bad).mean() > 0.98  # area under the curve


def test_quality_edge_cases(spark):
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (3, "a b", "x"), (None, "LOUD!! " * 9000, "x")], schema)
    marks = spark.createDataFrame([], "doc_id long, quality int")
    got = score_quality(docs, train_quality(docs, marks)).collect()
    assert [r.score for r in got] == [0.5] * 5
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, None), (None, 0)], "doc_id long, quality int")
    model = train_quality(docs, marks)
    got = score_quality(docs, model).collect()
    assert got[0].score == got[1].score and got[2].score == got[3].score and all(0 <= r.score <= 1 for r in got)
    empty = docs.limit(0)
    assert score_quality(empty, train_quality(empty, marks)).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    check = np.arange(3000) % 5 == 0
    p = Network(x, y, check).probability(x[check])
    for low, high in ((0.0, 0.3), (0.3, 0.7), (0.7, 1.0)):
        inside = (p >= low) & (p < high)
        assert abs(p[inside].mean() - y[check][inside].mean()) < 0.12


def test_index_vectors_are_sparse():
    table = index_vectors()
    assert np.abs(table).sum(axis=1).max() <= 4 and (table.sum(axis=1) != 0).any()
