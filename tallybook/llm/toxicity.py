"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another: the model of a category sees a document's terms and the
probabilities of the categories before it. For training, those probabilities are out-of-fold predictions,
so that a later model does not learn to trust an earlier one more than it may.

Terms are words (ASCII in lower case) and their first 4, 5 and 6 bytes, as 32-bit hashes. The most telling
ones of a bounded sample of labelled documents are kept; a document is scored by those it has, over its
whole text. The models are a few thousand numbers and travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.textkit import LOWER, chunks, lean, span_hashes, spans, text_buffer

SAMPLE_ROWS = 12_000   # labelled documents the models are fitted on, by least hash of the id
TERMS = 4096
LEAST_DOCS = 5
FOLDS = 5
EARLIER_PENALTY = 3e-3  # holds the weight of an earlier probability down where it tells nothing
PREFIXES = (4, 5, 6)
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def text_terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: (first text, last text, text number from first, term) of every word and word beginning."""
    data, offsets = text_buffer(column)
    for first, last in chunks(offsets):
        piece = data[offsets[first]:offsets[last]]
        codes = LOWER[piece]
        starts, ends, text = spans(NOT_ALNUM[piece], offsets[first:last + 1] - offsets[first])
        docs, terms = [text], [span_hashes(codes, starts, ends) >> np.uint64(32)]
        for n in PREFIXES:
            long = ends - starts > n
            docs.append(text[long])
            terms.append((span_hashes(codes, starts[long], starts[long] + n) ^ np.uint64((n * 0x9E3779B1 << 32) % (1 << 64))) >> np.uint64(32))
        yield first, last, np.concatenate(docs), np.concatenate(terms).astype(np.uint32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Linear:
    """Logistic regression on sparse 0/1 terms and a few dense columns, by accelerated gradient steps."""

    def __init__(self, doc, term, dense, y, terms, penalty=1e-4, steps=250):
        n, k = len(y), dense.shape[1]
        self.w, self.v, self.b = np.zeros(terms), np.zeros(k), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
        counts = np.bincount(term, minlength=terms)
        scale = 1 / np.sqrt(np.maximum(counts, 1) / n + 0.01)  # rare terms learn as fast as frequent ones
        w, v, b = np.zeros(terms), np.zeros(k), self.b
        mw, mv, mb, sw, sv, sb = np.zeros(terms), np.zeros(k), 0.0, np.zeros(terms), np.zeros(k), 0.0
        for t in range(1, steps + 1):
            z = np.bincount(doc, weights=w[term] * scale[term], minlength=n) + dense @ v + b
            error = (sigmoid(z) - y) / n
            gw = np.bincount(term, weights=error[doc], minlength=terms) * scale + penalty * w
            gv, gb = dense.T @ error + EARLIER_PENALTY * v, error.sum()
            mw, mv, mb = 0.9 * mw + 0.1 * gw, 0.9 * mv + 0.1 * gv, 0.9 * mb + 0.1 * gb
            sw, sv, sb = 0.99 * sw + 0.01 * gw**2, 0.99 * sv + 0.01 * gv**2, 0.99 * sb + 0.01 * gb**2
            rate = 0.1 / (1 - 0.9**t)
            fix = 1 - 0.99**t
            w = w - rate * mw / (np.sqrt(sw / fix) + 1e-8)
            v = v - rate * mv / (np.sqrt(sv / fix) + 1e-8)
            b = b - rate * mb / (np.sqrt(sb / fix) + 1e-8)
        self.w, self.v, self.b = w * scale, v, b

    @classmethod
    def of(cls, w: np.ndarray, v: np.ndarray, b: float) -> Linear:
        """A fitted model from its weights."""
        model = cls.__new__(cls)
        model.w, model.v, model.b = w, v, b
        return model

    def probability(self, doc, term, dense):
        return sigmoid(np.bincount(doc, weights=self.w[term], minlength=len(dense)) + dense @ self.v + self.b)


class ToxicityChain:
    """The chain: ``terms`` (sorted), ``categories`` and one linear model each."""

    def __init__(self, terms: np.ndarray, categories: list[str], models: list[Linear]):
        self.terms, self.categories, self.models = terms, categories, models

    def hits(self, text, terms):
        """Distinct (text, term number) pairs among the chain's terms."""
        if not len(self.terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        pairs = np.unique(text[known].astype(np.int64) * len(self.terms) + at[known])
        return pairs // len(self.terms), pairs % len(self.terms)

    def predict(self, doc, term, n) -> np.ndarray:
        """Probabilities, n rows by categories."""
        out = np.zeros((n, 0))
        for model in self.models:
            out = np.column_stack([out, model.probability(doc, term, out)])
        return out


def telling_terms(doc, term, y, most=TERMS, least=LEAST_DOCS) -> np.ndarray:
    """The terms whose share among documents with y = 1 differs most from that among the others (chi-square)."""
    keys, both = np.unique(term, return_counts=True)
    keys, both = keys[both >= least], both[both >= least].astype(float)
    with_y, held = np.unique(term[(y > 0)[doc]], return_counts=True)
    at = np.searchsorted(keys, with_y)
    found = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == with_y) if len(keys) else np.zeros(len(with_y), bool)
    pos = np.zeros(len(keys))
    pos[at[found]] = held[found]
    n, p = len(y), max(y.sum(), 1e-9)
    expected = both * p / n
    score = (pos - expected) ** 2 / np.maximum(expected * (1 - p / n) * (1 - both / (n + 1)), 1e-9)
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(keys[best[score[best] > 0]])


def fit_chain(doc: np.ndarray, term: np.ndarray, labels: dict[str, np.ndarray], fold: np.ndarray,
              severe: str | None = None) -> ToxicityChain:
    """Chain over ``labels`` in their order; ``severe`` names a category derived from the first, which the chain begins with.

    The derived category holds the positive documents of the first label with at least as many telling positive
    terms as half of them have; the models of the labels, whose verdict counts, then see its probability. ``fold`` gives
    each document's fold.
    """
    labels = {name: y.astype(float) for name, y in labels.items()}
    if not labels or not len(fold):
        return ToxicityChain(np.empty(0, np.uint32), ([severe] if severe else []) + list(labels), [])
    first = next(iter(labels))
    chosen = [telling_terms(doc, term, y, TERMS // len(labels)) for y in labels.values()]
    chain = ToxicityChain(np.unique(np.concatenate(chosen)), [], [])
    doc, index = chain.hits(doc, term)
    n = len(fold)
    if severe:
        y = labels[first]
        share = np.bincount(index, weights=y[doc], minlength=len(chain.terms)) / np.maximum(np.bincount(index, minlength=len(chain.terms)), 1)
        count = np.bincount(doc, weights=(share > 0.5)[index], minlength=n)
        derived = ((y == 1) & (count >= np.median(count[y == 1]))).astype(float) if y.any() else np.zeros(n)
        labels = {severe: derived} | labels
    earlier = np.zeros((n, 0))
    for name, y in labels.items():
        out_of_fold = np.zeros(n)
        for f in np.unique(fold):
            train = np.flatnonzero(fold != f)
            if not len(train):
                train = np.arange(n)
            place = np.full(n, -1)
            place[train] = np.arange(len(train))
            held = place[doc] >= 0
            model = Linear(place[doc[held]], index[held], earlier[train], y[train], len(chain.terms))
            test = fold == f
            out_of_fold[test] = model.probability(doc, index, earlier)[test]
        chain.models.append(Linear(doc, index, earlier, y, len(chain.terms)))
        chain.categories.append(name)
        earlier = np.column_stack([earlier, out_of_fold])
    return chain


def labelled_terms(docs: DataFrame, labels: DataFrame, categories: list[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """Terms, key and labels of at most ``rows`` labelled documents, those with the least hashes of their id."""
    chosen = (labels.where(" and ".join(f"`{c}` is not null" for c in categories)).where("id is not null")
              .groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
              .withColumn("key", F.xxhash64("id")).orderBy("key", "id").limit(rows))

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for first, last, text, terms in text_terms(batch.column(0)):
                pairs = np.unique(text.astype(np.uint64) << np.uint64(32) | terms)
                bounds = np.searchsorted(pairs, np.arange(last - first + 1).astype(np.uint64) << np.uint64(32))
                found += [pairs[a:b].astype(np.uint32).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *batch.columns[1:]],
                                             names=["terms", *batch.schema.names[1:]])

    sample = docs.join(F.broadcast(chosen), "id").select(  # SAMPLE_ROWS rows at most
        "text", "key", *[F.col(c).cast("double").alias(c) for c in categories])
    return sample.mapInArrow(lean(extract), "terms binary, key bigint, " + ", ".join(f"`{c}` double" for c in categories))


def fit_rows(batches: Iterable[pa.RecordBatch], categories: list[str], severe: str | None) -> ToxicityChain:
    """The chain fitted on the rows of ``labelled_terms``, whatever their order."""
    rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
    rows.sort(key=lambda r: (r[1], r[0]))
    parts = [np.frombuffer(r[0], np.uint32) for r in rows]
    marks = {c: np.array([r[i] for r in rows]) for i, c in enumerate(categories, 2)}
    doc = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    term = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    return fit_chain(doc, term, marks, np.array([r[1] % FOLDS for r in rows], np.int64), severe)


def train_toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], id_column: str = "doc_id",
                   text_column: str = "text", severe: str | None = "severe", rows: int = SAMPLE_ROWS) -> ToxicityChain:
    """Fit a chain on at most ``rows`` rows of ``labels`` (id, one 0/1 column per category); unlabelled rows are not used.

    One task fits it, on that many rows whatever the input; the driver gets the weights. Null ids and null labels are
    left out, of repeated labels the greatest counts; without any rows the chain has no models.
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    marks = labels.select(F.col(id_column).alias("id"), *categories)

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = fit_rows(batches, categories, severe)
        names = chain.categories
        columns = [pa.array([chain.terms.astype("<u4").tobytes()] * len(names), pa.binary()), pa.array(names, pa.string())]
        weights = [(m.w.tobytes(), m.v.tobytes(), float(m.b)) for m in chain.models] or [(None, None, None)] * len(names)
        columns += [pa.array(c, t) for c, t in zip(zip(*weights), (pa.binary(), pa.binary(), pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["terms", "category", "w", "v", "b"])

    sample = labelled_terms(own, marks, categories, rows).repartition(1)
    got = sample.mapInArrow(lean(fit), "terms binary, category string, w binary, v binary, b double").collect()
    if not got:
        return ToxicityChain(np.empty(0, np.uint32), ([severe] if severe else []) + categories, [])
    models = [Linear.of(np.frombuffer(r.w), np.frombuffer(r.v), r.b) for r in got if r.w is not None]
    return ToxicityChain(np.frombuffer(got[0].terms, "<u4"), [r.category for r in got], models)


def score_toxicity(docs: DataFrame, chain: ToxicityChain, text_column: str = "text") -> DataFrame:
    """``docs`` with p_<category> (double) for each category of the chain; every row is kept.

    Null and empty texts have no terms and get the chain's probability for that; without labelled documents
    all probabilities are 0. Columns of docs with the new names are replaced.
    """
    names = [f"p_{c}" for c in chain.categories]
    columns = [c for c in docs.columns if c not in names]
    where = columns.index(text_column)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for first, last, text, terms in text_terms(batch.column(where)):
                parts.append(chain.predict(*chain.hits(text, terms), last - first))
            p = np.concatenate(parts) if parts else np.zeros((0, len(chain.models)))
            if not chain.models:
                p = np.zeros((batch.num_rows, len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(p[:, i]) for i in range(len(names))]],
                                             names=[*columns, *names])

    schema = docs.select(*columns).schema
    for name in names:
        schema = schema.add(name, "double")
    return docs.select(*columns).mapInArrow(lean(score), schema)
