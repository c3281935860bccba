"""Document quality: random-indexing word vectors, pooled per document, and a small calibrated network.

Word vectors come from all documents: every word adds the sparse random +1/-1 index vectors of its
neighbours, two on each side, to its own row. Words share ``ROWS`` rows by hash, so that the table has a
fixed size. A document is the mean of its words' vectors, the greatest and least means over stretches of
``STRETCH`` words, how like successive words are, and what share of them is in capitals. A two-layer network in numpy gives a logit, and a temperature fitted on rows that it has not seen
turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.textkit import chunks, class_runs, mix, span_hashes, text_buffer

ROW_BITS, DIMS, NONZERO = 15, 32, 4
ROWS = 1 << ROW_BITS
PART = 1024          # rows of the table that travel together
STRETCH = 64
FEATURES = 3 * DIMS + 6
SAMPLE_ROWS = 20_000  # labelled documents the network is fitted on, by least hash of the id
HIDDEN, EPOCHS, BATCH, SEED = 32, 40, 128, 7


def index_vectors() -> np.ndarray:
    """The index vector of each row: NONZERO entries of +1 or -1 at places given by hashes."""
    table = np.zeros((ROWS, DIMS), np.int16)
    rows = np.arange(ROWS)
    for k in range(NONZERO):
        h = mix(rows.astype(np.uint64) * np.uint64(2 * k + 3) + np.uint64(k << 40))
        table[rows, (h % np.uint64(DIMS)).astype(int)] += np.where(h >> np.uint64(63), 1, -1).astype(np.int16)
    return table


def word_rows(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For ranges of texts: (first text, last text, text number from first, row of the table, in capitals) of every word."""
    data, offsets = text_buffer(column)
    for first, last in chunks(offsets):
        piece = data[offsets[first]:offsets[last]]
        starts, ends, text = class_runs(piece, offsets[first:last + 1] - offsets[first])
        capital = np.r_[0, np.cumsum((piece >= 65) & (piece <= 90))]
        loud = (capital[ends] - capital[starts] == ends - starts) & (ends - starts > 1)
        yield first, last, text, (span_hashes(piece, starts, ends) >> np.uint64(64 - ROW_BITS)).astype(np.int64), loud


def word_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The table of word vectors over all documents (float32, unit rows): each task's sums are added by parts."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums, counts = index_vectors(), np.zeros((DIMS, ROWS)), np.zeros(ROWS)
        for batch in batches:
            for _, _, text, rows, _ in word_rows(batch.column(0)):
                context = np.zeros((len(rows), DIMS), np.int16)
                for step in (1, 2):
                    if len(rows) > step:
                        same = (text[step:] == text[:-step])[:, None]
                        context[step:] += index[rows[:-step]] * same
                        context[:-step] += index[rows[step:]] * same
                for d in range(DIMS):
                    sums[d] += np.bincount(rows, weights=context[:, d], minlength=ROWS)
                counts += np.bincount(rows, minlength=ROWS)
        if counts.any():
            table = np.column_stack([sums.T, counts]).astype("<f4")
            parts = [table[i:i + PART].tobytes() for i in range(0, ROWS, PART)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                             names=["part", "sums"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(sums, "<f4").astype(np.float64)
                total[part] = total[part] + own if part in total else own
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                              pa.array([t.astype("<f8").tobytes() for t in total.values()], pa.binary())],
                                             names=["part", "sums"])

    schema = "part int, sums binary"
    table = np.zeros((ROWS, DIMS + 1))
    found = docs.select(text_column).mapInArrow(gather, schema).repartition("part").mapInArrow(add, schema)
    for row in found.collect():  # ROWS * (DIMS + 1) numbers, whatever the input
        table[row.part * PART:(row.part + 1) * PART] = np.frombuffer(row.sums, "<f8").reshape(PART, DIMS + 1)
    sums, counts = table[:, :DIMS], table[:, DIMS:]
    vectors = sums / np.maximum(counts, 1)
    vectors -= (vectors * counts).sum(axis=0) / max(counts.sum(), 1)  # what all words have in common says nothing
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.where((norm > 0) & (counts > 0), vectors / np.maximum(norm, 1e-9), 0).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of FEATURES numbers per text; zeros for a text without words."""
    out = []
    for first, last, text, rows, loud in word_rows(column):
        n = last - first
        features = np.zeros((n, FEATURES), np.float32)
        if len(rows):
            own = vectors[rows]
            count = np.bincount(text, minlength=n)
            begin = np.r_[0, np.cumsum(count)[:-1]]
            place = np.arange(len(rows)) - begin[text]
            starts = np.flatnonzero(place % STRETCH == 0)
            sizes = np.diff(np.r_[starts, len(rows)])[:, None]
            like = np.zeros(len(rows), np.float32)
            like[1:] = (own[1:] * own[:-1]).sum(axis=1)
            like[place == 0] = 0
            same = np.zeros(len(rows), np.float32)
            same[1:] = rows[1:] == rows[:-1]
            same[place == 0] = 0
            columns = np.column_stack([own, like, same, loud.astype(np.float32)])
            means = np.add.reduceat(columns, starts, axis=0) / sizes
            holder = text[starts]
            full = np.flatnonzero(count > 0)
            at = np.searchsorted(holder, full)
            whole = np.add.reduceat(columns, begin[full], axis=0) / count[full, None]
            high, low = np.maximum.reduceat(means, at, axis=0), np.minimum.reduceat(means, at, axis=0)
            features[full] = np.column_stack([whole, high, low[:, :DIMS]])
        out.append(features)
    return np.concatenate(out) if out else np.zeros((0, FEATURES), np.float32)


class Network:
    """Two layers: tanh of HIDDEN units, then one logit; divided by a temperature for the probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray, check: np.ndarray):
        """Fits on the rows outside ``check`` and the temperature on those inside."""
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        a, b = self.standard(x[~check]), y[~check]
        rate = float(np.clip(b.mean() if len(b) else 0.5, 0.01, 0.99))
        self.params = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                       rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.array(np.log(rate / (1 - rate)))]
        first, second = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(a))
            for i in range(0, len(order), BATCH):
                step += 1
                rows = order[i:i + BATCH]
                hidden = np.tanh(a[rows] @ self.params[0] + self.params[1])
                error = (1 / (1 + np.exp(-np.clip(hidden @ self.params[2] + self.params[3], -40, 40))) - b[rows]) / len(rows)
                back = np.outer(error, self.params[2]) * (1 - hidden**2)
                slopes = [a[rows].T @ back + 1e-4 * self.params[0], back.sum(axis=0), hidden.T @ error + 1e-4 * self.params[2],
                          error.sum()]
                pace = 3e-3 * (1 - epoch / EPOCHS)
                for k, g in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.params[k] = self.params[k] - pace * (first[k] / (1 - 0.9**step)) / (
                        np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.temperature = 1.0
        if check.any():
            logits, truth = self.logits(x[check]), y[check]
            tried = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
            loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in tried]
            self.temperature = float(tried[int(np.argmin(loss))])

    def standard(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logits(self, x):
        return np.tanh(self.standard(x) @ self.params[0] + self.params[1]) @ self.params[2] + self.params[3]

    def probability(self, x):
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


class QualityModel:
    def __init__(self, vectors: np.ndarray, network: Network | None):
        self.vectors, self.network = vectors, network


def train_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  label_column: str = "quality", rows: int = SAMPLE_ROWS) -> QualityModel:
    """Word vectors from all of ``docs``; the network from at most ``rows`` rows of ``labels``.

    A fifth of the sample fits the temperature only. Ids choose rows and never enter a score.
    """
    spark = docs.sparkSession
    vectors = word_vectors(docs, text_column)
    shared = spark.sparkContext.broadcast(vectors)
    chosen = (labels.where(f"`{label_column}` is not null and `{id_column}` is not null")
              .groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("double").alias("label"))
              .withColumn("key", F.xxhash64("id")).orderBy("key", "id").limit(rows))

    def pool(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column(0), shared.value)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1), batch.column(2)],
                                             names=["x", "label", "key"])

    sample = (docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
              .join(F.broadcast(chosen), "id").select("text", "label", "key"))  # SAMPLE_ROWS rows at most
    got = sorted(sample.mapInArrow(pool, "x binary, label double, key bigint").collect(), key=lambda r: (r.key, r.x))
    if not got:
        return QualityModel(vectors, None)
    x = np.array([np.frombuffer(r.x, np.float32) for r in got], np.float64)
    network = Network(x, np.array([r.label for r in got]), np.array([r.key % 5 == 0 for r in got]))
    return QualityModel(vectors, network)


def score_quality(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, double); only the text enters it. Every row is kept.

    Null and empty texts get the score of a text without words; without any labels every score is 0.5.
    A column of docs named score is replaced.
    """
    columns = [c for c in docs.columns if c != "score"]
    where = columns.index(text_column)
    shared, network = docs.sparkSession.sparkContext.broadcast(model.vectors), model.network

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = network.probability(pooled(batch.column(where), shared.value)) if network else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*columns, "score"])

    return docs.select(*columns).mapInArrow(score, docs.select(*columns).schema.add("score", "double"))
