"""Quality scores by a factorisation machine.

A text is a sparse vector of hashed words, each weighing its share of the text's
words, beside a few statistics of its structure and the length its metadata give.
Every pair of features interacts through the product of low-rank vectors; by the
identity ``sum_{i<j} <v_i, v_j> x_i x_j = ((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2``
scoring takes time linear in the number of features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm import words

#: Labelled rows the machine is fitted on, at most: those first by hash of their id.
SAMPLE_ROWS = 8_000
BUCKETS = 1 << 16
RANK = 6
EPOCHS = 12
BATCH = 256
#: Weight of the words of a text taken together.
WORD_WEIGHT = 8.0

#: Byte classes counted per text: lower, upper, digit, white space, line break,
#: sentence punctuation, other ASCII punctuation, bytes above ASCII.
_CLASSES = np.full(256, 6, dtype=np.int64)
_CLASSES[0x61:0x7B], _CLASSES[0x41:0x5B], _CLASSES[0x30:0x3A] = 0, 1, 2
_CLASSES[:0x21], _CLASSES[0x0A] = 3, 4
_CLASSES[[0x2E, 0x2C, 0x21, 0x3F, 0x3B, 0x3A, 0x27]], _CLASSES[0x80:] = 5, 7
_N_CLASSES = 8
STATISTICS = _N_CLASSES + 9


def in_fold(doc_id: str, number: int, folds: int = 5) -> Column:
    """Whether the checksum of an id falls into a fold; a null id is in none."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == number, F.lit(False))


@dataclass
class Sparse:
    """Features of several texts: buckets and weights of words text by text, and dense statistics."""

    bucket: np.ndarray
    weight: np.ndarray
    first: np.ndarray     # n + 1
    dense: np.ndarray     # n x STATISTICS


def features(data: np.ndarray, bounds: np.ndarray, n_chars: np.ndarray) -> Sparse:
    """Features of a chunk of texts; ``n_chars`` is the metadata's length, nan where unknown."""
    w, n = words.words(data, bounds), len(bounds) - 1
    bucket = (w.hash % np.uint64(BUCKETS)).astype(np.int64)
    # one entry per text and word
    both, count = np.unique(w.doc * BUCKETS + bucket, return_counts=True)
    doc = both // BUCKETS
    first = np.searchsorted(doc, np.arange(n + 1))
    total = np.bincount(w.doc, minlength=n).astype(float)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    classes = np.bincount(owner * _N_CLASSES + _CLASSES[data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    size = np.maximum(np.diff(bounds), 1)[:, None]
    some = np.maximum(total, 1)
    lines = classes[:, 4] + 1
    # words that end in a symbol, and those all in capitals
    last = data[w.end - 1] if len(w.end) else data[:0]
    symbol = np.bincount(w.doc, weights=_CLASSES[last] == 6, minlength=n)
    capital = np.bincount(w.doc, weights=(_CLASSES[data[w.start]] == 1) if len(w.start) else None, minlength=n)
    stop = np.bincount(w.doc, weights=_CLASSES[last] == 5, minlength=n)
    length = np.bincount(w.doc, weights=w.end - w.start, minlength=n)
    again = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1]))
    repeated = np.bincount(w.doc[again], minlength=n)
    extra = np.stack([np.sqrt(repeated / some), np.log1p(total), length / some / 8, np.diff(first) / some, np.log1p(total / lines), symbol / some,
                      capital / some, stop / some, np.where(np.isnan(n_chars), np.log1p(np.diff(bounds)), np.log1p(np.maximum(n_chars, 0)))], axis=1)
    dense = np.concatenate([np.sqrt(classes / size), extra], axis=1)
    return Sparse(both % BUCKETS, (WORD_WEIGHT * count / some[doc]).astype(np.float32), first, dense)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray    # BUCKETS + STATISTICS
    factor: np.ndarray    # (BUCKETS + STATISTICS) x RANK
    mean: np.ndarray
    scale: np.ndarray

    def scaled(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.scale, -4, 4)

    def sums(self, x: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw scores, sums of weighted factors per text, and scaled statistics."""
        dense, n = self.scaled(x.dense), len(x.first) - 1
        v = self.factor[x.bucket] * x.weight[:, None]
        parts = np.concatenate([v, v * v, (self.linear[x.bucket] * x.weight)[:, None]], axis=1)
        summed = np.zeros((n, parts.shape[1]))
        filled = np.flatnonzero(np.diff(x.first))
        if len(filled):
            summed[filled] = np.add.reduceat(parts, x.first[filled], axis=0)
        own = self.factor[BUCKETS:]
        total = summed[:, :RANK] + dense @ own
        squares = summed[:, RANK:2 * RANK].sum(1) + (dense * dense) @ (own * own).sum(1)
        raw = self.bias + summed[:, -1] + dense @ self.linear[BUCKETS:] + 0.5 * ((total * total).sum(1) - squares)
        return raw, total, dense

    def score(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(x)[0], -35, 35)))


def take(x: Sparse, rows: np.ndarray) -> Sparse:
    size = np.diff(x.first)[rows]
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(x.first[rows] - first[:-1], size) + np.arange(first[-1])
    return Sparse(x.bucket[at], x.weight[at], first, x.dense[rows])


def fit(x: Sparse, label: np.ndarray, seed: int = 1) -> Machine:
    """AdaGrad on the logistic loss. Without rows every text scores one half."""
    rng, size = np.random.default_rng(seed), BUCKETS + STATISTICS
    if not len(label):
        return Machine(0.0, np.zeros(size), np.zeros((size, RANK)), np.zeros(STATISTICS), np.ones(STATISTICS))
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, RANK)),
                x.dense.mean(0), np.maximum(x.dense.std(0), 1e-3))
    past, past_v, past_bias = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            part = take(x, rows)
            raw, total, dense = m.sums(part)
            error = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - label[rows]) / len(rows)
            doc = np.repeat(np.arange(len(rows)), np.diff(part.first))
            used, where = np.unique(part.bucket, return_inverse=True)
            push = error[doc] * part.weight
            used = np.concatenate([used, np.arange(BUCKETS, size)])
            step = np.concatenate([np.bincount(where, push, minlength=len(used) - STATISTICS), error @ dense]) + 1e-6 * m.linear[used]
            squares = np.concatenate([np.bincount(where, push * part.weight, minlength=len(used) - STATISTICS), error @ (dense * dense)])
            step_v = np.stack([np.concatenate([np.bincount(where, push * total[doc, f], minlength=len(used) - STATISTICS),
                                               (error * total[:, f]) @ dense]) for f in range(RANK)], axis=1)
            step_v += (1e-5 - squares[:, None]) * m.factor[used]
            past[used] += step * step
            past_v[used] += step_v * step_v
            past_bias += error.sum() ** 2
            m.linear[used] -= 0.1 * step / np.sqrt(past[used])
            m.factor[used] -= 0.03 * step_v / np.sqrt(past_v[used])
            m.bias -= 0.05 * error.sum() / np.sqrt(past_bias)
    return m


def _chunks(batch: pa.RecordBatch, text: str, length: str | None):
    column = batch.column(batch.schema.get_field_index(text))
    known = batch.column(batch.schema.get_field_index(length)).cast(pa.float64()).to_numpy(zero_copy_only=False) if length else np.full(len(batch), np.nan)
    for at, to, data, bounds in words.chunks(column):
        yield at, to, features(data, bounds, known[at:to].astype(float))


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, length: str | None, held_out: int, rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    chosen = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~in_fold(doc_id, held_out))
              .groupBy(doc_id).agg(F.avg(label).alias("_label"))
              .orderBy(F.xxhash64(doc_id), doc_id).limit(rows))
    wanted = {r[0]: float(r[1] >= 0.5) for r in chosen.collect()}
    if not wanted:
        return fit(features(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0)), np.zeros(0))
    session = docs.sparkSession
    ids = session.createDataFrame([(k,) for k in wanted], T.StructType([T.StructField("_id", labels.schema[doc_id].dataType)]))
    # at most ``rows`` ids: a proven bound for the broadcast
    columns = [F.col(doc_id), F.col(text), *([F.col(length)] if length else [])]
    sample = docs.select(*columns).join(F.broadcast(ids), F.col(doc_id) == F.col("_id"), "left_semi")

    def extract(batches):
        for batch in batches:
            for at, to, x in _chunks(batch, text, length):
                lists = pa.ListArray.from_arrays
                first = pa.array(x.first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), lists(first, pa.array(x.bucket.astype(np.int32))), lists(first, pa.array(x.weight)),
                     lists(pa.array(np.arange(to - at + 1, dtype=np.int32) * STATISTICS), pa.array(x.dense.astype(np.float64).ravel()))],
                    names=["id", "bucket", "weight", "dense"])

    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("bucket", T.ArrayType(T.IntegerType())),
                           T.StructField("weight", T.ArrayType(T.FloatType())), T.StructField("dense", T.ArrayType(T.DoubleType()))])
    got = sample.mapInArrow(extract, schema).dropDuplicates(["id"]).toArrow().sort_by("id").combine_chunks()
    if not len(got):
        return fit(features(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0)), np.zeros(0))

    def flat(name):
        return np.concatenate([c.flatten().to_numpy() for c in got[name].chunks])

    size = np.concatenate([[0], np.cumsum([len(v) for v in got["bucket"]])])
    x = Sparse(flat("bucket").astype(np.int64), flat("weight"), size, flat("dense").reshape(-1, STATISTICS))
    return fit(x, np.array([wanted[i] for i in got["id"].to_pylist()]))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                  length: str | None = None, held_out: int = 0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``score`` between 0 and 1: higher, likelier of label 1.

    ``length`` names a metadata column of text lengths, if there is one. Rows stay one
    to one; a null or empty text is scored by its statistics alone; repeated rows score
    alike. Of a document with several labels the mean counts. Without labels all score
    one half. A column of ``docs`` named score is replaced.
    """
    docs = docs.drop("score")
    machine = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text, label, length, held_out, sample_rows))

    def run(batches):
        for batch in batches:
            for at, to, x in _chunks(batch, text, length):
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(machine.value.score(x))], names=[*part.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
