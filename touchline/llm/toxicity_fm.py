"""Toxicity by a factorization machine over hashed terms.

A document's features are the hashed distinct words of its whole text and their
prefixes. The score is sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>): besides the
additive weights, pairs of terms weigh in through their factors, such as an insult
together with the mention of a group, which additive weights cannot tell apart
from the two alone.

Training uses a bounded sample (``sample_rows``) of labelled rows outside the
held-out fold. The sample's texts are hashed where they lie; one task takes their
feature ids and fits, and only the model comes to the driver. Scoring covers every
document in Arrow batches, one row per document; the model is a table of fixed
size (``BUCKETS`` x (1 + factors)), broadcast.

Null text is empty and gets the bias alone. A row with null doc_id is scored and is
not held out. Labels that are null or whose document is missing do not train.
Without both labels in the sample every score is the constant prior (0 if unknown).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import bound_batches, give_back, small, text_or_empty

BUCKETS = 1 << 18
FACTORS = 4
#: Most labelled rows that training reads; the smallest hashes of doc_id are taken.
SAMPLE_ROWS = 12_000
#: A term must occur in so many sampled documents to get a weight.
MIN_DOCS = 3
PREFIXES = (4, 5, 6, 7)
FOLDS = 5
EPOCHS = 8
TOXIC_WEIGHT = 4.0
CACHE_WORDS = 200_000

_PART = re.compile(r"\w+")


class _WordFeatures(dict):
    """Feature ids of a white-space-separated word, as int32 bytes."""

    def __missing__(self, raw: bytes) -> bytes:
        found = set()
        for part in _PART.findall(raw.decode("utf-8", "replace").lower()):
            found.add("w" + part)
            found.update(f"p{part[:n]}" for n in PREFIXES if len(part) >= n)
        made = np.array([xxhash.xxh32_intdigest(x.encode()) % BUCKETS for x in found], dtype=np.int32).tobytes()
        self[raw] = made
        return made


class TermHasher:
    """Distinct feature ids of a text; a word's ids are kept in a bounded cache."""

    def __init__(self):
        self._words = _WordFeatures()

    def ids(self, text: bytes) -> np.ndarray:
        if len(self._words) > CACHE_WORDS:
            self._words.clear()
        found = b"".join(map(self._words.__getitem__, set(text.split())))
        return np.unique(np.frombuffer(found, dtype=np.int32))


@dataclass
class Model:
    bias: float
    w: np.ndarray  # (BUCKETS,) float32
    v: np.ndarray  # (BUCKETS, FACTORS) float32

    def scores(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Probabilities of rows whose features are ids[begin[i]:begin[i + 1]]."""
        lin, s, q = _row_sums(self.w[ids], begin), _row_sums(self.v[ids], begin), _row_sums(self.v[ids] ** 2, begin)
        raw = self.bias + lin + 0.5 * (s * s - q).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))


def _row_sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[begin[1:]] - total[begin[:-1]]


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, factors: int = FACTORS, seed: int = 11,
        rate: float = 0.05, l1: float = 1.5e-3, l2: float = 1e-3, batch: int = 128, toxic_weight: float = TOXIC_WEIGHT) -> Model:
    """AdaGrad on the logistic loss; soft threshold on w, weight decay on v. Seeded.

    A toxic row counts ``toxic_weight`` times, as toxic rows are the rarer ones."""
    w, v = np.zeros(BUCKETS), np.zeros((BUCKETS, factors))
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        prior = float(np.clip(y.mean(), 0.0, 1.0)) if len(y) else 0.0
        bias = -30.0 if prior == 0 else 30.0
        return Model(bias, w.astype(np.float32), v.astype(np.float32))
    df = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        df[r] += 1
    known = df >= MIN_DOCS
    rows = [r[known[r]] for r in rows]
    rng = np.random.default_rng(seed)
    v[known] = rng.normal(0, 0.01, (int(known.sum()), factors))
    bias = float(np.log(y.mean() / (1 - y.mean())))
    gw, gv, gb = np.full(BUCKETS, 1e-2), np.full((BUCKETS, factors), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            n = np.array([len(rows[i]) for i in part])
            begin = np.concatenate(([0], np.cumsum(n)))
            ids = np.concatenate([rows[i] for i in part])
            s = _row_sums(v[ids], begin)
            raw = bias + _row_sums(w[ids], begin) + 0.5 * (s * s - _row_sums(v[ids] ** 2, begin)).sum(axis=1)
            err = 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))) - y[part]
            err *= np.where(y[part] > 0, toxic_weight, 1.0)
            own, place = np.unique(ids, return_inverse=True)
            each = np.repeat(err, n) / len(part)
            g = np.bincount(place, weights=each, minlength=len(own))
            grad_v = np.empty((len(own), factors))
            s_each = np.repeat(s, n, axis=0)
            for f in range(factors):  # d raw / d v_i = sum of the others' factors
                grad_v[:, f] = np.bincount(place, weights=each * (s_each[:, f] - v[ids, f]), minlength=len(own))
            grad_v += l2 * v[own]
            gw[own] += g * g
            step = rate / np.sqrt(gw[own])
            new = w[own] - step * g
            w[own] = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
            gv[own] += grad_v ** 2
            v[own] -= 0.3 * rate / np.sqrt(gv[own]) * np.clip(grad_v, -1, 1)
            gb += err.mean() ** 2
            bias -= rate / np.sqrt(gb) * err.mean()
    return Model(float(bias), w.astype(np.float32), v.astype(np.float32))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _hashed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = TermHasher()
        for b in small(batches):
            ids = [hasher.ids(t).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["y", "ids"])

    return docs.select("y", text_or_empty().cast("binary").alias("t")).mapInArrow(run, "y int, ids binary")


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model as one row (``bias, w, v``), fitted on all rows (``y, ids``) of the one partition."""
    got = sorted(pair for b in small(batches) for pair in zip(b.column(1).to_pylist(), b.column(0).to_pylist()))
    m = fit([np.frombuffer(i, dtype=np.int32) for i, _ in got], np.array([y for _, y in got]))
    got.clear()
    yield pa.RecordBatch.from_arrays(
        [pa.array([m.bias], pa.float64()), *[pa.array([x.tobytes()], pa.binary()) for x in (m.w, m.v)]], names=["bias", "w", "v"])
    give_back()


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold."""
    bound_batches(docs.sparkSession)
    lab = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    lab = lab.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("y"))
    # At most sample_rows rows of (id, label): a broadcast with a bound.
    sample = lab.orderBy(F.xxhash64("_id"), "_id", "y").limit(sample_rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("y", "text", "_id")
    # One row per sampled id, spread over tasks by it: what the fitting task reads has the same bound.
    rows = _hashed(joined.dropDuplicates(["_id"])).repartition(1)
    got = rows.mapInArrow(_fitted, "bias double, w binary, v binary").collect()  # one row of fixed size
    if not got:  # no sample: Spark may leave out the task
        return fit([], np.empty(0))
    w, v = (np.frombuffer(bytes(got[0][c]), dtype=np.float32) for c in ("w", "v"))
    return Model(got[0]["bias"], w, v.reshape(BUCKETS, -1))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` plus ``toxicity`` (0 to 1), one row per input row."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    temp = "_toxicity_text"
    while temp in names:
        temp += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, m = TermHasher(), shared.value
        for b in small(batches):
            out = []
            for at in range(0, b.num_rows, 100):  # bounds the gathered factors
                rows = [hasher.ids(t) for t in b.column(b.num_columns - 1).slice(at, 100).to_pylist()]
                begin = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
                out.append(m.scores(np.concatenate(rows), begin))
            s = pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], s], names=[*names, "toxicity"])

    schema = docs.drop("toxicity").schema if "toxicity" in names else docs.schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.withColumn(temp, text_or_empty().cast("binary")).mapInArrow(
        run, StructType([*schema.fields, StructField("toxicity", DoubleType())]))


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``limit``; columns as they were."""
    return score(docs.select("*"), model).filter(F.col("toxicity") < limit).select(*docs.columns)
