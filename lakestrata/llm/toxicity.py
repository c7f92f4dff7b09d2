"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, free_prefix, raw_bytes, small_batches, tidied, words_of

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BITS = 22


@dataclass(frozen=True)
class FtrlSettings:
    """``sample_rows`` bounds the labelled rows that a fit reads; features met in
    fewer than ``min_docs`` of them get no weight."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 3
    min_docs: int = 5
    sample_rows: int = 20_000


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes, their weights, and the bias: a few thousand numbers."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def features(text: bytes, known: WordHashes) -> np.ndarray:
    """32-bit hashes of words, word pairs, and pairs with one word between."""
    h = known.of(words_of(text))
    a, b, c = _MULTIPLIERS
    shift = np.uint64(32)
    with np.errstate(over="ignore"):
        parts = [h * a, h[:-1] * b + h[1:] * a, h[:-2] * c + h[2:] * b]
    return np.concatenate([p >> shift for p in parts]).astype(np.uint32)


class _Sample:
    """Distinct features and label of each row of a fit; texts are not kept."""

    def __init__(self) -> None:
        self.known = WordHashes()
        self.met = np.zeros(1 << _BITS, np.uint32)
        self.rows: list[np.ndarray] = []
        self.labels: list[float] = []

    def add(self, text: bytes, label: float) -> None:
        found = np.unique(features(text, self.known))
        np.add.at(self.met, np.unique(found >> np.uint32(32 - _BITS)), 1)
        self.rows.append(found)
        self.labels.append(label)

    def fit(self, s: FtrlSettings) -> ToxicityModel:
        """One pass after the other over the rows, in their order."""
        often = self.met >= s.min_docs
        for i, found in enumerate(self.rows):
            self.rows[i] = found[often[found >> np.uint32(32 - _BITS)]]
        keys = np.zeros(0, np.uint32)
        for i in range(0, len(self.rows), 1000):
            keys = np.unique(np.concatenate([keys, *self.rows[i : i + 1000]]))
        # The last coordinate is the bias, present in every row.
        places = [
            np.append(np.searchsorted(keys, r), len(keys)).astype(np.int32) for r in self.rows
        ]
        z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
        l1 = np.full(len(keys) + 1, s.l1)
        l1[-1] = 0.0

        def weights(at: np.ndarray | slice) -> np.ndarray:
            over = np.abs(z[at]) - l1[at]
            rate = (s.beta + np.sqrt(n[at])) / s.alpha + s.l2
            return np.where(over > 0, -np.sign(z[at]) * over / rate, 0.0)

        for _ in range(s.epochs):
            for at, label in zip(places, self.labels):
                w = weights(at)
                p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
                g = p - label
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
                z[at] += g - sigma * w
                n[at] += g * g
        w = weights(slice(None))
        used = np.flatnonzero(w[:-1])
        return ToxicityModel(keys[used], w[used].astype(np.float32), float(w[-1]))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, settings: FtrlSettings = FtrlSettings()
) -> ToxicityModel:
    """Fit on at most ``settings.sample_rows`` labelled rows, taken by the hash of
    their id.

    ``docs``: doc_id, text. ``labels``: doc_id, toxic (0 or 1). NULL labels and
    NULL ids are left out; of several labels of one id the highest counts;
    a NULL text is empty. Without labelled rows every document scores 0.5.
    The sample is read by one task, which returns the non-zero weights.
    """
    s = settings
    labelled = (
        labels.select("doc_id", "toxic")
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(11))
    total = docs.select("doc_id").join(labelled, "doc_id").count()
    share = min(1.0, 1.2 * s.sample_rows / max(total, 1))
    limit = min(int(share * 2**64) - 2**63, 2**63 - 1)
    sample = (
        docs.select("doc_id", "text")
        .withColumn("place", order)
        .filter(F.col("place") <= F.lit(limit))
        .join(labelled, "doc_id")
        .select("place", "doc_id", "text", "label")
        .orderBy("place", "doc_id", F.xxhash64("text"))
        .limit(s.sample_rows)
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = _Sample()
        for batch in batches:
            for text, label in zip(batch.column(2), batch.column(3).to_pylist()):
                sample.add(raw_bytes(text), float(label))
        model = sample.fit(s)
        yield pa.record_batch(
            [
                pa.array(np.append(model.keys.astype(np.int64), -1)),
                pa.array(np.append(model.weights.astype(float), model.bias)),
            ],
            names=["key", "weight"],
        )

    found = sample.repartition(1).sortWithinPartitions("place", "doc_id").mapInArrow(
        tidied(fit), "key long, weight double"
    )
    rows = sorted((r.key, r.weight) for r in found.collect())
    bias = sum(w for k, w in rows if k < 0)
    rows = [r for r in rows if r[0] >= 0]
    return ToxicityModel(
        np.array([k for k, _ in rows], np.uint32),
        np.array([w for _, w in rows], np.float32),
        bias,
    )


class _Scorer:
    def __init__(self, model: ToxicityModel):
        self.model, self.known = model, WordHashes()
        self.marked = np.zeros(1 << _BITS, bool)
        self.marked[model.keys >> np.uint32(32 - _BITS)] = True

    def __call__(self, text: bytes) -> float:
        m = self.model
        total = m.bias
        found = features(text, self.known)
        found = found[self.marked[found >> np.uint32(32 - _BITS)]]
        if len(found):
            found = np.unique(found)
            at = np.minimum(np.searchsorted(m.keys, found), len(m.keys) - 1)
            total += float(m.weights[at][m.keys[at] == found].sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(total, -35, 35))))


def score_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and ``name``, the probability of label 1.

    Every row is scored from its whole ``text`` alone; NULL and empty texts get
    the bias. A column ``name`` of ``docs`` is replaced.
    """
    docs = docs.drop(name)
    at = docs.columns.index("text")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(held.value)
        for batch in batches:
            for part in small_batches(batch):
                scores = [scorer(raw_bytes(t)) for t in part.column(at)]
                yield pa.record_batch(
                    [*part.columns, pa.array(scores, pa.float64())],
                    names=[*part.schema.names, name],
                )

    schema = docs.select("*", F.lit(0.0).cast("double").alias(name)).schema
    return docs.mapInArrow(tidied(score), schema)


def is_toxic(name: str = "toxicity") -> Column:
    return F.col(name) >= 0.5


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with their columns."""
    name = free_prefix(docs, "toxicity")
    return score_toxicity(docs, model, name).filter(~is_toxic(name)).select(*docs.columns)
