"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words (the last may be shorter). Each passage becomes a vector of
shape and repetition measures, which a learned layer encodes. Gated attention weighs the encoded passages,
and a logistic unit scores the weighted sum, so that only documents need labels. Training is numpy on a
sample of at most ``train_rows`` labelled documents (the smallest digests of their ids, whole texts); scoring
maps over all documents with the few kilobytes of parameters as a broadcast.

Defined results: null, empty and blank texts are one passage of zeros and get a score like any other; repeated
rows get equal scores; label rows without id or quality are left out, of contradicting ones the mean counts; with
no labels, or labels of one kind, every score is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.frames import arrow_map, table, with_doc
from peerbench.llm.tokens import SOLID, cut, slices

PASSAGE = 64
TRAIN_ROWS = 8_000
THRESHOLD = 0.7
_HIDDEN = 16
_GATE = 8
_STEPS = 300

_KINDS = np.zeros((6, 256), bool)
for _b in range(256):
    _KINDS[0, _b] = 0x61 <= _b <= 0x7A or _b >= 0x80
    _KINDS[1, _b] = 0x41 <= _b <= 0x5A
    _KINDS[2, _b] = 0x30 <= _b <= 0x39
    _KINDS[3, _b] = _b in b".,"
    _KINDS[4, _b] = 0x21 <= _b < 0x7F and not chr(_b).isalnum() and _b not in b".,"
    _KINDS[5, _b] = _b == 0x0A
FEATURES = len(_KINDS) + 7


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and the number of passages of each text."""
    words = cut(texts, SOLID)
    counts = np.maximum(1, -(-words.counts // PASSAGE))
    out = np.zeros((counts.sum(), FEATURES), np.float32)
    if not len(words.start):
        return out, counts
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])
    row = np.repeat(np.arange(len(counts)), words.counts)
    passage = base[row] + (np.arange(len(row)) - words.first[row]) // PASSAGE
    lo = np.flatnonzero(np.diff(passage, prepend=-1))
    own, hi = passage[lo], np.append(lo[1:], len(passage))
    number = (hi - lo).astype(np.float32)
    span = (words.end[hi - 1] - words.start[lo]).astype(np.float32)
    for k, kind in enumerate(_KINDS):
        total = np.concatenate([[0], np.cumsum(kind[words.data], dtype=np.int32)])
        out[own, k] = (total[words.end[hi - 1]] - total[words.start[lo]]) / span
    length = (words.end - words.start).astype(np.float32)
    hashes = words.hashes()
    same = np.zeros(len(hashes), np.float32)
    same[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    keyed = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    distinct = np.bincount((keyed[np.flatnonzero(np.diff(keyed, prepend=~keyed[:1]))] >> np.uint64(40)).astype(np.int64), minlength=len(out))
    upper = _KINDS[1][words.data[words.start]] & _KINDS[1][words.data[np.maximum(words.end - 1, 0)]] & (length > 1)
    mean = np.add.reduceat(length, lo) / number
    k = len(_KINDS)
    out[own, k] = np.log1p(number)
    out[own, k + 1] = mean
    out[own, k + 2] = np.sqrt(np.maximum(0, np.add.reduceat(length * length, lo) / number - mean * mean))
    out[own, k + 3] = np.add.reduceat(same, lo) / number
    out[own, k + 4] = distinct[own] / number
    out[own, k + 5] = np.add.reduceat(upper.astype(np.float32), lo) / number
    out[own, k + 6] = np.add.reduceat((_KINDS[4][words.data[words.end - 1]]).astype(np.float32), lo) / number
    return out, counts


class AttentionModel:
    """Encoder, gated attention and scoring unit; ``bias`` alone if there was nothing to learn."""

    def __init__(self, bias: float, middle: np.ndarray | None = None, scale: np.ndarray | None = None):
        self.bias, self.middle, self.scale = bias, middle, scale
        self.weights: list[np.ndarray] = []

    def _forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, ...]:
        enc, enc_b, tan, gate, att, top, top_b = self.weights
        h = np.tanh(x @ enc + enc_b)
        t, g = np.tanh(h @ tan), 1 / (1 + np.exp(-(h @ gate)))
        a = (t * g) @ att
        a = np.exp(a - np.maximum.reduceat(a, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ top + top_b[0], -30, 30)))
        return h, t, g, a, z, p

    def scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(counts), self.bias)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        x = np.clip((features - self.middle) / self.scale, -8, 8)
        return self._forward(x, starts, np.repeat(np.arange(len(counts)), counts))[-1].astype(float)

    def attention(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weight of every passage; each document's weights sum to 1."""
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        x = np.clip((features - self.middle) / self.scale, -8, 8)
        return self._forward(x, starts, np.repeat(np.arange(len(counts)), counts))[3]


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = _STEPS, seed: int = 7) -> AttentionModel:
    """Full-batch Adam on the log loss; ``labels`` between 0 and 1, one per bag."""
    positives = float(labels.sum())
    model = AttentionModel((positives + 1) / (len(labels) + 2))
    if not 0 < positives < len(labels):
        return model
    model.middle, model.scale = features.mean(0), features.std(0) + 1e-3
    x = np.clip((features - model.middle) / model.scale, -8, 8).astype(np.float32)
    starts, bag = np.concatenate([[0], np.cumsum(counts)[:-1]]), np.repeat(np.arange(len(counts)), counts)
    rng = np.random.default_rng(seed)
    shapes = [(FEATURES, _HIDDEN), (_HIDDEN,), (_HIDDEN, _GATE), (_HIDDEN, _GATE), (_GATE,), (_HIDDEN,), (1,)]
    model.weights = [(rng.normal(0, 0.3, s) if len(s) > 1 or s[0] != 1 else np.zeros(s)).astype(np.float32) for s in shapes]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for step in range(1, steps + 1):
        enc, enc_b, tan, gate, att, top, top_b = model.weights
        h, t, g, a, z, p = model._forward(x, starts, bag)
        dlogit = (p - labels).astype(np.float32) / len(labels)
        dz = dlogit[:, None] * top
        dza = (dz[bag] * h).sum(1)
        da = a * (dza - np.add.reduceat(a * dza, starts)[bag])
        dt, dg = da[:, None] * att * g * (1 - t * t), da[:, None] * att * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ tan.T + dg @ gate.T) * (1 - h * h)
        grads = [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ dg, (t * g).T @ da, z.T @ dlogit, dlogit.sum(keepdims=True)]
        for k, grad in enumerate(grads):
            grad = grad + 1e-5 * model.weights[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad * grad
            move = 0.03 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            model.weights[k] = (model.weights[k] - move).astype(np.float32)
    return model


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> AttentionModel:
    """A model of ``labels`` (doc_id, quality), fitted on at most ``train_rows`` of them."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("quality"))
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(train_rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # train_rows rows at most

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in slices(batch.column("text")):
            features, counts = passage_features(batch.column("text").slice(lo, hi - lo))
            parts = np.split(features, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("quality").slice(lo, hi - lo), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["doc_id", "quality", "passages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = arrow_map(picked.select("doc_id", "quality", F.col("text").cast("string").alias("text")), run, f"doc_id {kind}, quality double, passages binary")
    got = rows.toPandas().sort_values(["doc_id", "passages"], ignore_index=True)
    if not len(got):
        return AttentionModel(0.5)
    bags = [np.frombuffer(p, np.float32).reshape(-1, FEATURES) for p in got["passages"]]
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]), got["quality"].to_numpy(float))


def score(docs: DataFrame, model: AttentionModel, keep: Sequence[str] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, out = batch.column("text"), np.zeros(batch.num_rows)
        for lo, hi in slices(text):
            out[lo:hi] = shared.value.scores(*passage_features(text.slice(lo, hi - lo)))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out)], ["doc", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("text").cast("string").alias("text"))
    scored = arrow_map(rows, run, with_doc(rows, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of three quarters of the ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, train(docs, labels.where(remainder(4) != 2)))
    return scored.select("doc.doc_id", "score", "predicted").withColumn("held_out", remainder(4) == 2).select("doc_id", "held_out", "score", "predicted")
