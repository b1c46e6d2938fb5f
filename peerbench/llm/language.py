"""Language identification by error-correcting output codes.

Every language has a binary codeword. For each bit a logistic classifier over hashed character n-grams is
learned; decoding takes the codeword with the least sum of logistic losses, each bit weighted by how well it
was learned. A document whose second-best codeword is nearly as close is flagged as ambiguous.

Up to five languages use the exhaustive code (every way to halve them is a bit); more use seeded random columns,
the draw with the largest distance between codewords. Training is numpy on a sample of at most ``train_rows``
documents, spread evenly over the languages (smallest digests of their ids, whole texts); prediction maps over
all documents.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and where no language was learned;
one learned language is always predicted; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerbench.llm.frames import arrow_map, stored, table, with_doc
from peerbench.llm.quality import remainder
from peerbench.llm.tokens import cut, mix, slices

TRAIN_ROWS = 4_000
DIMENSIONS = 2_048
AMBIGUOUS = 0.8
_ORDERS = (1, 2, 3, 4)
_STEPS = 150
_LETTER = re.compile(r"[^\W\d_]")
_LETTERS = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def ngram_rows(texts: pa.Array) -> np.ndarray:
    """One row per text: square roots of the shares of its hashed byte n-grams within words, at unit length."""
    words = cut(texts, _LETTERS, lower=True)
    rows = len(texts)
    out = np.zeros((rows, DIMENSIONS), np.float32)
    if not len(words.start):
        return out
    inside = np.zeros(len(words.data) + 1, np.int32)
    size = words.end - words.start
    at = np.repeat(words.start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    row = np.repeat(np.repeat(np.arange(rows), words.counts), size)
    inside[at] = np.repeat(words.end, size) - at  # letters left in the word
    data = np.append(words.data, np.zeros(max(_ORDERS), np.uint8)).astype(np.uint64)
    starts_word = np.zeros(len(words.data) + 1, np.uint64)
    starts_word[words.start] = 1
    code = starts_word[at].copy()
    for order in _ORDERS:
        code = code * np.uint64(257) + data[at + order - 1] + np.uint64(1)
        good = inside[at] >= order
        bucket = (mix(code[good] + np.uint64(order)) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)
        out += np.bincount(row[good] * DIMENSIONS + bucket, minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS).astype(np.float32)
    total = out.sum(1, keepdims=True)
    return np.sqrt(out / np.maximum(total, 1))


def codewords(languages: int, seed: int = 11) -> np.ndarray:
    """A matrix of -1 and 1, one row per language; rows differ in as many places as the draws allow."""
    if languages < 2:
        return np.zeros((languages, 0), np.float32)
    if languages <= 5:
        columns = [[1 if language == 0 or pick >> (language - 1) & 1 else -1 for language in range(languages)] for pick in range(2 ** (languages - 1) - 1)]
        return np.array(columns, np.float32).T
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(languages)))
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.float32), (languages, bits))
        code = code[:, np.abs(code.sum(0)) < languages]
        apart = min((code[i] != code[i + 1 :]).sum(1).min() for i in range(languages - 1))
        if apart > far:
            best, far = code, apart
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of the codeword likelihoods, and the share of the runner-up."""
        margin = x @ self.weights + self.bias
        loss = np.stack([np.logaddexp(0, -margin * word) @ self.trust for word in self.code], 1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, 1)
        second = order[:, -2] if share.shape[1] > 1 else np.zeros(len(x))
        return loss.argmin(1), order[:, -1], second


def fit(x: np.ndarray, languages: Sequence[str], steps: int = _STEPS) -> LanguageModel:
    """All bit classifiers at once by full-batch Adam on the logistic loss, each language with the same weight."""
    names, target = np.unique(np.array(languages, dtype=object).astype(str), return_inverse=True)
    code = codewords(len(names))
    y = code[target]
    share = (1 / (len(names) * np.bincount(target)))[target].astype(np.float32)[:, None]
    w, b = np.zeros((DIMENSIONS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for step in range(1, steps + 1):
        pull = -y * share / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        for k, (value, grad) in enumerate(((w, x.T @ pull + 1e-6 * w), (b, pull.sum(0)))):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * grad
            state[2 * k + 1] = 0.999 * state[2 * k + 1] + 0.001 * grad * grad
            value -= (0.1 * (state[2 * k] / (1 - 0.9**step)) / (np.sqrt(state[2 * k + 1] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    right = (share * (y * (x @ w + b) > 0)).sum(0)
    trust = np.log((right + 0.01) / (1.01 - np.minimum(right, 1)))
    return LanguageModel([str(n) for n in names], code, w, b, np.maximum(trust / max(trust.max(), 1e-6), 0.05) if len(trust) else trust)


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> LanguageModel | None:
    """A model of the non-null ``lang`` values of ``docs``; None if there is none."""
    named = docs.where("lang is not null and text is not null and doc_id is not null")
    sizes = stored(named.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    number = sizes.count()
    if not number:
        return None
    each = max(1, train_rows // number)
    digest = F.md5(F.col("doc_id").cast("string"))
    # the digests of twice as many rows as are wanted lie below this share; only those are ranked
    low = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**32 <= (2 * each + 20) / F.col("rows")
    order = W.partitionBy("lang").orderBy("digest", "doc_id")
    few = named.select("doc_id", "lang", digest.alias("digest")).join(sizes, "lang").where(low)
    chosen = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    chosen = chosen.select("doc_id", "lang").distinct().limit(train_rows)
    picked = named.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), ["doc_id", "lang"])  # train_rows rows at most

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in slices(batch.column("text")):
            rows = ngram_rows(batch.column("text").slice(lo, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("lang").slice(lo, hi - lo), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["doc_id", "lang", "grams"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = arrow_map(picked, run, f"doc_id {kind}, lang string, grams binary").toPandas().sort_values(["doc_id", "grams"], ignore_index=True)
    return fit(np.stack([np.frombuffer(g, np.float32) for g in got["grams"]]), got["lang"])


def identify(docs: DataFrame, model: LanguageModel | None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), lang_pred, score, ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model, text = shared.value, batch.column("text")
        best, share, vague = ["und"] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
        for lo, hi in slices(text) if model else ():
            winner, sure, second = model.decode(ngram_rows(text.slice(lo, hi - lo)))
            for i in range(lo, hi):
                value = text[i].as_py()
                if value is not None and _LETTER.search(value):
                    best[i], share[i], vague[i] = model.languages[winner[i - lo]], sure[i - lo], second[i - lo] >= AMBIGUOUS * sure[i - lo]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(best, pa.string()), pa.array(share), pa.array(vague)], ["doc", "lang_pred", "score", "ambiguous"]
        )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, with_doc(rows, "lang_pred string, score double, ambiguous boolean"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the ids."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs.where(remainder(3) != 1)))
    return found.select("doc.doc_id", "lang_pred", "score", "ambiguous").withColumn("held_out", remainder(3) == 1).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
