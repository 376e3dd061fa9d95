"""Quality classifier on supervised subword embeddings.

Features of a text are its words (between ASCII white space), the pairs of
neighbouring words, whether a word repeats the one before, and its character
3- and 4-grams over word edges; each is hashed into one of 2**bits vectors.  The
vectors of a text are averaged by kind of feature, the kinds are averaged, and a
softmax layer gives the class.  Vectors and output weights are learned together
by stochastic gradient descent in numpy.

Training uses a bounded sample of labelled rows: the ``max_rows`` rows with the
smallest hashes of doc_id (documented bound; one task trains on them).  Scoring
covers all rows and whole texts; because the layers are linear, each feature's
vector times the output weights is one number, and a score is a mean of numbers.

Defined cases: null and empty texts have no features and get the score of the
output bias; labels other than 0 and 1, null ids and labels without a document
teach nothing; of several labels of a doc_id the largest counts; without any
labelled row of both classes every score is the share of label 1 (0.5 without
rows); ties and repeated rows score alike; an empty table gives an empty result;
other columns, also lang and source, are never read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import chunks, mix, words_of

_BYTES = 1_000_000
_KINDS = 4


@dataclass
class SubwordModel:
    """weight: a number per feature and kind (class 1 minus class 0), bias: its output bias."""

    weight: np.ndarray
    bias: float
    bits: int


def features(texts: list[bytes | None], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature (feature number, text number) of all texts."""
    shift = np.uint64(64 - bits)
    h, start, end, first, joined = words_of(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    out = [((mix(h + np.uint64(1)) >> shift).astype(np.int64), owner)]
    if len(h) > 1:
        near = owner[1:] == owner[:-1]
        pair = mix(h[1:] * np.uint64(3) + mix(h[:-1]))[near]
        out.append(((pair >> shift).astype(np.int64), owner[1:][near]))
        out.append(((h[1:] == h[:-1])[near].astype(np.int64), owner[1:][near]))
    else:
        out += [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
    # Character n-grams over code points; each run of white space is one edge.
    text = b" ".join([b"", *joined.split(), b""]) if len(h) else b" "
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = points == 32
    word = np.cumsum(space)[:-1] - 1  # the word that a place belongs to; an edge goes to the word after it
    codes, owners = [], []
    for n in (3, 4):
        m = len(points) - n + 1
        if m <= 0 or not len(owner):
            continue
        code = points[:m].copy()
        for k in range(1, n):
            code = mix(code + np.uint64(n)) + points[k: k + m]
        ok = ~space[1: 1 + m] if n == 3 else ~(space[1: 1 + m] | space[2: 2 + m])
        ok &= word[:m] < len(owner)
        codes.append((mix(code) >> shift).astype(np.int64)[ok])
        owners.append(owner[word[:m][ok]])
    out.append((np.concatenate(codes), np.concatenate(owners)) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    return out


def bags(texts: list[bytes | None], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text as (rows of the vector table, weights that sum to 1)."""
    out: list[list] = [[] for _ in texts]
    for kind, (f, owner) in enumerate(features(texts, bits)):
        cell, count = np.unique(owner * (1 << bits) + f, return_counts=True)
        text, f = cell >> bits, cell & ((1 << bits) - 1)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            a, b = bounds[i], bounds[i + 1]
            if b > a:
                out[i].append((f[a:b] + (kind << bits), count[a:b] / count[a:b].sum()))
    done = []
    for parts in out:
        if parts:
            done.append((np.concatenate([f for f, _ in parts]), np.concatenate([w for _, w in parts]) / len(parts)))
        else:
            done.append((np.zeros(0, np.int64), np.zeros(0)))
    return done


def fit(texts: list[bytes | None], labels: np.ndarray, *, bits: int = 16, dims: int = 12, epochs: int = 6, rate: float = 4.0,
        seed: int = 3) -> SubwordModel:
    """Stochastic gradient descent over the texts, one at a time in a seeded order, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dims, 1 / dims, (_KINDS << bits, dims)).astype(np.float32)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    out = np.zeros((dims, 2), np.float32)
    bias = np.array([0.0, np.log(share / (1 - share))], np.float32)
    if len(set(labels.tolist())) == 2:
        data = [b for i, j in chunks([len(t or b"") for t in texts], _BYTES) for b in bags(texts[i:j], bits)]
        steps, step = epochs * len(data), 0
        out = rng.uniform(-1 / dims, 1 / dims, (dims, 2)).astype(np.float32)
        for _ in range(epochs):
            for i in rng.permutation(len(data)):
                f, w = data[i]
                now = rate * (1 - step / steps)
                step += 1
                own = vectors[f]
                hidden = w.astype(np.float32) @ own
                z = hidden @ out + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[labels[i]] -= 1  # gradient of the log loss
                back = out @ p
                out -= (0.1 * now) * np.outer(hidden, p)
                bias -= 0.01 * now * p
                vectors[f] = own - now * np.outer(w, back).astype(np.float32)
    weight = vectors @ (out[:, 1] - out[:, 0])
    return SubwordModel(weight, float(bias[1] - bias[0]), bits)


def scores(texts: list[bytes | None], model: SubwordModel) -> np.ndarray:
    total, kinds = np.zeros(len(texts)), np.zeros(len(texts))
    for kind, (f, owner) in enumerate(features(texts, model.bits)):
        n = np.bincount(owner, minlength=len(texts))
        s = np.bincount(owner, model.weight[f + (kind << model.bits)], minlength=len(texts))
        total += s / np.maximum(n, 1)
        kinds += n > 0
    return 1 / (1 + np.exp(-(total / np.maximum(kinds, 1) + model.bias)))


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, max_rows: int = 4000, **options) -> SubwordModel:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    known = (labels.where(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(known), "doc_id")  # max_rows ids at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((d, t or b"", q) for b in batches for d, t, q in zip(*(c.to_pylist() for c in b.columns), strict=True))
        model = fit([t for _, t, _ in got], np.array([q for _, _, q in got], np.int64), **options)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # One task by design: the sample is bounded.  Spark may run no task at all for an empty one.
    trained = rows.select("doc_id", "text", "quality").repartition(1).mapInArrow(work, "model binary").first()
    return pickle.loads(trained[0]) if trained else fit([], np.zeros(0, np.int64), **options)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.  A null doc_id is not held out and teaches nothing."""
    model = train(spark, docs, labels, **options)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            parts = [scores(texts[i:j], model) for i, j in chunks([len(t or b"") for t in texts], _BYTES)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                  ["doc_id", "held_out", "score", "predicted"])

    return (docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int"))
