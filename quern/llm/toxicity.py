"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words, their first 4 and 5
bytes, its pairs of neighbours and its pairs one and two words apart.  The learner
takes one document at a time; each coordinate has its own rate, and L1 keeps the
weights of uninformative ones at nothing, so what goes to every task is a short
list.  It runs in one task over a bounded sample of the labelled rows (TRAIN_ROWS,
chosen by a hash of the id): its time and memory don't grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.store import prepare
from quern.llm.vectors import _BYTE, ALNUM_WORDS, LOWER, U, blocks, joined, mix, prefix, spans

BITS, TRAIN_ROWS, EPOCHS = 20, 8192, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
THRESHOLD = 0.3


def held_out(id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(False))


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature, the text it is in and its hash."""
    buf, at = joined(texts)
    buf = LOWER[buf]
    inside = ALNUM_WORDS[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    owner = np.searchsorted(at, begin, "right") - 1
    sums = prefix(_BYTE[buf])
    word = mix(spans(sums, begin, end))
    out = [(owner, word)] + [(owner, mix(spans(sums, begin, np.minimum(begin + n, end)) + U(n))) for n in (4, 5)]
    for apart in (1, 2, 3):
        same = owner[apart:] == owner[:-apart]
        out.append((owner[apart:][same], mix(word[:-apart][same] * U(0x9E3779B97F4A7C15) + word[apart:][same] + U(apart << 8))))
    return [(o, (h >> U(64 - BITS)).astype(np.int64)) for o, h in out]


def fit(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates with weights, the weights and the bias, from distinct features and labels in the order given."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    l1 = np.full(size + 1, L1)
    l1[size] = 0.0  # the bias

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for own, label in rows:
            at = np.append(own, size)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(slice(None))
    at = np.flatnonzero(w[:size])
    return at, w[at], float(w[size])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """The weights, from labelled rows that aren't held out.  Without any, nothing scores above 0.

    Rows with a null id or label teach nothing; of several labels of an id the
    highest counts.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, train_rows / max(1, total))
    order = F.xxhash64(F.lit("toxicity"), F.col("doc_id").cast("bigint"))
    chosen = known.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1)).select(F.col("doc_id").alias("__id"), "toxic", order.alias("order"))

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes, np.ndarray, int]] = []
        for whole in batches:
            for part, texts in blocks([whole], "text"):
                found = features(texts)
                owner, hashed = (np.concatenate([x[i] for x in found]) for i in (0, 1))
                pairs = np.unique(owner << BITS | hashed)
                cut = np.searchsorted(pairs, np.arange(len(texts) + 1) << BITS)
                own = (pairs & (1 << BITS) - 1).astype(np.int32)
                for i, (label, key) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    rows.append((key, texts[i][:64], own[cut[i] : cut[i + 1]].copy(), int(label > 0)))
        rows.sort(key=lambda r: r[:2])
        if rows:
            at, w, bias = fit([(own, label) for _, _, own, label in rows])
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.list_(pa.int64())), pa.array([w], pa.list_(pa.float64())), pa.array([bias])], ["at", "w", "bias"])

    # the sample is bounded by train_rows, and so are its ids, which go to every task that reads documents
    taught = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("__id")).select(docs["text"].alias("text"), chosen["toxic"], chosen["order"])
    model = taught.repartition(1).mapInArrow(learn, "at array<bigint>, w array<double>, bias double").first()
    if model is None:
        return np.zeros(0, np.int64), np.zeros(0), -np.inf
    return np.array(model[0], np.int64), np.array(model[1]), model[2]


def scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """docs with a column __score from 0 to 1; a null or empty text has the score of no words."""
    at, w, bias = model
    if bias == -np.inf:
        return docs.withColumn("__score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast((at, w.astype(np.float64), bias))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, bias = shared.value
        dense = np.zeros(1 << BITS)
        dense[at] = w
        for part in parts:
            out = []
            for _, texts in blocks([pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"])]):
                pairs = np.unique(np.concatenate([(o << BITS | h)[dense[h] != 0] for o, h in features(texts)]))
                total = np.bincount(pairs >> BITS, dense[pairs & (1 << BITS) - 1], len(texts)) + bias
                out.append(1 / (1 + np.exp(-np.clip(total, -700, 700))))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn("__score", score(F.col("text")))


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    found = scores(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs that score below the threshold; all columns stay."""
    return scores(docs, train(docs, labels)).where(F.col("__score") < threshold).drop("__score")
