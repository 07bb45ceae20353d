"""Logistic regression by follow-the-regularised-leader updates, and its samples."""

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pricetide.llm.shipping import map_batches

FOLDS = 5


def fold_of(key):
    """crc32 of the id as text, modulo 5; fold 0 is held out and never learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


def labelled_sample(docs, labels, label, rows, text="text", key="doc_id"):
    """(order, text, label) of the `rows` labelled documents outside fold 0 that a hash of the id puts first.

    Only ids and labels are sorted. The sample has a fixed bound, so its ids can be sent
    to all executors. Of several labels of an id the largest counts; null labels and null
    ids are left out. Rows that repeat an id with the same text are one.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).where(fold_of(key) != 0)
    ids = ids.groupBy(F.col(key).cast("long").alias("id")).agg(F.max(label).cast("double").alias("label"))
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "id").select(F.xxhash64("id", F.lit(7)).alias("order"), "text", "label")


class Leader:
    """Weights of a logistic regression under FTRL-proximal updates, one example at a time."""

    def __init__(self, size, alpha=0.5, beta=1.0, l1=0.5, l2=1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias

    def weights(self, index=slice(None)):
        z, n = self.z[index], self.n[index]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, index, values, target, importance=1.0):
        """`target` may lie between 0 and 1. `index` has no repeats and ends with the bias."""
        w = self.weights(index)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = importance * (p - target) * values
        step = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += g - step * w
        self.n[index] += g * g


def fit(sample, features, size, epochs, schema="order long, text string, label double", **leader):
    """Learn on a bounded sample in one task; returns the weights, the last one the bias.

    `features(column)` gives for each text the distinct indexes and values of its features.
    """

    def run(batches):
        model, kept = Leader(size, **leader), []
        for batch in (b for b in batches if b.num_rows):
            # one array for a batch: many small ones would stay with the worker process
            labels = batch.column(2).to_numpy(zero_copy_only=False).copy()
            found = [(i.astype(np.int32), v.astype(np.float32)) for i, v in features(batch.column(1))]
            bounds = np.cumsum([0, *(len(i) for i, _ in found)])
            values = np.concatenate([v for _, v in found])
            if len(values) and (values == 1).all():
                values = np.broadcast_to(np.float32(1), len(values))
            kept.append((np.concatenate([i for i, _ in found]), values, bounds, labels))
            del found
        for _ in range(epochs):
            for indexes, values, bounds, labels in kept:
                for a, b, label in zip(bounds[:-1], bounds[1:], labels):
                    model.learn(np.append(indexes[a:b], size), np.append(values[a:b], 1), label)
        out = io.BytesIO()
        weights = model.weights().astype(np.float32)
        nonzero = np.flatnonzero(weights).astype(np.int32)
        np.savez(out, index=nonzero, weight=weights[nonzero])
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    # ordered by hash, so that the result does not depend on how the sample is dealt out
    one = sample.repartitionByRange(1, "order").sortWithinPartitions("order", "text")
    rows = map_batches(one, run, "model binary").collect()
    weights = np.zeros(size + 1, np.float32)
    for row in rows:  # none for an empty sample
        stored = np.load(io.BytesIO(bytes(row["model"])))
        weights[stored["index"]] = stored["weight"]
    return weights


def with_scores(docs, score, name, text="text"):
    """The rows of `docs` as they are, and their scores as a last column of this name."""
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            scores = np.clip(score(batch.column(place)), 0.0, 1.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return map_batches(docs, run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def scored(docs, score, threshold, text="text", key="doc_id"):
    """doc_id, held_out, score and predicted of every document; `score(column)` scores texts."""

    def run(batches):
        for batch in batches:
            scores = np.clip(score(batch.column(1)), 0.0, 1.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    held = F.coalesce(fold_of("doc_id") == 0, F.lit(False)).alias("held_out")
    return map_batches(rows, run, "doc_id long, score double").select(
        "doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
