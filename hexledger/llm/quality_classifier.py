"""Quality classifier: logistic regression on hashed word n-grams, trained online by FTRL-proximal.

Training reads a bounded sample of labelled documents (`TRAINING_ROWS`, chosen by a hash of the id) in one
pass, as the online method is meant to; scoring reads every document and needs one sparse dot product each.
Inputs of a score are the words of the whole text and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches
from hexledger.llm.text_arrays import Texts, mix, slices, word_ngrams

# Labelled documents that training reads at most (in expectation), however many there are.
TRAINING_ROWS = 20_000
WEIGHT_BITS = 18
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
CUT = 0.7

_BIAS = 1 << WEIGHT_BITS


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document must not be learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all one- and two-word grams, the document of each, and the grams of each document.

    A two-word gram of equal words also counts as the gram "a word, again".
    """
    prefix = texts.prefix()
    starts, ends = texts.words()
    words, document = texts.segment_hash(prefix, starts, ends), texts.document_of(starts)
    pairs, first = word_ngrams(words, document, 2)
    again = first[words[first] == words[first + 1]]
    shift = np.uint64(64 - WEIGHT_BITS)
    buckets = np.concatenate((mix(words) >> shift, pairs >> shift)).astype(np.int64)
    buckets = np.concatenate((buckets, np.full(len(again), 1, dtype=np.int64)))
    owner = np.concatenate((document, document[first], document[again]))
    return buckets, owner, np.bincount(owner, minlength=len(texts))


class Ftrl:
    """Follow-the-regularised-leader with one learning rate a coordinate."""

    def __init__(self) -> None:
        self.z = np.zeros(_BIAS + 1)
        self.n = np.zeros(_BIAS + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) > L1, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Ftrl()
    for batch in batches:
        for part, texts in slices(batch):
            buckets, owner, grams = _features(texts)
            order = np.argsort(owner, kind="stable")
            ends = np.cumsum(grams)
            for d, label in enumerate(part.column("label").to_numpy()):
                at, count = np.unique(buckets[order[ends[d] - grams[d] : ends[d]]], return_counts=True)
                x = count / np.sqrt(max(grams[d], 1))
                model.learn(np.append(at, _BIAS), np.append(x, 1.0), float(label))
    w = model.weights()
    used = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(w[used])], names=["feature", "weight"])


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(text, label, turn): a sample of about `rows` labelled documents that are not held out.

    A document with several labels takes the lowest; null labels and ids are left out.
    """
    ids = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("label"))
    )
    there = ids.count()
    share = min(1.0, rows / max(there, 1))
    turn = F.xxhash64("doc_id")
    chosen = ids.withColumn("turn", turn).where(F.pmod("turn", F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most about `rows` ids: broadcast, so that only their texts leave the scan.
    return (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "label", "turn", "doc_id")
    )


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> np.ndarray:
    """The weights, the bias last: 2**WEIGHT_BITS + 1 numbers, whatever the corpus.

    Without labels all weights are 0 and every score is 0.5.
    """
    bound_batches(documents.sparkSession)
    learnt = (
        training_rows(documents, labels, rows)
        .repartition(1)
        .sortWithinPartitions("turn", "doc_id", "text")
        .select("text", "label")
        .mapInArrow(_train, "feature long, weight double")
        .toPandas()
    )
    weights = np.zeros(_BIAS + 1)
    weights[learnt["feature"].to_numpy(dtype=np.int64)] = learnt["weight"].to_numpy(dtype=float)
    return weights


def score(documents: DataFrame, weights: np.ndarray, cut: float = CUT) -> DataFrame:
    """`documents` with score and predicted: one row per row, repeated or not.

    A text without words, empty or null, gets the score of the bias alone. Columns of the input that clash
    with the new names are replaced.
    """
    bound_batches(documents.sparkSession)
    table = documents.sparkSession.sparkContext.broadcast(weights)
    rest = documents.drop("score", "predicted")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = table.value
        for batch in batches:
            for part, texts in slices(batch):
                buckets, owner, grams = _features(texts)
                dot = np.bincount(owner, weights=w[buckets], minlength=len(texts))
                margin = dot / np.sqrt(np.maximum(grams, 1)) + w[_BIAS]
                p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p), pa.array((p >= cut).astype(np.int32))],
                    names=[*part.schema.names, "score", "predicted"],
                )

    return rest.mapInArrow(run, ", ".join([*fields, "score double", "predicted int"]))
