"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A text is the set of its words, pairs of neighbouring words and pairs with one word between,
each hashed to a coordinate. Every coordinate has its own learning rate; the L1 term keeps
coordinates at zero that the labels give no reason for, so few weights are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (joined, map_arrow, map_slices, mix, per_text, renamed, word_bounds,
                                 word_hashes)

BITS = 20
#: Labelled documents to fit on, about; the bound of the sample.
DOCS = 12_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1
EPOCHS = 4
THRESHOLD = 0.7

_APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_U = np.uint64


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all grams of all texts, with the row each stands in."""
    raw, offsets = joined(texts, lower=True)
    begin, end = word_bounds(raw, _APART)
    words = word_hashes(raw, begin, end)
    row = np.repeat(np.arange(len(texts)), np.diff(per_text(begin, offsets)))
    grams, rows = [words], [row]
    for gap, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = row[gap:] == row[:-gap]
        grams.append(mix(words[:-gap] * _U(factor) + words[gap:])[same])
        rows.append(row[gap:][same])
    return (np.concatenate(grams) >> _U(64 - BITS)).astype(np.int64), np.concatenate(rows)


def ftrl(examples: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, alpha: float = ALPHA,
         beta: float = BETA, l1: float = L1, l2: float = L2, size: int = 1 << BITS):
    """Weights and bias after ``epochs`` passes over the examples, in the order given."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for own, label in zip(examples, labels):
            at = np.append(own, size)
            w = _weights(z[at], n[at], alpha, beta, np.append(np.full(len(own), l1), 0.0), l2)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            rate = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / alpha
            z[at] += gradient - rate * w
            n[at] += gradient * gradient
    w = _weights(z, n, alpha, beta, np.append(np.full(size, l1), 0.0), l2)
    return w[:-1], float(w[-1])


def _weights(z, n, alpha, beta, l1, l2):
    shrunk = np.sign(z) * l1 - z
    return np.where(np.abs(z) <= l1, 0.0, shrunk / ((beta + np.sqrt(n)) / alpha + l2))


class Model:
    """The weights that are not zero."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bias: float):
        self.at, self.weights, self.bias = at, weights, bias
        self.table = None

    def __getstate__(self):
        return {**self.__dict__, "table": None}

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.table is None:
            self.table = np.zeros(1 << BITS)
            self.table[self.at] = self.weights
        grams, rows = features(texts)
        told = self.table[grams] != 0
        cells = np.unique(rows[told] << BITS | grams[told])
        total = np.bincount(cells >> BITS, self.table[cells & ((1 << BITS) - 1)], len(texts))
        return 1 / (1 + np.exp(-(total + self.bias)))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", docs: int = DOCS) -> Model:
    """Fit on rows with a label; rows enter the bounded sample by a hash of their id, or without
    one of their text.

    Texts become coordinate sets on the executors; one task then walks through the
    sample, whose size does not grow with the corpus, and returns the weights. Where an id of many
    rows, or the rows without one, make the sample more than twice ``docs``, rows equal in id, text
    and label enter it once, by a hash of id and text.
    """
    source = renamed(labelled, key=id_col, text=text_col, label=label_col).where("label IS NOT NULL")
    keyless = F.when(F.col("key").isNull(), F.col("text"))  # a NULL adds nothing to the hash
    drawn = F.xxhash64(F.col("key"), keyless, F.lit("toxicity"))
    rows = source.count()
    share = min(1.0, docs / rows) if rows else 1.0
    sample = source.withColumn("drawn", drawn).where(
        F.pmod("drawn", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    if sample.count() > 2 * docs:
        sample = sample.withColumn("drawn", F.xxhash64("drawn", "text")).dropDuplicates(["drawn", "label"])
        share = min(1.0, docs / sample.count())
        sample = sample.where(F.pmod("drawn", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def sets(batch):
        grams, rows = features(batch.column(1))
        cells = np.unique(rows << BITS | grams)
        ends = np.searchsorted(cells >> BITS, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                         pa.array((cells & ((1 << BITS) - 1)).astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists],
                                          ["drawn", "label", "grams"])

    made = map_slices(sample.select("drawn", "text", F.col("label").cast("int").alias("label")), "text",
                      "drawn bigint, label int, grams array<int>", sets)

    def learn(batches):
        examples, labels = [], []
        for batch in batches:
            lists = batch.column(2)
            flat, cuts = np.asarray(lists.flatten()), np.asarray(lists.offsets)
            examples += np.split(flat, (cuts - cuts[0])[1:-1]) if len(lists) else []
            labels += batch.column(1).to_pylist()
        weights, bias = ftrl(examples, labels)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(weights[at], bias))], ["at", "weight"])

    learnt = map_arrow(made.repartition(1).sortWithinPartitions("drawn"), learn,
                       "at bigint, weight double").toArrow()
    at, weights = (np.asarray(learnt.column(c)) for c in ("at", "weight"))
    own = at >= 0
    return Model(at[own], weights[own], float(weights[~own][0]) if (~own).any() else 0.0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row (doc_id, score, predicted) per row of ``docs``, over whole texts.

    ``score`` (0 to 1) is the likelihood of label 1, ``predicted`` 1 from ``threshold`` on.
    NULL and empty texts get what the bias alone says; without any labelled row all
    get one half. Rows that repeat an id keep one row each; ids are only carried.
    An empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        scores = shared.value.score(batch.column(1))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
            ["doc_id", "score", "predicted"])

    source = renamed(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, "text", f"doc_id {kind}, score double, predicted int", work, 2_000_000)
