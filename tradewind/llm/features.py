"""Hashed word features of whole texts, and the bounded sample that models are fitted on.

Words are runs of letters and digits (any byte from 128 on counts as a letter) or runs of
other signs; A-Z is lower-cased. Only the text is looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import common

BUCKETS = 1 << 18
# Labelled documents a model is fitted on at most: those with the least hash of their id.
FIT_ON = 16384

KIND = np.full(256, 2, dtype=np.uint8)
KIND[[32, 9, 10, 11, 12, 13]] = 0
for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    KIND[low:high] = 1


class Tokens:
    """Words and sign runs: byte ``starts`` and ``ends``, ``hashes``, and the range per text."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        kind = KIND[data]
        change = np.ones(len(data) + 1, dtype=bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[at] = True
        edges = np.flatnonzero(change)
        solid = np.flatnonzero(kind[edges[:-1]]) if len(edges) > 1 else np.zeros(0, np.int64)
        self.starts, self.ends = edges[:-1][solid], edges[1:][solid]
        self.at = np.searchsorted(self.starts, at)
        self.hashes = common.span_hash(common.prefix_hash(data, common.LOWERED), self.starts, self.ends)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def pairs(hashes: np.ndarray) -> np.ndarray:
    """Hash of each word with the one before it; a word after itself counts as one sign, and
    so does a word that stood two places before."""
    out = common.mix(hashes[1:] * np.uint64(common._Q) + hashes[:-1])
    out[hashes[1:] == hashes[:-1]] = 1
    back = np.flatnonzero(hashes[2:] == hashes[:-2])
    out[1:][back] = 2
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int = FIT_ON) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents outside the held-out part.

    The ids are chosen first, so only a table of ``limit`` ids is joined with the texts.
    Labels other than 0 and 1 are not used; of several for one document the largest counts.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & ~common.held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(limit)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


class Ftrl:
    """Follow-the-regularised-leader weights for logistic models, updated per example."""

    def __init__(self, size: int, rate: float, smooth: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.l1) / ((self.smooth + np.sqrt(n)) / self.rate + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, i: np.ndarray, w: np.ndarray, g: np.ndarray) -> None:
        more = self.n[i] + g * g
        self.z[i] += g - (np.sqrt(more) - np.sqrt(self.n[i])) / self.rate * w
        self.n[i] = more


def fitted(sample: DataFrame, fit) -> np.ndarray:
    """Run ``fit(texts, labels) -> weights`` over the bounded sample in one task."""

    def run(batches):
        texts, marks = [], []
        for batch in batches:
            texts.append(batch.column("text"))
            marks.append(batch.column("label"))
        if not texts:
            return
        table = pa.chunked_array(texts).combine_chunks(), pa.chunked_array(marks).to_numpy()
        w = fit(*table)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float64).tobytes()], pa.binary())], ["w"])

    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    got = one.select("text", "label").mapInArrow(run, "w binary").first()
    return np.frombuffer(got[0], dtype=np.float64) if got else None


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
