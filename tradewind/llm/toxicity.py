"""Toxicity by multiple-instance learning (operator 5).

Each sentence has a logistic score of its hashed words and word pairs; a document is toxic with
the noisy-or of its sentences, 1 - product of (1 - sentence score). Weights are learned from
labels of documents alone; the sentence scores then tell where the offence is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import common, features
from tradewind.llm.features import BUCKETS, Ftrl, Tokens, sigmoid

EPOCHS = 5
# Log-odds of a sentence with no known words, before any training.
START = -6.0
RATE, L1 = 2.0, 3.0
# Words of fewer than this share of the documents, or of fewer than three, get no weight.
SHARE = 0.001

_END = np.zeros(256, dtype=bool)
_END[[10, 33, 46, 63]] = True


class Sentences:
    """Buckets per sentence, sentence ranges per text, and byte places of sentences."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        tokens = Tokens(data, at)
        n = len(tokens.starts)
        text = np.repeat(np.arange(len(at) - 1), np.diff(tokens.at))
        stops = np.concatenate([[0], np.cumsum(_END[data])])
        # A word belongs to the sentence numbered by the stops before it.
        number = stops[tokens.starts] if n else np.zeros(0, np.int64)
        word = features.KIND[data[tokens.starts]] == 1 if n else np.zeros(0, bool)
        new = np.ones(n, dtype=bool)
        new[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
        sentence = np.cumsum(new) - 1
        self.n = int(sentence[-1]) + 1 if n else 0
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)[: self.n] - 1
        origin = at[text[first]] if n else first
        self.start = tokens.starts[first] - origin if n else first
        self.end = tokens.ends[last] - origin if n else first
        self.at = np.searchsorted(first, tokens.at)
        one = np.flatnonzero(word)
        two = np.flatnonzero(~new)
        joined = features.buckets(features.pairs(tokens.hashes)[two - 1]) if len(two) else two
        place = np.concatenate([sentence[one], sentence[two]])
        order = np.argsort(place, kind="stable")
        self.features = np.concatenate([features.buckets(tokens.hashes[one]), joined])[order]
        self.feature_at = np.searchsorted(place[order], np.arange(self.n + 1))

    def scores(self, w: np.ndarray) -> np.ndarray:
        return sigmoid(common.per_text(np.add, w[self.features], self.feature_at, 0.0) + w[BUCKETS])


def _fit(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    model = Ftrl(BUCKETS + 1, rate=RATE, smooth=1.0, l1=L1, l2=0.0)
    model.z[BUCKETS] = -START / RATE - L1 * np.sign(START)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    # Words of very few documents tell those documents apart, not their kind.
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for part in common.slices(batch, "text"):
        bag = Sentences(*common.text_bytes(part.column("text")))
        text_at = bag.feature_at[bag.at]
        for k in range(part.num_rows):
            seen[np.unique(bag.features[text_at[k] : text_at[k + 1]])] += 1
    usual = seen >= max(3, len(labels) * SHARE)
    for _ in range(EPOCHS):
        row = 0
        for part in common.slices(batch, "text"):
            bag = Sentences(*common.text_bytes(part.column("text")))
            for k in range(part.num_rows):
                s, e = bag.at[k], bag.at[k + 1]
                y, row = labels[row], row + 1
                if s == e:
                    continue
                lo, hi = bag.feature_at[s], bag.feature_at[e]
                known = usual[bag.features[lo:hi]]
                owner = np.repeat(np.arange(e - s), np.diff(bag.feature_at[s : e + 1]))[known]
                i, back = np.unique(bag.features[lo:hi][known], return_inverse=True)
                i = np.append(i, BUCKETS)
                w = model.weights(i)
                z = np.bincount(owner, w[back], minlength=e - s) + w[-1]
                p = sigmoid(z)
                whole = -np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
                g = p if not y else -p * (1 - whole) / max(whole, 1e-9)
                model.update(i, w, np.append(np.bincount(back, g[owner], minlength=len(i) - 1), g.sum()))
    return model.weights()


_OUT = (
    "doc_id long, held_out boolean, score double, n_sentences long,"
    " offending array<struct<start: int, end: int, score: double>>"
)


def _score(w: np.ndarray, threshold: float):
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for part in common.slices(batch, "text"):
                bag = Sentences(*common.text_bytes(part.column("text")))
                p = bag.scores(w)
                safe = np.log1p(-np.minimum(p, 1 - 1e-15))
                score = -np.expm1(common.per_text(np.add, safe, bag.at, 0.0))
                bad = p >= threshold
                places = np.concatenate([[0], np.cumsum(bad)])[bag.at]
                spans = pa.StructArray.from_arrays(
                    [pa.array(bag.start[bad], pa.int32()), pa.array(bag.end[bad], pa.int32()), pa.array(p[bad])],
                    fields=list(kind),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(score),
                        pa.array(np.diff(bag.at), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(places, pa.int32()), spans),
                    ],
                    ["doc_id", "held_out", "score", "n_sentences", "offending"],
                )

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences and the offending sentences (byte start
    and end in the text, score) for every row of ``docs``.

    The model is fitted on at most ``features.FIT_ON`` labelled documents. Empty, blank and null
    texts have no sentence and score 0, as do all texts where there are no labels to learn from.
    """
    w = features.fitted(features.labelled_sample(docs, labels, "toxic"), _fit)
    if w is None:
        w = np.zeros(BUCKETS + 1)
        w[BUCKETS] = -np.inf
    held = F.coalesce(common.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
        .mapInArrow(_score(w, threshold), _OUT)
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
