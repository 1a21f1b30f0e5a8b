"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader
(operator 4)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import common, features
from tradewind.llm.features import BUCKETS, Ftrl, Tokens, sigmoid

EPOCHS = 3
# Feature values are shares of a text's n-grams, times this.
SCALE = 30.0
THRESHOLD = 0.3


def _grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of each text, and their ranges."""
    tokens = Tokens(data, at)
    two, two_at = common.gram_starts(tokens.at, 2)
    single = np.diff(tokens.at)
    out_at = tokens.at + two_at
    out = np.empty(out_at[-1], dtype=np.int64)
    text = np.repeat(np.arange(len(single)), single)
    out[np.arange(len(text)) + two_at[text]] = features.buckets(tokens.hashes)
    if len(two):
        text = np.repeat(np.arange(len(single)), np.diff(two_at))
        out[np.arange(len(two)) + tokens.at[text + 1]] = features.buckets(features.pairs(tokens.hashes)[two])
    return out, out_at


def _fit(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    model = Ftrl(BUCKETS + 1, rate=0.3, smooth=1.0, l1=0.002, l2=0.0)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for _ in range(EPOCHS):
        row = 0
        for part in common.slices(batch, "text"):
            found, at = _grams(*common.text_bytes(part.column("text")))
            for k in range(part.num_rows):
                i, count = np.unique(found[at[k] : at[k + 1]], return_counts=True)
                x = np.append(count * (SCALE / max(1, at[k + 1] - at[k])), 1.0)
                i = np.append(i, BUCKETS)
                w = model.weights(i)
                model.update(i, w, (sigmoid(w @ x) - labels[row]) * x)
                row += 1
    return model.weights()


def _scores(w: np.ndarray, texts: pa.Array) -> np.ndarray:
    found, at = _grams(*common.text_bytes(texts))
    total = common.per_text(np.add, w[found], at, 0.0)
    return sigmoid(total * SCALE / np.maximum(np.diff(at), 1) + w[BUCKETS])


def _score(w: np.ndarray):
    def run(batches):
        for batch in batches:
            for part in common.slices(batch, "text"):
                score = _scores(w, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score)],
                    ["doc_id", "held_out", "score"],
                )

    return run


def _accept(w: np.ndarray, threshold: float):
    def run(batches):
        for batch in batches:
            for part in common.slices(batch, "text"):
                yield part.filter(pa.array(_scores(w, part.column("text")) >= threshold))

    return run


def _weights(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    w = features.fitted(features.labelled_sample(docs, labels, "quality"), _fit)
    return np.zeros(BUCKETS + 1) if w is None else w


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns kept."""
    return docs.mapInArrow(_accept(_weights(docs, labels), threshold), docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    The model is fitted on at most ``features.FIT_ON`` labelled documents; every document is
    scored, as the dot product of its n-gram shares with the weights. Empty and null texts get
    the score of the bias alone. Without any labels all scores are 0.5. A row without doc_id
    counts as not held out.
    """
    w = _weights(docs, labels)
    held = F.coalesce(common.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
        .mapInArrow(_score(w), "doc_id long, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
