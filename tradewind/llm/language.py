"""Language identification by a mixture of languages per document (operator 7).

Each language has smoothed frequencies of hashed byte trigrams of its words, counted over all
training documents. The likelihood of a word under a language is the product of its trigrams'.
For a document, expectation-maximisation estimates the share of each language in its words. The
set of languages is chosen by penalised likelihood: a language stays only if the words fit
better with it by more than the penalty of a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import common

BUCKETS = 1 << 16
SMOOTH = 0.5
STEPS = 12
# Penalty for each further language, in units of log(words) / 2.
PENALTY = 4.0
UNKNOWN = "und"

_LOW = np.arange(256, dtype=np.uint32)
_LOW[65:91] += 32
# All signs and blanks are one border; digits too.
_LOW[[b for b in range(128) if not 97 <= b <= 122 and not 65 <= b <= 90]] = 32


class Trigrams:
    """Words of some texts as runs of letters, and the trigram bucket at each of their bytes."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        low = _LOW[data]
        letter = low != 32
        change = np.ones(len(data) + 1, dtype=bool)
        change[1:-1] = letter[1:] != letter[:-1]
        change[at] = True
        edges = np.flatnonzero(change)
        solid = np.flatnonzero(letter[edges[:-1]]) if len(edges) > 1 else np.zeros(0, np.int64)
        starts, ends = edges[:-1][solid], edges[1:][solid]
        self.at = np.searchsorted(starts, at)
        size = ends - starts
        self.word_at = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(self.word_at[-1]) + np.repeat(starts - self.word_at[:-1], size)
        first = np.zeros(len(place), dtype=bool)
        last = np.zeros(len(place), dtype=bool)
        first[self.word_at[:-1]] = True
        last[self.word_at[1:] - 1] = True
        left = np.where(first, 32, low[np.maximum(place - 1, 0)])
        right = np.where(last, 32, low[np.minimum(place + 1, max(len(data) - 1, 0))]) if len(place) else left
        key = (left << np.uint32(16)) | (low[place] << np.uint32(8)) | right
        self.buckets = (key * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in common.slices(batch, "text"):
            found = Trigrams(*common.text_bytes(part.column("text")))
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.searchsorted(names, langs)
            size = np.diff(found.word_at[found.at])
            place = np.repeat(number, size) * BUCKETS + found.buckets
            counts = np.bincount(place, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, row in zip(names, counts):
                total[name] = total.get(name, 0) + row
    for name, row in total.items():
        some = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(row[some], pa.int64())],
            ["lang", "bucket", "n"],
        )


def language_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log frequencies of trigrams, over all training rows of ``docs``.

    There are at most BUCKETS numbers per language, whatever the size of the corpus.
    """
    training = docs.where(F.col("lang").isNotNull() & ~common.held_out(F.col("doc_id")) & F.col("text").isNotNull())
    rows = (
        training.select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_counts, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
        .orderBy("lang").collect()
    )
    table = np.full((len(rows), BUCKETS), SMOOTH)
    for k, row in enumerate(rows):
        table[k, row["b"]] += row["n"]
    return [r["lang"] for r in rows], np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _mixture(like: np.ndarray, at: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares (texts by languages) after ``steps`` of expectation-maximisation, and the likelihood.

    ``like`` holds word likelihoods relative to each word's best language.
    """
    size = np.diff(at)
    full = np.flatnonzero(size)
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    owner = np.repeat(np.arange(len(size)), size)
    total = np.zeros(len(size))
    for step in range(steps + 1):
        joint = like * share[owner]
        mass = joint.sum(axis=1)
        if step == steps:
            total[full] = np.add.reduceat(np.log(np.maximum(mass, 1e-30)), at[:-1][full])
            break
        joint /= np.maximum(mass, 1e-30)[:, None]
        share[full] = np.add.reduceat(joint, at[:-1][full], axis=0) / size[full, None]
    return share, total


def identify(found: Trigrams, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of all languages and the chosen sets (both texts by languages)."""
    texts, langs = len(found.at) - 1, len(model)
    words = len(found.word_at) - 1
    like = np.empty((words, langs))
    for k in range(langs):
        like[:, k] = np.add.reduceat(model[k][found.buckets], found.word_at[:-1]) if words else 0
    best = like.max(axis=1, keepdims=True)
    relative = np.maximum(like - best, -30.0)
    like = np.exp(relative)
    share, fit = _mixture(like, found.at, np.ones((texts, langs)), STEPS)
    size = np.diff(found.at)
    price = PENALTY * np.log(np.maximum(size, 2)) / 2
    order = np.argsort(-share, axis=1, kind="stable")
    chosen = np.zeros((texts, langs), dtype=bool)
    rows = np.arange(texts)
    chosen[rows, order[:, 0]] = True
    alone = np.zeros((texts, langs))
    full = np.flatnonzero(size)
    if words:
        alone[full] = np.add.reduceat(relative, found.at[:-1][full], axis=0)
    score = alone[rows, order[:, 0]]
    # The fit of the whole mixture bounds what any set can reach.
    going = np.flatnonzero((size > 0) & (fit - price > score))
    for k in range(1, langs):
        if not len(going):
            break
        trial = chosen[going].copy()
        trial[np.arange(len(going)), order[going, k]] = True
        picked, at = _rows(found.at, going)
        _, reached = _mixture(like[picked], at, trial.astype(float), STEPS)
        reached -= price[going] * k
        better = reached > score[going]
        going, trial, reached = going[better], trial[better], reached[better]
        chosen[going], score[going] = trial, reached
    return share, chosen


def _rows(at: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(at)[some]
    ends = np.concatenate([[0], np.cumsum(size)])
    return np.arange(ends[-1]) + np.repeat(at[:-1][some] - ends[:-1], size), ends


_OUT = "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang: string, share: double>>"


def _predict(langs: list[str], model: np.ndarray):
    kind = pa.struct([("lang", pa.string()), ("share", pa.float64())])
    names = np.array([*langs, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                known = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
                found = Trigrams(*common.text_bytes(part.column("text")))
                share, chosen = identify(found, model)
                share = np.where(chosen, share, 0.0)
                share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
                top = np.where(known, share.argmax(axis=1), len(langs))
                score = np.where(known, share.max(axis=1), 0.0)
                chosen &= known[:, None]
                row, lang = np.nonzero(chosen)
                places = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))])
                parts = pa.StructArray.from_arrays(
                    [pa.array(names[lang], pa.string()), pa.array(share[row, lang])], fields=list(kind)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(names[top], pa.string()),
                        pa.array(score), pa.ListArray.from_arrays(pa.array(places, pa.int32()), parts),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "languages"],
                )

    return run


def predicted_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of that language) and the chosen languages with
    their shares, for every row of ``docs`` (doc_id, text, lang).

    Texts that are null or have no letter are ``und`` with score 0, and so are all where there
    is nothing to learn from. A row without doc_id counts as not held out and is not learned from.
    """
    langs, model = language_model(docs)
    held = F.coalesce(common.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) if langs else F.lit(False)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text", letter.alias("has_letter"))
    if not langs:
        none = F.expr("CAST(array() AS array<struct<lang: string, share: double>>)")
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("languages"))
    return rows.mapInArrow(_predict(langs, model), _OUT)
