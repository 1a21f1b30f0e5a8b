"""Spelling variants grouped under their commonest form (operator 11).

1. One pass over the texts counts words. A task combines its counts before the shuffle and
   gives them up whenever its table is full, so its memory does not grow with the text.
2. Words that differ by one edit are found inside blocks. If the shorter of two near words has
   l letters and a letters before the edit, the words agree in those a letters and in the last
   l - a - 1. The places 0 to l are cut in two ranges; a block holds the words that agree in
   everything outside one range, so every near pair meets in the one block whose range holds
   its a. A block of more than ``BLOCK`` words is cut again at the middle of its range, until
   none is left: a range of one place leaves one letter free, which bounds the block by the
   alphabet. No block is given up and none is compared whole in one task.
3. A block is a sorted list. Each word is held against the ones behind it with a banded edit
   matrix; the rows of the prefix that the next word shares with the one before stay, and as
   soon as a row has no value within one edit, all words with that prefix are passed over.
4. A word's form is its near word of the largest count, if that is ``factor`` times its own or
   more. Forms are followed by pointer doubling, with as many rounds as the logarithm of the
   longest chain; counts rise tenfold on each step, so chains are short and have no cycles.

Null and empty texts have no words. Rows that repeat an id count again; a null id is written as
empty text in the hash. Texts of any length are read in pieces cut between words. Ties for the form go to the
smallest word in code-point order. An empty table gives no rows, and columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stage

SHORTEST = 7
DAMAGED = 31
FACTOR = 10
# Words of a block that are compared in one task; more than a range of one place can leave.
BLOCK = 1024
# Distinct words a task counts before it gives them up, and code points read at a time.
KEPT_WORDS, PIECE = 200_000, 1 << 20

# One byte per code point: letters of the alphabet with A-Z lowered, all else a blank.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def _runs(text: str) -> Iterator[bytes]:
    """The text's letters in Latin-1 with blanks between the runs, in pieces cut at blanks."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        piece = text[start:end].encode("latin-1", "replace").translate(_LETTERS)
        while end < len(text) and piece[-1] != 32:
            more = text[end : end + PIECE].encode("latin-1", "replace").translate(_LETTERS)
            cut = more.find(b" ") + 1 or len(more)
            piece += more[:cut]
            end += cut
        yield piece
        start = end


def _counted(shortest: int, damaged: int):
    def table(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for piece in _runs(text.as_py() or ""):
                    for word, n in Counter(piece.split()).items():
                        size = len(word)
                        if size < shortest:
                            continue
                        if damaged:
                            utf8 = word if word.isascii() else word.decode("latin-1").encode()
                            h = zlib.crc32(utf8, start)
                            if h % damaged == 0:
                                if size == shortest:
                                    continue
                                gone = h % size
                                word = word[:gone] + word[gone + 1 :]
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) > KEPT_WORDS:
                        yield table(counts)
                        counts = {}
        yield table(counts)

    return run


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, damaged: int = DAMAGED, least: int = 2) -> DataFrame:
    """(word, n) of all words of at least ``shortest`` letters that occur ``least`` times.

    Every ``damaged``-th (document, word), by crc32 of ``doc_id:word``, loses one letter; 0
    leaves all words as they are.
    """
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_counted(shortest, damaged), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        middle = (lo + hi) // 2
        if a[:middle] == b[:middle]:
            lo = middle
        else:
            hi = middle
    return lo


def near_pairs(words: list[str], lo: int = 0, hi: int | None = None) -> Iterator[tuple[int, int]]:
    """(i, k) of all words at exactly one edit, i before k in the sorted list of distinct ``words``,
    whose common prefix has ``lo`` letters or more and fewer than ``hi``."""
    shared = [0, *(shared_prefix(a, b) for a, b in zip(words, words[1:]))]
    total = len(words)
    for i, word in enumerate(words):
        size = len(word)
        # Cells d - 1, d and d + 1 of the row of the first d letters; of the word itself at first.
        rows = [(1, 0, 1)] * (size + 1)
        rows[0] = (2, 0, 1)
        asked = f"\0{word}\0\0\0"
        alike, valid, k = size, size, i + 1
        while k < total:
            keep = shared[k]
            if keep < alike:
                if keep < lo:
                    break
                alike = keep
            if keep < valid:
                valid = keep
            other = words[k]
            k += 1
            if hi is not None and alike >= hi:
                continue
            del rows[valid + 1 :]
            left, middle, right = rows[valid]
            for d in range(valid + 1, len(other) + 1):
                letter = other[d - 1]
                if d > size + 2:
                    dead = True
                else:
                    left = min(left + (asked[d - 1] != letter), middle + 1)
                    middle = min(middle + (asked[d] != letter), right + 1, left + 1)
                    right = min(right + (asked[d + 1] != letter), middle + 1)
                    dead = left > 1 and middle > 1 and right > 1
                if dead:
                    while k < total and shared[k] >= d:
                        k += 1
                    valid = d - 1
                    break
                rows.append((left, middle, right))
            else:
                valid = len(other)
                beyond = size - valid
                if -1 <= beyond <= 1 and (left, middle, right)[beyond + 1] == 1:
                    yield i, k - 1


_PAIR = "word string, n long, near string, near_n long"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of blocks that come one after another, each sorted by word."""
    carried: pa.RecordBatch | None = None

    def found(part: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
        words, counts = part.column("word").to_pylist(), part.column("n").to_pylist()
        los, his, least = (part.column(c).to_pylist() for c in ("lo", "hi", "l"))
        rows: list[tuple] = []
        for s, e in zip(edges, edges[1:]):
            if e - s < 2:
                continue
            block = words[s:e]
            for i, k in near_pairs(block, los[s], his[s]):
                a, b = block[i], block[k]
                if min(len(a), len(b)) == least[s]:
                    rows += [(a, counts[s + i], b, counts[s + k]), (b, counts[s + k], a, counts[s + i])]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = zip(*rows) if rows else ((),) * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], ["word", "n", "near", "near_n"]
        )

    for batch in batches:
        if carried is not None:
            batch = pa.concat_batches([carried, batch])
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for name in ("key", "l", "lo", "hi"):
            values = batch.column(name).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(new).tolist()]
        yield found(batch, edges)
        carried = batch.slice(edges[-1])
    if carried is not None:
        yield found(carried, [0, carried.num_rows])


def _keyed(rows: DataFrame, level: int) -> DataFrame:
    """Block key of every (word, n, l, part): what lies outside range ``part`` of the places."""
    size = 1 << level
    placed = rows.withColumn("lo", F.expr(f"part * (l + 1) div {size}")).withColumn(
        "hi", F.expr(f"(part + 1) * (l + 1) div {size}")
    )
    outside = F.xxhash64(F.left("word", F.col("lo").cast("int")), F.right("word", F.greatest(F.col("l") - F.col("hi"), F.lit(0)).cast("int")))
    return placed.where("lo < hi").withColumn("key", outside)


def _blocks(words: DataFrame, shortest: int, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (word, n, l, lo, hi, key) of blocks of at most ``limit`` words, and what was staged."""
    letters = F.length("word").cast("long")
    rows = (
        words.select("word", "n", F.explode(F.array(letters, letters - 1)).alias("l"))
        .where(F.col("l") >= shortest)
        .select("*", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("part"))
    )
    on, done, staged, level = ["l", "part", "key"], [], [], 1
    while True:
        rows = stage(_keyed(rows, level))
        large = stage(rows.groupBy(*on).agg(F.count("*").alias("size")).where(F.col("size") > limit).drop("size"))
        staged += [rows, large]
        further = large.where(f"l + 1 > {1 << level}")
        if not further.head(1):
            done.append(rows)
            break
        done.append(rows.join(further, on, "left_anti"))
        halves = F.explode(F.array(F.col("part") * 2, F.col("part") * 2 + 1)).alias("part")
        rows = rows.join(further, on, "left_semi").select("word", "n", "l", halves)
        level += 1
    columns = ["word", "n", "l", "lo", "hi", "key"]
    return reduce(DataFrame.unionByName, [d.select(*columns) for d in done]), staged


def near_words(words: DataFrame, shortest: int = SHORTEST, limit: int = BLOCK) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs of ``words`` (word, n; words distinct, of at
    least ``shortest`` letters) that are one inserted, deleted or replaced letter apart."""
    blocks, staged = _blocks(words, shortest, limit)
    out = stage(
        blocks.repartition("l", "lo", "hi", "key")
        .sortWithinPartitions("l", "lo", "hi", "key", "word")
        .mapInArrow(_scanned, _PAIR)
    )
    discard(*staged)
    return out


def _followed(links: DataFrame) -> DataFrame:
    """(word, root): where following ``links`` (word, form) ends."""
    ends = stage(links.select("word", F.col("form").alias("root")))
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not ends.join(onward, "root", "left_semi").head(1):
            return ends
        moved = stage(ends.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        discard(ends)
        ends = moved


def variants(
    docs: DataFrame,
    shortest: int = SHORTEST,
    damaged: int = DAMAGED,
    factor: int = FACTOR,
    limit: int = BLOCK,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that occurs twice or more."""
    words = stage(vocabulary(docs, shortest, damaged))
    pairs = near_words(words, shortest, limit)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    nearest = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min("n").alias("own"), best)
    common = -F.col("best.less") >= factor * F.col("own")
    formed = stage(
        nearest.select(
            "word", "n_near", F.when(common, F.col("best.word")).alias("form"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _followed(formed.where("form IS NOT NULL"))
    out = stage(
        words.join(formed, "word", "left").join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )
    discard(words, pairs, formed, roots)
    return out
