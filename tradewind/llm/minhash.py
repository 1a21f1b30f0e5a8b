"""MinHash near-duplicate removal with b-bit signatures (operator 1).

1. One pass over the texts: the set of hashed word shingles of each document, its size, a
   128-bit fingerprint of the set, ``BANDS`` band keys of ``ROWS`` minima each, and a packed
   signature that keeps the four low bits of every minimum.
2. Documents with equal fingerprints form a class; only its representative goes on.
3. Classes that share a band key are candidates. Their similarity is first estimated from
   the packed bits, by bit counts, corrected for the sixteenth of unequal minima whose four
   bits agree by chance, and checked by a parity sketch of the whole sets; only pairs well
   below the threshold are left out.
4. Candidates are confirmed on full shingle sets, rebuilt from the texts. In the first round
   each class meets the best partner among the heads (least ids) of its bands. In the second,
   all pairs of a band that are not yet in one component are compared. So a group of n near
   copies costs some n comparisons, not n squared, and no link that joins two components is
   left out.

Ids must not repeat for different texts; rows that repeat an id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import common
from tradewind.llm.common import discard, stage
from tradewind.llm.components import components

BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
PACKED = MINIMA * BITS // 64
# Estimates this far below the threshold are still confirmed: 3.9 standard deviations.
SLACK = 0.155
# Bits of the parity sketch of the whole set, and the standard deviations allowed for it.
SKETCH, DEVIATIONS = 1024, 4.0

_A = common.mix(np.arange(1, MINIMA + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_SIGNATURE = (
    "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>, bits array<long>,"
    " sketch array<long>"
)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                values, at = common.shingle_sets(*common.text_bytes(part.column("text")), size)
                n = np.diff(at)
                full = np.flatnonzero(n)
                minima = np.zeros((MINIMA, len(full)), dtype=np.uint32)
                if len(full):
                    short = (values >> np.uint64(32)).astype(np.uint32)
                    place, starts = np.empty_like(short), at[:-1][full]
                    for j in range(MINIMA):
                        np.multiply(short, _A[j], out=place)
                        minima[j] = np.minimum.reduceat(place, starts)
                grouped = minima.reshape(BANDS, ROWS, -1).astype(np.uint64)
                keys = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.ones(len(full), np.uint64)
                for r in range(ROWS):
                    keys = common.mix(keys + grouped[:, r])
                low = common.mix(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
                each = 64 // BITS
                shift = (np.arange(each, dtype=np.uint64) * np.uint64(BITS))[None, :, None]
                packed = np.bitwise_or.reduce(low.reshape(PACKED, each, -1) << shift, axis=1)
                owner = np.repeat(np.arange(len(full)), n[full])
                place = owner * SKETCH + (values & np.uint64(SKETCH - 1)).astype(np.int64)
                odd = (np.bincount(place, minlength=len(full) * SKETCH) & 1).astype(np.uint8)
                sketch = np.packbits(odd).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(n > 0)])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(common.per_text(np.add, values, at).view(np.int64)),
                        pa.array(common.per_text(np.add, common.mix(values + np.uint64(7)), at).view(np.int64)),
                        common.list_column(keys.T.ravel().view(np.int64), ends * BANDS, pa.int64()),
                        common.list_column(packed.T.ravel().view(np.int64), ends * PACKED, pa.int64()),
                        common.list_column(sketch, ends * (SKETCH // 64), pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "print_a", "print_b", "bands", "bits", "sketch"],
                )

    return run


def signatures(docs: DataFrame, size: int = 5) -> DataFrame:
    """Shingle count, set fingerprint, band keys and packed minima of each (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _signatures(size), _SIGNATURE
    )


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures, corrected for chance agreement."""
    lowest = F.lit(sum(1 << k for k in range(0, 64, BITS)))
    unequal = F.lit(0)
    for k in range(PACKED):
        differ = a[k].bitwiseXOR(b[k])
        for step in (1, 2):
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, step))
        unequal = unequal + F.bit_count(differ.bitwiseAND(lowest))
    chance = 1.0 / (1 << BITS)
    return ((1 - unequal / float(MINIMA)) - chance) / (1 - chance)


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text_a", "text_b"):
                left, left_at = common.shingle_sets(*common.text_bytes(part.column("text_a")), size)
                right, right_at = common.shingle_sets(*common.text_bytes(part.column("text_b")), size)
                linked = []
                for k in range(part.num_rows):
                    x, y = left[left_at[k] : left_at[k + 1]], right[right_at[k] : right_at[k + 1]]
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    common_size = int(np.count_nonzero(both[1:] == both[:-1]))
                    linked.append(100 * common_size >= percent * (len(both) - common_size))
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.select("a", "b").join(left, "a").join(right, "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_confirm(size, percent), "a long, b long")
        .distinct()
    )


def _apart_at_most(percent: int) -> Column:
    """Whether the parity sketches allow so small a symmetric difference as the threshold asks.

    A bit is the parity of the set's members hashed to it, so unequal bits count the members of
    one set only. With x = exp(-2 d / SKETCH), a difference of d leaves SKETCH / 2 * (1 - x) of
    them in the mean, with variance SKETCH / 4 * (1 - x * x) - d * x * x.
    """
    unequal = F.lit(0)
    for k in range(SKETCH // 64):
        unequal = unequal + F.bit_count(F.col("sketch_a")[k].bitwiseXOR(F.col("sketch_b")[k]))
    most = (F.col("n_a") + F.col("n_b")) * ((100 - percent) / (100 + percent))
    x = F.exp(most * (-2.0 / SKETCH))
    spread = F.sqrt(F.greatest(F.lit(0.0), (1 - x * x) * (SKETCH / 4) - most * x * x))
    return unequal <= (1 - x) * (SKETCH / 2) + 1 + spread * DEVIATIONS


def _near_enough(percent: int) -> Column:
    """Whether sizes, packed minima and sketches allow a pair to reach the threshold."""
    share = percent / 100
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    minima = estimate(F.col("bits_a"), F.col("bits_b")) >= share - SLACK
    return sizes & minima & _apart_at_most(percent)


def _best(pairs: DataFrame) -> DataFrame:
    """For each b the partner a of the highest estimate."""
    near = F.struct(estimate(F.col("bits_a"), F.col("bits_b")), -F.col("a"))
    return pairs.groupBy("b").agg(F.max_by("a", near).alias("a")).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Links join documents with 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles. Null and blank texts have empty sets and link with nothing. A row
    without doc_id links with nothing, has no component, and is kept. An empty table gives an
    empty table. Other columns of ``docs`` are not looked at.
    """
    signed = stage(signatures(docs, size))
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    prints = ["n_shingles", "print_a", "print_b"]
    classes = named.groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    members = stage(
        named.join(classes, prints).select(
            "doc_id", "rep", "n_shingles",
            F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands"),
            F.when(F.col("doc_id") == F.col("rep"), F.col("bits")).alias("bits"),
            F.when(F.col("doc_id") == F.col("rep"), F.col("sketch")).alias("sketch"),
        )
    )
    reps = members.where("bands IS NOT NULL").dropDuplicates(["doc_id"])
    # Rows of a band key that at least two classes share.
    keyed = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("band"))
    heads = keyed.groupBy("band").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = stage(keyed.join(heads, "band").select("band", "id", "head"))

    known = reps.select(F.col("doc_id").alias("id"), "n_shingles", "bits", "sketch", "bands")
    side_a = known.drop("bands").toDF("a", "n_a", "bits_a", "sketch_a")
    side_b = known.drop("bands").toDF("b", "n_b", "bits_b", "sketch_b")

    def plausible(pairs: DataFrame) -> DataFrame:
        return pairs.join(side_a, "a").join(side_b, "b").where(_near_enough(percent))

    starred = shared.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    first = stage(_best(plausible(starred)))
    # Texts of all classes that share a band: every pair to confirm is among them.
    wanted = shared.select(F.col("id").alias("doc_id")).distinct()
    texts = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi"),
        "zstd",
    )
    single = texts.dropDuplicates(["doc_id"]) if _repeats(reps, signed) else texts
    links = stage(confirmed(first, single, size, percent))
    grouped = stage(components(links))

    # Last, all pairs of a band that lie in different components and were not tried yet.
    placed = shared.join(grouped, "id", "left").select(
        "band", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = (
        placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi").select("band")
    )
    rest = stage(placed.join(mixed, "band").join(known, "id"))
    x = rest.select(
        "band", F.col("id").alias("a"), F.col("component").alias("component_a"), F.col("n_shingles").alias("n_a"),
        F.col("bits").alias("bits_a"), F.col("sketch").alias("sketch_a"), F.col("bands").alias("bands_a"),
    )
    y = x.toDF("band", "b", "component_b", "n_b", "bits_b", "sketch_b", "bands_b")
    apart = (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b"))
    # A pair that shares several bands counts in one of them.
    once = x["band"] == F.array_min(F.array_intersect("bands_a", "bands_b"))
    second = (
        x.join(y, (x["band"] == y["band"]) & apart & _near_enough(percent) & once).select("a", "b")
        .join(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    more = stage(confirmed(second, single, size, percent))
    final = grouped
    if more.head(1):
        joined = grouped.toDF("a", "b").where("a <> b").unionByName(more)
        final = components(joined)
    final = final.toDF("rep", "component")
    homes = members.select("doc_id", "rep").join(final, "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component_id")
    ).dropDuplicates(["doc_id"])
    out = stage(
        signed.select("doc_id", "n_shingles").join(homes, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
    discard(signed, members, shared, first, texts, links, grouped, rest, more)
    return out


def _repeats(reps: DataFrame, signed: DataFrame) -> bool:
    """Whether any doc_id occurs twice."""
    return bool(signed.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").head(1))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id, and with one row
    of each id that is kept. Of rows that repeat an id the one whose text has the least hash stays; rows
    without an id all stay."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = stage(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    row = F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("row")
    one = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(row).select("row.*")
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
