"""Helpers of the text operators: written intermediates, batches of bounded size,
word and byte hashes over whole Arrow batches.

Text reaches Python only inside ``mapInArrow``. Each Arrow batch is cut into slices of
``SLICE_BYTES`` of text (one row at least), and every slice is handled as one byte
buffer with numpy, so no statement runs once per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.staging import staging_root

SLICE_BYTES = 1 << 21

# Odd multipliers of the rolling and mixing hashes.
_P = 0x9E3779B97F4A7C15
_Q = 0xC2B2AE3D27D4EB4F
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, compression: str = "lz4") -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back: this cuts the
    lineage, and a lost executor costs no more than the tasks it held."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == 0


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix(b * np.uint64(_Q) + np.uint64(_P))


LOWERED = _byte_values(True)
EXACT = _byte_values(False)
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True

_powers = {"n": 0}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling multiplier and of its inverse modulo 2**64."""
    if _powers["n"] < n:
        size = max(n, SLICE_BYTES + 1)
        up = np.full(size, _P, dtype=np.uint64)
        down = np.full(size, pow(_P, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers.update(n=size, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """h with h[e] - h[s] the unanchored hash of data[s:e]; multiply by the inverse power of s."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer and the n + 1 offsets of the texts in it; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind, count=len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, *columns: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes in ``columns``, one row at least."""
    if not batch.num_rows:
        return
    size = sum(
        pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for c in columns
    )
    total, start = np.cumsum(size), 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


class Words:
    """The words of some texts: byte ``starts`` and ``ends``, and per text the range ``at``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = True):
        n = len(data)
        blank = BLANK[data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[at] = True
        first = ~blank
        first[1:] &= blank[:-1] | cut[1:-1]
        last = ~blank
        last[:-1] &= blank[1:] | cut[1:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.at = np.searchsorted(self.starts, at)
        self.hashes = span_hash(prefix_hash(data, LOWERED if lower else EXACT), self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, text borders not heeded."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, dtype=np.uint64)
    factor = 1
    for k in range(n):
        out += words[k : k + size] * np.uint64(factor)
        factor = factor * _Q % (1 << 64)
    return mix(out)


def gram_starts(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes where an n-gram lies wholly in its text, and the n-gram range per text."""
    count = np.maximum(np.diff(at) - n + 1, 0)
    ends = np.concatenate([[0], np.cumsum(count)])
    starts = np.arange(ends[-1]) + np.repeat(at[:-1] - ends[:-1], count)
    return starts, ends


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their ranges.

    A text of fewer than ``size`` words has its whole word sequence as one shingle.
    """
    words = Words(data, at)
    n = np.diff(words.at)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(count)])
    values = np.empty(ends[-1], dtype=np.uint64)
    starts, _ = gram_starts(words.at, size)
    long = np.ones(len(values), dtype=bool)
    short = np.flatnonzero((n > 0) & (n < size))
    long[ends[short]] = False
    values[long] = grams(words.hashes, size)[starts]
    for k in range(1, size):
        some = short[n[short] == k]
        own = np.full(len(some), k, dtype=np.uint64)
        for j in range(k):
            own = mix(own * np.uint64(_Q) + words.hashes[words.at[some] + j])
        values[ends[some]] = own
    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
        values[s:e].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[ends[:-1][count > 0]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], total[ends]


def per_text(ufunc, values: np.ndarray, at: np.ndarray, empty=0) -> np.ndarray:
    """``ufunc`` reduced over each range of ``values``; ``empty`` where a range is empty."""
    out = np.full(len(at) - 1, empty, dtype=values.dtype)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = ufunc.reduceat(values, at[:-1][full])
    return out


def list_column(flat: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))
