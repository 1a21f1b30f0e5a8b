"""Best-fit packing of tokenised documents into sequences (operator 9).

Documents are tokenised where they lie; only longer ones are cut. Which lengths share a
sequence is decided on the histogram of lengths, which has at most one count per length, so
the plan is as small for 100 TB as for one table:

1. Martello-Toth reduction. A piece that nothing fits beside is fixed alone; any other is fixed
   with the longest piece that fits, if no set of free pieces that fits holds more tokens (sums of
   any number of pieces are looked at, as bits of one number). Such a set dominates all others,
   so it is fixed, for as many sequences as the counts allow at once. Lengths not decided stay free
   and count in later comparisons; rounds go on while they fix something.
2. Best-fit decreasing on what is left: each piece goes where the least room remains.

Every piece then gets a running number within its length, by counts per part and a prefix sum
over the parts, and looks its sequence and offset up in the plan.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm import common
from tradewind.llm.common import discard, stage

CAPACITY = 2048
# Distinct chunks of text whose ids a Python worker keeps at most; longer ones are not kept.
KEPT_CHUNKS, KEPT_BYTES = 1_500_000, 64
# Text that is encoded in one call.
JOINED_BYTES = 1 << 14
# Pieces of one length that one part numbers by itself.
NUMBERED = 20_000

# A chunk may start at a space that is followed by one of these bytes: no blank, and no first
# byte of a blank outside ASCII. The tokenizer's own words never cross such a place.
_OPEN = np.ones(256, dtype=bool)
_OPEN[:33] = False
_OPEN[[0xC2, 0xE1, 0xE2, 0xE3]] = False


class Encoder:
    """Token ids of whole texts, chunk by chunk, each distinct short chunk encoded once."""

    def __init__(self, path: str):
        # Spark's tasks share the cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A byte-level token has one letter for each byte it stands for.
        names = (self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size()))
        self.sizes = np.array([len(name) for name in names], dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        # Chunks by rising hash, and the range of each in ``ids``, which only grows at its end.
        self.hashes = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _separately(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([r.decode() for r in raw], add_special_tokens=False)]
        at = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
        return np.array([i for f in found for i in f], dtype=np.uint32), at

    def _encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some chunks and their ranges.

        Chunks that open with a space are encoded as one text and told apart by the bytes their
        ids stand for: no word of the tokenizer crosses from one into the next.
        """
        spaced = np.array([r[:1] == b" " and len(r) > 1 and _OPEN[r[1]] for r in raw], dtype=bool)
        joined = [r for r, s in zip(raw, spaced) if s]
        edges = np.concatenate([[0], np.cumsum([len(r) for r in joined])]).astype(np.int64)
        texts, lo = [], 0
        while lo < len(joined):
            hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + JOINED_BYTES, side="right")) - 1)
            texts.append(b"".join(joined[lo:hi]))
            lo = hi
        together, _ = self._separately(texts)
        reach = np.concatenate([[0], np.cumsum(self.sizes[together])])
        cuts = np.searchsorted(reach, edges)
        if not (reach[cuts] == edges).all():
            return self._separately(raw)
        alone, alone_at = self._separately([r for r, s in zip(raw, spaced) if not s])
        size = np.zeros(len(raw), np.int64)
        start = np.zeros(len(raw), np.int64)
        size[spaced], start[spaced] = np.diff(cuts), cuts[:-1]
        size[~spaced], start[~spaced] = np.diff(alone_at), alone_at[:-1] + len(together)
        pool = np.concatenate([together, alone])
        return pool[ranges(start, size)], np.concatenate([[0], np.cumsum(size)])

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        """Keep new chunks, whose hashes rise."""
        ids, at = self._encode(raw)
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.begin = np.insert(self.begin, place, at[:-1] + len(self.ids))
        self.count = np.insert(self.count, place, np.diff(at))
        self.ids = np.concatenate([self.ids, ids])

    def __call__(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in ``data`` and their ranges."""
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[:-2] = (data[:-1] == 32) & _OPEN[data[1:]] if len(data) > 1 else False
        cut[at] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        text_at = np.searchsorted(starts, at)
        hashes = common.span_hash(common.prefix_hash(data, common.EXACT), starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        whole = data.tobytes()
        raw = [whole[starts[first[k]] : ends[first[k]]] for k in new.tolist()]
        short = np.array([len(r) <= KEPT_BYTES for r in raw], dtype=bool)
        if len(self.hashes) + len(new) > KEPT_CHUNKS:
            self.clear()
            new, raw = np.arange(len(distinct)), [whole[starts[k] : ends[k]] for k in first.tolist()]
            short = np.array([len(r) <= KEPT_BYTES for r in raw], dtype=bool)
        if short.any():
            self._learn(distinct[new[short]], [r for r, s in zip(raw, short) if s])
        long_ids, long_at = self._encode([r for r, s in zip(raw, short) if not s])
        pool = np.concatenate([self.ids, long_ids])
        begin = np.zeros(len(distinct), np.int64)
        size = np.zeros(len(distinct), np.int64)
        place = np.searchsorted(self.hashes, distinct)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == distinct[known]
        begin[known] = self.begin[place[known]]
        size[known] = self.count[place[known]]
        rest = new[~short]
        begin[rest] = long_at[:-1] + len(self.ids)
        size[rest] = np.diff(long_at)
        total = np.concatenate([[0], np.cumsum(size[back])])
        return pool[ranges(begin[back], size[back])], total[text_at]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes of ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of this Python process: Spark's workers go from task to task with what they know."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for part in common.slices(batch, "text"):
                ids, at = encoder(*common.text_bytes(part.column("text")))
                docs, piece, start, length, crc = [], [], [], [], []
                ids = ids.astype("<u4")
                for doc, s, e in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    n = e - s + 1
                    whole = ids[s:e].tobytes() + b"\0\0\0\0"
                    lo, hi = 0, (n % capacity or capacity)
                    k = 0
                    while lo < n:
                        docs.append(doc)
                        piece.append(k)
                        start.append(lo)
                        length.append(hi - lo)
                        crc.append(zlib.crc32(whole[4 * lo : 4 * hi]))
                        lo, hi, k = hi, hi + capacity, k + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: the ids of the text, then id 0; a longer document
    is cut into full pieces, of which the first may be shorter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path or tokenizer_path(), capacity), _PIECES
    )


def reduce_and_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths that share a sequence, number of such sequences) for a histogram of lengths.

    From the longest length down, a piece is fixed with the longest piece that fits beside it if
    no set of free pieces that fits there holds more tokens: in any packing the pieces beside it
    can then change places with that one, so an optimum keeps the set. A piece that nothing
    fits beside is fixed alone. Lengths that cannot be fixed stay free and count in all later
    comparisons. Rounds go on while they fix something, since fewer free pieces allow
    more; the rest is packed by best fit.
    """
    left = {w: n for w, n in counts.items() if n}
    plan: list[tuple[tuple[int, ...], int]] = []
    fixed = True
    while fixed and left:
        fixed = False
        sizes = sorted(left)
        for top in reversed(sizes.copy()):
            while top in left:
                lengths, n = _dominating(sizes, left, top, capacity - top)
                if not n:
                    break
                plan.append((lengths, n))
                fixed = True
                for w in lengths:
                    left[w] -= n
                    if not left[w]:
                        del left[w]
                        sizes.pop(bisect_left(sizes, w))
    return plan + _best_fit(list(left.items()), capacity)


def _dominating(sizes: list[int], left: dict[int, int], top: int, room: int) -> tuple[tuple[int, ...], int]:
    """The set with one piece of length ``top`` that dominates all others, and how many such sets
    can be fixed at once; none if no set does."""
    k = bisect_left(sizes, room + 1) - 1
    if k >= 0 and sizes[k] == top and left[top] == 1:
        k -= 1
    if k < 0:
        return (top,), 1 if top <= room else left[top]
    mate = sizes[k]
    if mate < room and _holds_more(sizes[: k + 1], left, top, mate, room):
        return (), 0
    return (top, mate), left[top] // 2 if mate == top else min(left[top], left[mate])


def _holds_more(sizes: list[int], left: dict[int, int], top: int, mate: int, room: int) -> bool:
    """Whether some free pieces, besides one of length ``top``, have a sum above ``mate`` within ``room``.

    Bit ``s`` of ``sums`` tells that pieces with the sum ``s`` exist.
    """
    sums, within, above = 1, (1 << room + 1) - 1, room - mate
    for w in sizes:
        n = min(left[w] - (w == top), room // w)
        step = 1
        while n > 0:
            take = min(step, n)
            sums |= sums << take * w & within
            n -= take
            step *= 2
        if sums >> mate + 1 and above:
            return True
    return False


def _best_fit(items: list[tuple[int, int]], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over (length, count), longest first; equal sequences stay together."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def add(room: int, held: tuple[int, ...], n: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((held, n))

    for w, n in sorted(items, reverse=True):
        while n:
            k = bisect_left(rooms, w)
            if k == len(rooms):
                # New sequences, as full of this length as they get.
                fit = capacity // w
                if n >= fit:
                    add(capacity - fit * w, (w,) * fit, n // fit)
                    n %= fit
                else:
                    add(capacity - n * w, (w,) * n, 1)
                    n = 0
                continue
            room = rooms[k]
            held, m = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(k)
            used = min(n, m)
            if m > used:
                add(room, held, m - used)
            add(room - w, (*held, w), used)
            n -= used
    return [x for groups in open_by_room.values() for x in groups]


def placement(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per slot of the plan, sorted by (length, first number): where its pieces go."""
    rows, used, base = [], {}, 0
    for lengths, n in plan:
        offset = 0
        for w in lengths:
            first = used.get(w, 0)
            rows.append((w, first, base, offset))
            used[w] = first + n
            offset += w
        base += n
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "first": table[:, 1], "base": table[:, 2], "offset": table[:, 3]}


def _place(slots: dict[str, np.ndarray]):
    key = slots["length"] << np.int64(44) | slots["first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("number").to_numpy(zero_copy_only=False)
            slot = np.searchsorted(key, length << np.int64(44) | number, side="right") - 1
            sequence = slots["base"][slot] + number - slots["first"][slot]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(slots["offset"][slot])],
                [*names, "sequence_id", "offset"],
            )

    return run


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with a running ``number`` from 0 within each length.

    A length held by many pieces is split into parts by a hash, so no task numbers more than
    about ``NUMBERED`` of them; the parts' counts are summed up before.
    """
    totals = pieces.groupBy("length").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / NUMBERED)
    split = pieces.join(F.broadcast(totals), "length").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece"), parts)
    ).drop("n")
    counts = split.groupBy("length", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    return (
        split.withColumn("rank", F.row_number().over(own) - 1)
        .join(before, ["length", "part"])
        .withColumn("number", F.col("rank") + F.col("before"))
    )


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``.

    Null and empty texts have the one id 0. Rows that repeat an id, or have none, are packed like
    all others. The histogram that the plan is made from has at most ``capacity`` rows.
    """
    pieces = stage(token_pieces(docs, path, capacity))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = placement(reduce_and_fit(counts, capacity))
    out = stage(numbered(pieces).mapInArrow(_place(slots), f"{_PIECES}, sequence_id long, offset long"))
    discard(pieces)
    return out
