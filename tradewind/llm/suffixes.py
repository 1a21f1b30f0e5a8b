"""Removal of byte strings that occur more than once, by a sparse suffix array (operator 6).

A sorted array of all suffixes is more than the text itself can pay for, so only suffixes that
start at anchors are sorted. An anchor is the place of the least hash among the first
``length - GRAM + 1`` grams of ``GRAM`` bytes of some ``length``-byte window; equal windows have
their anchor at the same offset, so nothing that repeats can be missed.

1. Every anchor's gram is hashed and counted, within its text first. Grams seen once are done with.
2. Documents with repeated grams are read again. The suffixes at those anchors are sorted per
   batch into runs, front-coded (common prefix with the one before, and the rest), and
   exchanged by ranges of their first bytes.
3. Each range merges its runs with a loser tree. The tree keeps, for every run's head, its
   common prefix with the last suffix that was put out; heads are compared from there on, so
   no known prefix is looked at twice.
4. Neighbours that share a gram form a group. Windows of a group's members are compared by
   content; those that come twice give the spans.

Grams that come more than ``HOT`` times would fill one task. Their windows are hashed and first
compared within a slice of texts: those that come twice there are spans at once, and are sent
on once, for other slices to find. All others go through a grouped count. No task holds a group.

A row without doc_id takes no part: nothing is removed from it and it is no one's partner.
Null texts count as empty. Rows that repeat an id and text are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import common
from tradewind.llm.common import discard, stage

HOT = 4096
# A gram with more than one in SALTED of all anchors is dealt over SALTS tasks.
SALTED = 1000
SALTS = 64
# Text bytes a range of suffixes should hold, and documents sampled for the range limits.
RANGE_BYTES = 8 << 20
SAMPLE = 2000
# Window starts whose anchors are looked for at a time: some 65 bytes of arrays for each.
BLOCK_BYTES = 1 << 21


def _gram(length: int) -> int:
    return length * 54 // 100


def _anchors(data: np.ndarray, at: np.ndarray, length: int):
    """(hash, text index, anchor, first and last window start) of every anchor; places in ``data``.

    A text of more than ``BLOCK_BYTES`` is taken in blocks of window starts; an anchor whose windows
    lie in two blocks is given twice, each time with the windows of the block.
    """
    if len(data) <= BLOCK_BYTES + length:
        return _block_anchors(data, at, length)
    found = []
    for text, (s, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        for lo in range(s, max(e - length, s) + 1, BLOCK_BYTES):
            hi = min(lo + BLOCK_BYTES + length - 1, e)
            hashes, owner, *places = _block_anchors(data[lo:hi], np.array([0, hi - lo]), length)
            found.append((hashes, owner + text, *(p + lo for p in places)))
    return tuple(np.concatenate(column) for column in zip(*found))


def _block_anchors(data: np.ndarray, at: np.ndarray, length: int):
    gram = _gram(length)
    reach = length - gram + 1
    sizes = np.diff(at)
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    prefix = common.prefix_hash(data, common.EXACT)
    grams = np.arange(len(data) - gram + 1)
    hashes = common.span_hash(prefix, grams, grams + gram)
    # The hash above, the place below: a minimum tells where it is, the leftmost on ties.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)
    covered = 1
    while covered < reach:
        step = min(covered, reach - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    ends = np.cumsum(windows)
    total = int(ends[-1])
    starts = np.arange(total) + np.repeat(at[:-1] - (ends - windows), windows)
    text = np.repeat(np.arange(len(sizes)), windows)
    place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(total, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    anchor = place[first]
    return hashes[anchor], text[first], anchor, starts[first], starts[last]


def _keys(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                data, at = common.text_bytes(part.column("text"))
                hashes, text, *_ = _anchors(data, at, length)
                # Text of short period has one gram over and over: a row tells how often.
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                rows = pa.array(text[first])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(rows),
                        part.column("version").take(rows),
                        pa.array(hashes[first].view(np.int64)),
                        pa.array(np.diff(np.append(first, len(text))), pa.int64()),
                    ],
                    ["doc_id", "version", "gram", "times"],
                )

    return run


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    lo, hi = known, min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


_RUN = (
    "part int, run long, shared array<int>, rest array<binary>, before array<binary>,"
    " doc_id array<long>, version array<long>, anchor array<int>"
)


def _prefix(key: bytes) -> int:
    return int.from_bytes(key[:7], "big")


def _entries(part: pa.RecordBatch, length: int):
    """Suffixes at the repeated anchors of a slice: (key, before, row, anchor in its text)."""
    data, at = common.text_bytes(part.column("text"))
    hashes, text, anchor, first, last = _anchors(data, at, length)
    wanted = part.column("grams")
    flat = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    owner = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
    ask = common.mix(hashes + text.astype(np.uint64) * np.uint64(common._Q))
    have = common.mix(flat + owner.astype(np.uint64) * np.uint64(common._Q))
    hit = np.flatnonzero(np.isin(ask, have))
    raw = data.tobytes()
    return [
        (raw[p : hi + length], raw[lo:p], t, p - s)
        for p, lo, hi, t, s in zip(
            anchor[hit].tolist(), first[hit].tolist(), last[hit].tolist(), text[hit].tolist(), at[text[hit]].tolist()
        )
    ]


def _runs(length: int, limits: list[int]):
    """Sorted, front-coded runs, one row for each range of first bytes."""
    cuts = np.array(limits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                found = sorted(_entries(part, length))
                if not found:
                    continue
                ids, versions = part.column("doc_id").to_pylist(), part.column("version").to_pylist()
                ranges = np.searchsorted(cuts, np.array([_prefix(e[0]) for e in found]), side="right")
                edges = np.flatnonzero(np.diff(ranges)) + 1
                rows = []
                for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(found)]):
                    shared, rest, prior = [], [], b""
                    for key, *_ in found[s:e]:
                        n = _common(prior, key, 0)
                        shared.append(n)
                        rest.append(key[n:])
                        prior = key
                    rows.append(
                        (
                            int(ranges[s]), (ids[found[s][2]] or 0) * 131 + found[s][3], shared, rest,
                            [x[1] for x in found[s:e]], [ids[x[2]] for x in found[s:e]],
                            [versions[x[2]] for x in found[s:e]], [x[3] for x in found[s:e]],
                        )
                    )
                names = ["part", "run", "shared", "rest", "before", "doc_id", "version", "anchor"]
                kinds = [
                    pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()),
                    pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names
                )

    return run


class Run:
    """A front-coded run that is read from its start; ``known`` is the head's common prefix
    with the last suffix put out."""

    def __init__(self, row: dict):
        self.row, self.i, self.key, self.known = row, -1, b"", 0
        self.advance()

    def advance(self) -> None:
        self.i += 1
        if self.i == len(self.row["rest"]):
            self.key = None
            return
        n = self.row["shared"][self.i]
        self.key = self.key[:n] + self.row["rest"][self.i]
        self.known = n

    def item(self) -> tuple:
        r, i = self.row, self.i
        return self.key, r["before"][i], r["doc_id"][i], r["version"][i], r["anchor"][i]


def _beats(a: Run, b: Run) -> bool:
    """Whether a's head comes first; sets the loser's known prefix, then with a's head."""
    if a.key is None or b.key is None:
        return b.key is None
    if a.known != b.known:
        return a.known > b.known
    n = _common(a.key, b.key, a.known)
    first = a.key[n : n + 1] <= b.key[n : n + 1]
    (b if first else a).known = n
    return first


def merged(runs: list[Run]) -> Iterator[tuple[int, tuple]]:
    """(common prefix with the one before, item) in order, by a tree of losers."""
    size = len(runs)
    tree = [0] * size
    winner = [0] * (2 * size)
    winner[size:] = range(size)
    for node in range(size - 1, 0, -1):
        x, y = winner[2 * node], winner[2 * node + 1]
        first = _beats(runs[x], runs[y])
        winner[node], tree[node] = (x, y) if first else (y, x)
    top = winner[1] if size > 1 else 0
    while runs[top].key is not None:
        yield runs[top].known, runs[top].item()
        runs[top].advance()
        node = (top + size) // 2
        while node:
            if not _beats(runs[top], runs[tree[node]]):
                top, tree[node] = tree[node], top
            node //= 2


def _windows(items: list[tuple], length: int):
    """Content hashes of all windows of some items, and the range per item."""
    data = np.frombuffer(b"".join(before + key for key, before, *_ in items), dtype=np.uint8)
    size = np.array([len(before) + len(key) for key, before, *_ in items])
    count = size - length + 1
    ends = np.cumsum(count)
    starts = np.arange(ends[-1]) + np.repeat(np.cumsum(size) - size - (ends - count), count)
    hashes = common.span_hash(common.prefix_hash(data, common.EXACT), starts, starts + length)
    return hashes, np.concatenate([[0], ends])


def _spans(items: list[tuple], twice: np.ndarray, at: np.ndarray, length: int):
    """Rows (doc_id, version, start, end) where consecutive windows come twice."""
    edge = np.diff(np.concatenate([[0], twice.astype(np.int8), [0]]))
    item = np.repeat(np.arange(len(items)), np.diff(at))
    # A run of windows may not pass from one item to the next.
    border = np.zeros(len(twice) + 1, dtype=bool)
    border[at] = True
    start = np.flatnonzero((edge[:-1] == 1) | (twice & border[:-1]))
    stop = np.flatnonzero((edge[1:] == -1) | (twice & border[1:]))
    for s, e in zip(start.tolist(), stop.tolist()):
        key, before, doc, version, anchor = items[item[s]]
        origin = anchor - len(before) - int(at[item[s]])
        yield doc, version, origin + s, origin + e + length


_SPAN = "doc_id long, version long, start int, end int"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    columns = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["doc_id", "version", "start", "end"]
    )


def _merge(length: int):
    gram = _gram(length)

    def resolve(items: list[tuple]) -> pa.RecordBatch:
        hashes, at = _windows(items, length)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        twice = np.zeros(len(hashes), dtype=bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        return _span_batch(list(_spans(items, twice, at, length)))

    def one(runs: list[Run]) -> Iterator[pa.RecordBatch]:
        ready, size, group = [], 0, []
        for shared, item in merged(runs):
            if shared < gram:
                if len(group) > 1:
                    ready += group
                    size += sum(len(x[0]) + len(x[1]) for x in group)
                    if size > common.SLICE_BYTES:
                        yield resolve(ready)
                        ready, size = [], 0
                group = []
            group.append(item)
        if len(group) > 1:
            ready += group
        if ready:
            yield resolve(ready)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if runs and row["part"] != part:
                    yield from one(runs)
                    runs = []
                part = row["part"]
                runs.append(Run(row))
        if runs:
            yield from one(runs)

    return run


_HOT = "doc_id long, version long, window long, start int, end int"


def _hot_windows(length: int):
    """Windows at hot grams, by three kinds of rows. Without ``window``: a span of windows that come
    twice in the slice. Without ``doc_id``: a window that comes twice there, given once, for others
    to find. With both: a window that comes once in the slice and asks whether others hold it."""

    def rows(doc, version, window, start, end) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(version, pa.int64()), pa.array(window, pa.int64()),
             pa.array(start, pa.int32()), pa.array(end, pa.int32())],
            ["doc_id", "version", "window", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                found = _entries(part, length)
                if not found:
                    continue
                text = pa.array([x[2] for x in found])
                ids, versions = part.column("doc_id").take(text), part.column("version").take(text)
                items = [
                    (key, before, doc, version, anchor)
                    for (key, before, _, anchor), doc, version in zip(found, ids.to_pylist(), versions.to_pylist())
                ]
                hashes, at = _windows(items, length)
                _, back, n = np.unique(hashes, return_inverse=True, return_counts=True)
                twice = n[back] > 1
                # Text of short period has anchors close together; their spans are one.
                near: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for doc, version, start, end in _spans(items, twice, at, length):
                    near.setdefault((doc, version), []).append((start, end))
                spans = [(*key, *span) for key, some in near.items() for span in _joined(*zip(*some))]
                if spans:
                    doc, version, start, end = zip(*spans)
                    yield rows(doc, version, [None] * len(spans), start, end)
                known = np.unique(hashes[twice]).view(np.int64)
                if len(known):
                    none = [None] * len(known)
                    yield rows(none, none, known, none, none)
                item = np.repeat(np.arange(len(items)), np.diff(at))
                origin = np.array([x[4] - len(x[1]) for x in items]) - at[:-1]
                once = np.flatnonzero(~twice)
                if len(once):
                    mine = pa.array(item[once])
                    start = once + origin[item[once]]
                    yield rows(ids.take(mine), versions.take(mine), hashes[once].view(np.int64), start, start + length)

    return run


def _limits(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_prefix(e[0]) for e in _entries(part, length)], pa.int64())], ["first"]
                )

    return run


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, version (hash of the text) and text of every row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def repeated_spans(docs: DataFrame, length: int = 400) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spans of bytes covered by ``length``-byte strings that also start elsewhere.

    Returns ``base`` (doc_id, version, sha, n_bytes, n_copies: rows of this very text) with a
    row per row of ``docs``, ``spans`` (doc_id, version, start, end; overlaps possible) of one
    document per text, and ``texts`` (doc_id, version, text) of the documents with spans. Texts
    with several copies count once in ``spans``; from ``length`` bytes on they are repeated whole.
    """
    whole = _identified(docs)
    base = stage(
        whole.select(
            "doc_id", "version", F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        )
    )
    named = base.where("doc_id IS NOT NULL")
    classes = named.groupBy("sha").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first"))
    counted = stage(
        base.join(classes, "sha", "left").select(
            "doc_id", "version", "sha", "n_bytes",
            F.when(F.col("doc_id").isNotNull(), F.col("n_copies")).otherwise(1).alias("n_copies"),
            (F.col("doc_id") == F.col("first")).alias("is_first"),
        )
    )
    long = F.octet_length("text") >= length
    keys = stage(whole.where(long & F.col("doc_id").isNotNull()).mapInArrow(
        _keys(length), "doc_id long, version long, gram long, times long"))
    other = counted.where("NOT is_first").select("doc_id", "version").distinct()
    single = keys.join(other, ["doc_id", "version"], "left_anti")
    grams = stage(single.groupBy("gram").agg(F.sum("times").alias("n"), F.count("*").alias("holders")).where("n > 1"))
    # A gram with a large share of all rows is dealt over SALTS keys. There are at most SALTED of them.
    share = keys.count() / SALTED
    salted = F.broadcast(grams.where(F.col("holders") > share).select("gram", F.lit(SALTS).alias("salts")))
    salts = F.when(F.col("holders") > share, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = single.join(salted, "gram", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "version"), F.col("salts")), F.lit(0)).cast("int")
    ).drop("salts")
    repeated = stage(dealt.join(grams.withColumn("salt", F.explode(salts)), ["gram", "salt"]).drop("salt"))
    cold = F.collect_set(F.when(F.col("n") <= HOT, F.col("gram")))
    hot = F.collect_set(F.when(F.col("n") > HOT, F.col("gram")))
    marked = repeated.groupBy("doc_id", "version").agg(cold.alias("cold"), hot.alias("hot"))
    texts = stage(whole.where(long).join(marked, ["doc_id", "version"]).dropDuplicates(["doc_id", "version"]), "zstd")

    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(1, int((size[0] or 0) * 2 // RANGE_BYTES))
    columns = ["doc_id", "version", "text"]
    ordered = texts.where("size(cold) > 0").select(*columns, F.col("cold").alias("grams"))
    limits = (
        ordered.sample(min(1.0, SAMPLE / max(size[1], 1)), seed=1)
        .mapInArrow(_limits(length), "first long")
        .agg(F.percentile_approx("first", [k / parts for k in range(1, parts)], 10000)).first()[0]
        if parts > 1 else None
    )
    runs = ordered.mapInArrow(_runs(length, sorted(limits or [])), _RUN)
    spans = (
        runs.repartition(parts, "part").sortWithinPartitions("part", "run").mapInArrow(_merge(length), _SPAN)
    )
    windows = stage(
        texts.where("size(hot) > 0").select(*columns, F.col("hot").alias("grams"))
        .mapInArrow(_hot_windows(length), _HOT)
    )
    twice = (
        windows.where("window IS NOT NULL").groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    )
    edges = ["doc_id", "version", "start", "end"]
    met = windows.where("doc_id IS NOT NULL").join(twice, "window").select(*edges)
    near = windows.where("window IS NULL").select(*edges)
    found = stage(spans.unionByName(near).unionByName(met))
    kept_texts = texts.select(*columns)
    kept_texts.staged_path = texts.staged_path
    discard(base, keys, grams, repeated, windows)
    return counted, found, kept_texts


def _joined(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans, touching ones joined."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_CUT = "doc_id long, version long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, version, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                raw, kept, at = text.encode(), [], 0
                joined = _joined([s["start"] for s in spans], [s["end"] for s in spans])
                for s, e in joined:
                    kept.append(raw[at:s])
                    at = e
                left = b"".join([*kept, raw[at:]])
                rows.append(
                    (
                        doc, version, len(raw) - len(left), len(joined), hashlib.sha256(left).hexdigest(),
                        left.decode("utf-8", "ignore") if with_text else None,
                    )
                )
            names = ["doc_id", "version", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names
            )

    return run


def _cuts(spans: DataFrame, texts: DataFrame, with_text: bool) -> DataFrame:
    gathered = spans.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return texts.join(gathered, ["doc_id", "version"]).select("doc_id", "version", "text", "spans").mapInArrow(
        _cut(with_text), _CUT
    )


def repeat_digest(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs``.

    Every byte covered by a ``length``-byte string that also starts elsewhere in any document
    goes, all its occurrences alike; kept_sha256 is of the bytes that stay.
    """
    base, spans, texts = repeated_spans(docs, length)
    cut = _cuts(spans, texts, False).drop("kept")
    copied = (F.col("n_copies") > 1) & (F.col("n_bytes") >= length)
    out = stage(
        base.join(cut, ["doc_id", "version"], "left").select(
            "doc_id", "n_bytes",
            F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        )
    )
    discard(base, spans, texts)
    return out


def without_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` and ``n_chars``, if there, set anew.

    No row goes; a text that was repeated whole is empty. A character of which some bytes
    went goes whole.
    """
    base, spans, texts = repeated_spans(docs, length)
    cut = _cuts(spans, texts, True).select("doc_id", "version", "kept")
    copied = (F.col("n_copies") > 1) & (F.col("n_bytes") >= length)
    changed = stage(
        base.join(cut, ["doc_id", "version"], "left").where(copied | F.col("kept").isNotNull())
        .select(
            F.col("doc_id").alias("__id"), F.col("version").alias("__version"),
            F.when(copied, F.lit("")).otherwise(F.col("kept")).alias("__kept"),
        ).distinct(),
        "zstd",
    )
    mine = (F.col("doc_id") == F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__version"))
    text = F.coalesce("__kept", "text")
    new = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("__kept").isNotNull(), F.char_length("__kept").cast(kind)).otherwise(F.col("n_chars"))
    out = docs.join(changed, mine, "left").select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])
    discard(base, spans, texts)
    return out
