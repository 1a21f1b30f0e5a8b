"""Conversations brought to the order system, user, assistant at the least cost (operator 13).

Every turn may be kept, given the other role (rerole), or deleted, and empty turns may be
inserted, so that the initials of the roles read ``(s?(ua)+)?``. The cheapest edits follow from
a dynamic program over the turns with four states: nothing yet, after s, after u, after a.

1. Backwards, the vector of the least costs to the end is carried from turn to turn, but stored
   only at every ``sqrt(n)``-th turn.
2. Forwards, the vectors between two stored ones are computed again, and the edit whose letter is
   least in ASCII (D, I, K, R) among those that keep the cost is taken. After equal letters the
   state is the same, so this gives the least string of all cheapest ones. Memory is some
   ``2 sqrt(n)`` vectors.

A conversation of more than ``segment`` turns is not handled by one task. Its turns are numbered by
a distributed sort, and cut into segments of ``segment`` or ``sqrt(n)`` turns, whichever is more. Each
segment is reduced to a matrix of the costs between its border states; the border vectors are the
stored ones, and the walk through a segment is the recomputed block. Per conversation only
the borders, at most ``sqrt(n)`` or ``segment`` of them, pass one task, one after another.

Defined results. Rows of one conversation are taken by turn (nulls first), then by role and by
the hash of the text; equal rows are interchangeable. A null conv_id is one conversation. Nulls in
role and text, and in the text that is hashed for the damage, count as one space. A role whose first
letter is none of s, u, a, an empty role too, can be reroled or deleted only. An empty table gives no
rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stage

# Turns that one task may take of one conversation.
SEGMENT = 4096
# What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Borders of words, and what ends a sentence.
BLANKS, STOPS = " \t\n\x0b\x0c\r", ".!?"

_NEVER = 1 << 50
_INITIALS = "sua"
_SOUND, _MUST_GO, _CUT = 0, 1, 2
# State after an inserted turn, and the role it gets: an assistant follows u, else a user.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")


def _steps(code: int) -> list[list[tuple[str, int, int]]]:
    """Per state the (letter, cost, next state) that take a turn, letters in ASCII order."""
    initial, fault = code % 4, code // 4
    extra = TRUNCATED if fault == _CUT else 0
    out = []
    for state in range(4):
        ways = [("D", DELETE, state)]
        if fault != _MUST_GO:
            if initial == 0 and state == 0:
                ways.append(("K", extra, 1))
            if initial in (1, 2) and _NEXT[state] == initial + 1:
                ways.append(("K", extra, initial + 1))
            ways.append(("R", REROLE + extra, _NEXT[state]))
        out.append(ways)
    return out


# A code holds the initial (0 s, 1 u, 2 a, 3 other) and, times four, the fault.
_STEPS = [_steps(code) for code in range(12)]


def _with_inserts(v: list[int]) -> list[int]:
    out = []
    for state in range(4):
        once = _NEXT[state]
        out.append(min(v[state], INSERT + v[once], 2 * INSERT + v[_NEXT[once]], _NEVER))
    return out


END = _with_inserts([0, _NEVER, _NEVER, 0])


def _before(code: int, after: list[int]) -> list[int]:
    return _with_inserts([min(cost + after[to] for _, cost, to in ways) for ways in _STEPS[code]])


def checkpoints(codes: list[int], end: list[int]) -> tuple[int, dict[int, list[int]]]:
    """The step, and the cost vectors before every step-th turn and at the end."""
    step = max(1, isqrt(len(codes)))
    v, kept = end, {len(codes): end}
    for i in range(len(codes) - 1, -1, -1):
        v = _before(codes[i], v)
        if i % step == 0:
            kept[i] = v
    kept.setdefault(0, v)
    return step, kept


def walk(codes: list[int], end: list[int], state: int = 0, last: bool = True) -> tuple[str, int, int]:
    """Least cheapest letters from ``state`` on, the state they lead to, and the cost to the end.

    ``end`` is the vector behind the turns; inserts there are made by the ``last`` segment only.
    """
    step, kept = checkpoints(codes, end)
    audit, cost = [], kept[0][state]
    for lo in range(0, len(codes), step):
        hi = min(lo + step, len(codes))
        block = [kept[hi]]
        for i in range(hi - 1, lo - 1, -1):
            block.append(_before(codes[i], block[-1]))
        block.reverse()
        for i in range(lo, hi):
            here, after = block[i - lo], block[i - lo + 1]
            taken = False
            while not taken:
                for letter, price, to in _STEPS[codes[i]][state]:
                    if letter > "I" and INSERT + here[_NEXT[state]] == here[state]:
                        break
                    if price + after[to] == here[state]:
                        audit.append(letter)
                        state, taken = to, True
                        break
                if not taken:
                    audit.append("I")
                    state = _NEXT[state]
    while last and end[state]:
        audit.append("I")
        state = _NEXT[state]
    return "".join(audit), state, cost


def edited(audit: str, state: int, roles: list[str], texts: list[str]) -> list[dict]:
    """The edits as (edit, role, text); a deleted turn is shown as it was."""
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            out.append({"edit": letter, "role": _ROLE[state], "text": ""})
            state = _NEXT[state]
            continue
        role = roles[i]
        if letter == "R":
            role, state = _ROLE[state], _NEXT[state]
        elif letter == "K":
            state = _INITIALS.index(role[0]) + 1
        out.append({"edit": letter, "role": role, "text": texts[i]})
        i += 1
    return out


def _code(role: str, fault: int) -> int:
    initial = _INITIALS.find(role[:1]) if role else 3
    return (initial if initial >= 0 else 3) + 4 * fault


def _illegal(a: int, b: int) -> bool:
    """Whether turns with these codes may not follow each other."""
    return (a % 4, b % 4) not in ((0, 1), (1, 2), (2, 1))


_EDITS = "edits array<struct<edit: string, role: string, text: string>>"
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_EDIT = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _tables(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 1 << 20):
    """Record batches of about ``size`` letters, or 1,000 rows."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        for x in row:
            if isinstance(x, str):
                weight += len(x)
            elif isinstance(x, list) and x and isinstance(x[0], dict):
                weight += sum(len(e["text"]) + len(e["role"]) + 1 for e in x)
        if weight > size or len(held) == 1000:
            yield _table(held, names, kinds)
            held, weight = [], 0
    if held:
        yield _table(held, names, kinds)


def _table(held: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], names)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that come as one run of sorted rows."""

    def one(conv, turns) -> tuple:
        codes, roles, texts, numbers, seen = [], [], [], set(), set()
        counts = [0, 0, 0, 0]
        for _, gone, turn, role, text, fault in turns:
            if gone:
                continue
            if turn is not None:
                numbers.add(turn)
            if fault == _MUST_GO:
                counts[0] += 1
            elif (role, text) in seen:
                fault = _MUST_GO
                counts[1] += 1
            elif fault == _CUT:
                counts[2] += 1
            seen.add((role, text))
            codes.append(_code(role, fault))
            roles.append(role)
            texts.append(text)
        counts[3] = sum(map(_illegal, codes, codes[1:]))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        audit, _, cost = walk(codes, END)
        return conv, gaps, *counts, cost, edited(audit, 0, roles, texts)

    names = ["conv_id", "gaps", *_COUNTS, "cost", "edits"]
    done = (one(conv, turns) for conv, turns in groupby(_rows(batches), key=lambda r: r[0]))
    yield from _tables(done, names, [pa.int64()] * 7 + [_EDIT])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the place among the partition's rows of the conversation."""
    part, conv, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = []
        for c in batch.column("conv_id").to_pylist():
            at = at + 1 if places and c == conv or not places and at and c == conv else 1
            conv = c
            places.append(at)
        yield batch.append_column("part", pa.array([part] * len(places), pa.int64())).append_column(
            "at", pa.array(places, pa.int64())
        )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs between the border states of each segment, its faults, its first and last turn."""

    def one(key, turns) -> tuple:
        codes, counts = [], [0, 0, 0]
        for *_, code, count in turns:
            codes.append(code)
            if count:
                counts[count - 1] += 1
        costs = []
        for to in range(4):
            v = [_NEVER] * 4
            v[to] = 0
            for code in reversed(codes):
                v = _before(code, v)
            costs += v
        return *key, costs, *counts, sum(map(_illegal, codes, codes[1:])), codes[0], codes[-1]

    names = ["conv_id", "seg", "costs", *_COUNTS, "first", "last"]
    done = (one(key, turns) for key, turns in groupby(_rows(batches), key=lambda r: r[:2]))
    yield from _tables(done, names, [pa.int64()] * 2 + [pa.list_(pa.int64())] + [pa.int64()] * 6)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last segment to the first: the vector behind each, and the cost before it."""

    def all_of(rows) -> Iterator[tuple]:
        for _, segments in groupby(rows, key=lambda r: r[0]):
            after, following = END, None
            for conv, seg, costs, *counts, first, last in segments:
                counts[3] += following is not None and _illegal(last, following)
                before = [min(costs[4 * to + q] + after[to] for to in range(4)) for q in range(4)]
                yield conv, seg, after, following is None, *counts, before[0]
                after, following = before, first

    names = ["conv_id", "seg", "after", "is_last", *_COUNTS, "cost"]
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int64()), pa.bool_()] + [pa.int64()] * 5
    yield from _tables(all_of(_rows(batches)), names, kinds)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state a segment may be entered in, the state it is left in."""

    def one(key, turns) -> tuple:
        *_, after, is_last = next(turns)
        codes = [t[3] for t in turns]
        return *key, [walk(codes, after, state, is_last)[1] for state in range(4)]

    done = (one(key, turns) for key, turns in groupby(_rows(batches), key=lambda r: r[:2]))
    yield from _tables(done, ["conv_id", "seg", "exits"], [pa.int64(), pa.int64(), pa.list_(pa.int64())])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first segment to the last: the state each is entered in."""

    def all_of(rows) -> Iterator[tuple]:
        for _, segments in groupby(rows, key=lambda r: r[0]):
            state = 0
            for conv, seg, exits in segments:
                yield conv, seg, state
                state = exits[state]

    yield from _tables(all_of(_rows(batches)), ["conv_id", "seg", "entry"], [pa.int64()] * 3)


def _segment_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def one(key, turns) -> tuple:
        *_, after, is_last, entry = next(turns)
        held = [t[3:6] for t in turns]
        audit, *_ = walk([h[0] for h in held], after, entry, is_last)
        return *key, edited(audit, entry, [h[1] for h in held], [h[2] for h in held])

    done = (one(key, turns) for key, turns in groupby(_rows(batches), key=lambda r: r[:2]))
    yield from _tables(done, ["conv_id", "chunk", "edits"], [pa.int64(), pa.int64(), _EDIT])


def _per_segment(rows: DataFrame, place: str, task, schema: str) -> DataFrame:
    """``task`` over rows sorted by conversation, segment and place."""
    return (
        rows.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", place).mapInArrow(task, schema)
    )


def _per_conversation(rows: DataFrame, order, task, schema: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), order).mapInArrow(task, schema)


def _same(*columns: str):
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    return on


def _segmented(rows: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Summary and chunks of conversations that are cut into segments."""
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    named = rows.select("conv_id").distinct()
    order = ["conv_id", "turn", "role", "hash", "row"]
    # The running row id parts equal rows, so that none of them must share a task.
    ordered = (
        rows.where("NOT gone")
        .select("conv_id", "turn", "role", "text", "fault", F.xxhash64("text").alias("hash"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "fault")
    )
    numbered = stage(
        ordered.mapInArrow(
            _numbered, "conv_id long, turn long, role string, text string, fault int, part long, at long"
        )
    )
    sizes = numbered.groupBy("conv_id", "part").agg(F.count("*").alias("size"))
    parts = Window.partitionBy("conv_id").orderBy("part")
    starts = sizes.select(
        "conv_id", "part",
        (F.sum("size").over(parts.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")).alias("start"),
        F.sum("size").over(Window.partitionBy("conv_id")).alias("total"),
    )
    said = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary"))
    placed = stage(
        numbered.alias("x").join(starts.alias("y"), _same("conv_id", "part"))
        .select(
            "x.conv_id", "turn", "role", "text", "fault", said.alias("said"),
            (F.col("start") + F.col("at") - 1).alias("pos"),
            F.greatest(F.lit(segment), F.ceil(F.sqrt("total"))).alias("size"),
        )
    )
    firsts = placed.groupBy("conv_id", "said").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = (F.col("fault") != _MUST_GO) & F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    initial = F.coalesce(F.nullif(F.instr(F.lit(_INITIALS), F.left("role", F.lit(1))), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.col("role") == "", 3).otherwise(initial)
    ready = stage(
        placed.alias("x").join(firsts.alias("y"), _same("conv_id", "said"), "left")
        .withColumn("again", again)
        .select(
            F.col("x.conv_id").alias("conv_id"), F.floor(F.col("pos") / F.col("size")).alias("seg"), "pos",
            (initial + 4 * F.when(F.col("again"), _MUST_GO).otherwise(F.col("fault"))).cast("long").alias("code"),
            # Which count the turn adds to: 1 blank, 2 duplicate, 3 truncated.
            F.when(F.col("fault") == _MUST_GO, 1).when(F.col("again"), 2).when(F.col("fault") == _CUT, 3)
            .otherwise(0).alias("count"),
            "role", "text",
        )
    )
    turns = ready.select("conv_id", "seg", "pos", "code")
    matrices = stage(
        _per_segment(
            ready.select("conv_id", "seg", "pos", "code", "count"), "pos", _matrices,
            f"conv_id long, seg long, costs array<long>, {counts}, first long, last long",
        )
    )
    borders = stage(
        _per_conversation(
            matrices, F.desc("seg"), _borders,
            f"conv_id long, seg long, after array<long>, is_last boolean, {counts}, cost long",
        )
    )
    # A segment's border goes before its turns.
    heads = borders.select("conv_id", "seg", F.lit(-1).cast("long").alias("pos"), "after", "is_last")
    exits = _per_segment(
        turns.unionByName(heads, allowMissingColumns=True), "pos", _exits, "conv_id long, seg long, exits array<long>"
    )
    entries = stage(_per_conversation(exits, F.asc("seg"), _entries, "conv_id long, seg long, entry long"))
    entered = heads.alias("x").join(entries.alias("y"), _same("conv_id", "seg")).select("x.*", "entry")
    chunks = stage(
        _per_segment(
            ready.drop("count").unionByName(entered, allowMissingColumns=True), "pos", _segment_edits,
            f"conv_id long, chunk long, {_EDITS}",
        )
    )
    totals = borders.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.max(F.when(F.col("seg") == 0, F.col("cost"))).alias("cost")
    )
    spans = placed.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    known = totals.alias("x").join(spans.alias("y"), _same("conv_id")).select("x.*", "gaps")
    summary = stage(
        named.alias("x").join(known.alias("y"), _same("conv_id"), "left").select(
            "x.conv_id", *[F.coalesce(f"y.{c}", F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS, "cost")]
        )
    )
    discard(numbered, placed, ready, matrices, borders, entries)
    return summary, chunks


def _plain() -> list[Column]:
    """conv_id, turn, role and text; nulls of the last two as one space."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")] + texts


def damaged(conversations: DataFrame, kinds: int = 20) -> DataFrame:
    """Conversations with faults put in by crc32 of ``conv_id:turn`` modulo ``kinds``: 0 drops the
    row (it stays with ``gone`` set, so that its conversation is not lost), 1 empties the text,
    2 takes its sentence ends away, 3 doubles it, 4 makes the role user."""
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    rows = conversations.select(*_plain()).withColumn("kind", F.crc32(name.cast("binary")) % kinds)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(copies).alias("copy"),
    ).drop("copy")


def repair(
    conversations: DataFrame, segment: int = SEGMENT, gone: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Summary (conv_id, gaps, blank, duplicate, truncated, illegal, cost) with one row per
    conversation, and chunks (conv_id, chunk, edits of edit, role and text) that give, in the
    order of ``chunk``, all edits of a conversation.

    ``conversations`` holds conv_id, turn, role and text; a row whose column ``gone`` is true is no turn.
    """
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", _MUST_GO).when(~last.isin(*STOPS), _CUT).otherwise(_SOUND)
    left_out = F.lit(False) if gone is None else F.col(gone)
    rows = conversations.select(left_out.alias("gone"), *_plain()).withColumn("fault", fault)
    long = stage(
        rows.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > segment).select("conv_id")
    )
    short = rows.alias("x").join(long.alias("y"), _same("conv_id"), "left_anti")
    whole = stage(
        short.withColumn("hash", F.xxhash64("text")).repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "hash")
        .select("conv_id", "gone", "turn", "role", "text", "fault")
        .mapInArrow(
            _whole, f"conv_id long, gaps long, {', '.join(f'{c} long' for c in _COUNTS)}, cost long, {_EDITS}"
        ),
        "zstd",
    )
    summary = whole.drop("edits")
    chunks = whole.select("conv_id", F.lit(0).cast("long").alias("chunk"), "edits")
    if long.head(1):
        cut = rows.alias("x").join(long.alias("y"), _same("conv_id"), "left_semi")
        more, pieces = _segmented(cut, segment)
        summary, chunks = summary.unionByName(more), chunks.unionByName(pieces)
    discard(long)
    return summary, chunks


def repaired_turns(chunks: DataFrame) -> DataFrame:
    """conv_id, place (from 0, in order), role and text of the repaired turns of the chunks."""
    left = F.filter("edits", lambda e: e["edit"] != "D")
    sizes = chunks.select("conv_id", "chunk", left.alias("left"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "*", F.coalesce(F.sum(F.size("left")).over(before), F.lit(0)).alias("start")
    )
    return starts.select("conv_id", "start", F.posexplode("left").alias("at", "turn")).select(
        "conv_id", (F.col("start") + F.col("at")).alias("place"), "turn.role", "turn.text"
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters and hash of each conversation, chunk by chunk as they come."""

    def all_of(rows) -> Iterator[tuple]:
        for conv, chunks in groupby(rows, key=lambda r: r[0]):
            letters, content, first = [], hashlib.sha256(), True
            for _, audit, turns in chunks:
                letters.append(audit)
                if turns is not None:
                    content.update((turns if first else "\n" + turns).encode())
                    first = False
            yield conv, "".join(letters), content.hexdigest()

    yield from _tables(all_of(_rows(batches)), ["conv_id", "audit", "repaired_sha256"], [pa.int64(), pa.string(), pa.string()])


def repair_digest(conversations: DataFrame, segment: int = SEGMENT, gone: str | None = "gone") -> DataFrame:
    """The summary with ``audit``, the letters of all edits, and ``repaired_sha256`` of the repaired
    ``role:text`` joined by newlines. The hash of one conversation is one stream by its nature:
    its chunks pass one task one after another, and none is held."""
    summary, chunks = repair(conversations, segment, gone)
    left = F.filter("edits", lambda e: e["edit"] != "D")
    said = F.array_join(F.transform(left, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n")
    pieces = chunks.select(
        "conv_id", "chunk", F.array_join("edits.edit", "").alias("audit"), F.when(F.size(left) > 0, said).alias("turns")
    )
    digests = (
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").drop("chunk")
        .mapInArrow(_digests, "conv_id long, audit string, repaired_sha256 string")
    )
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return summary.alias("x").join(digests.alias("y"), _same("conv_id"), "left").select(
        "x.*", F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")
    )
