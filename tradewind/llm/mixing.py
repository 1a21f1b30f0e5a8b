"""Mixing sources to target weights by proportionate-fair scheduling (operator 2).

Each source's documents are laid end to end and cut into blocks of ``BLOCK`` bytes. A source
with share s of a cycle of Q slots releases its block k at slot floor(k Q / s), and the block
is due by slot ceil((k + 1) Q / s). Every slot takes the released block with the earliest
deadline. The shares fill the cycle exactly, so all deadlines hold, and at every point each
source is less than one block from its target. The schedule repeats with the cycle, so it
is worked out for one cycle only, by a fold over its slots in SQL; a document finds its slot
by a join on its block's place in the cycle. Only built-in functions are used.

A source runs through its documents again when its weight asks for more than it has, until all
other sources were seen once, ``EPOCHS`` times at most. No document is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stage

BLOCK = 64 << 10
CYCLE = 1000
# Weights are the sources' bytes to this power, unless given: below 1 lifts small sources.
TEMPERATURE = 0.9
EPOCHS = 4
# Documents that one task lays end to end.
NUMBERED = 20_000


def _sid() -> Column:
    """Key of a source; no source is a source of its own."""
    return F.xxhash64(F.col("source").isNull(), F.col("source").cast("string"))


def _documents(docs: DataFrame) -> DataFrame:
    """One row per distinct document: key, sid, source, doc_id, bytes, rows that are it."""
    text = F.coalesce("text", F.lit(""))
    return (
        docs.select(
            F.xxhash64(F.col("doc_id").isNull(), "doc_id", _sid(), text).alias("key"), _sid().alias("sid"),
            "source", "doc_id", (F.octet_length(text) + 1).cast("long").alias("n_bytes"),
        )
        .groupBy("key", "sid", "source", "doc_id").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows"))
    )


def shares(totals: DataFrame, weights: dict[str | None, float] | None) -> DataFrame:
    """``totals`` (sid, source, n_bytes, n_docs) with the slots of a cycle due to each source.

    Largest remainders; a source has one slot at least. The cycle is CYCLE, or four slots per
    source where that is more. Sources without a given weight have weight 0, that is one slot.
    """
    if weights is None:
        weight = F.pow(F.col("n_bytes").cast("double"), F.lit(TEMPERATURE))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    every = Window.partitionBy()
    named = totals.withColumn("weight", weight).withColumn(
        "cycle", F.greatest(F.lit(CYCLE), F.count("*").over(every) * 4).cast("long")
    )
    exact = F.coalesce(F.try_divide("weight", F.sum("weight").over(every)), F.lit(0.0)) * F.col("cycle")
    given = named.withColumn("exact", exact).withColumn("base", F.greatest(F.floor("exact"), F.lit(1)).cast("long"))
    by_rest = Window.orderBy((F.col("exact") - F.floor("exact")).desc(), "sid")
    by_size = Window.orderBy(F.desc("base"), "sid")
    open_slots = F.col("cycle") - F.sum("base").over(every)
    ranked = given.select(
        "*", open_slots.alias("open"), F.row_number().over(by_rest).alias("r"), F.row_number().over(by_size).alias("s")
    )
    more = F.when(F.col("r") <= F.col("open"), 1).otherwise(0)
    # More floors than slots, or no weights at all: the largest share makes up for it.
    less = F.when((F.col("s") == 1) & (F.col("open") < 0), F.col("open")).otherwise(0)
    rest = F.when((F.col("s") == 1), F.greatest(F.lit(0), F.col("open") - F.count("*").over(every))).otherwise(0)
    return ranked.select("sid", "source", "n_bytes", "n_docs", "cycle", (F.col("base") + more + less + rest).alias("share"))


def cycle_slots(shared: DataFrame) -> DataFrame:
    """(sid, share, cycle, k, slot): the slot of each source's k-th block within one cycle."""
    one = shared.agg(
        F.sort_array(F.collect_list(F.struct("sid", "share"))).alias("s"), F.max("cycle").alias("q")
    ).where("q IS NOT NULL")
    order = F.expr(
        """
        aggregate(
          sequence(0L, q - 1),
          struct(transform(s, x -> 0L) AS done, CAST(array() AS array<int>) AS picks),
          (a, t) -> transform(array(array_min(transform(s, (x, i) -> IF(
              (a.done[i] * q) DIV x.share <= t,
              struct(((a.done[i] + 1) * q + x.share - 1) DIV x.share AS due, i AS i), NULL)))),
            p -> struct(
              transform(a.done, (d, i) -> IF(i = p.i, d + 1, d)) AS done,
              concat(a.picks, array(p.i)) AS picks))[0],
          a -> a.picks)
        """
    )
    slots = one.select("s", "q", F.posexplode(order).alias("slot", "i")).select(
        F.expr("s[i].sid").alias("sid"), F.expr("s[i].share").alias("share"), F.col("q").alias("cycle"),
        F.col("slot").cast("long").alias("slot"),
    )
    turn = Window.partitionBy("sid").orderBy("slot")
    return slots.withColumn("k", (F.row_number().over(turn) - 1).cast("long"))


def _laid(documents: DataFrame, shared: DataFrame) -> DataFrame:
    """Each document with the bytes of its source before it, in an order drawn by hash."""
    parts = F.ceil(F.col("n_docs") / NUMBERED)
    split = documents.join(F.broadcast(shared.select("sid", "n_docs")), "sid").withColumn(
        "part", F.pmod(F.xxhash64("key", F.lit(5)), parts)
    )
    sums = split.groupBy("sid", "part").agg(F.sum("n_bytes").alias("b"))
    ahead = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("sid", "part", F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("before"))
    own = Window.partitionBy("sid", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        split.withColumn("within", F.coalesce(F.sum("n_bytes").over(own), F.lit(0)))
        .join(before, ["sid", "part"])
        .select("key", "sid", "source", "doc_id", "n_bytes", (F.col("before") + F.col("within")).alias("start"))
    )


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Slots of all documents: key, doc_id, source, share, cycle, block, epoch, slot and place.

    ``place`` is the byte where the document starts within its source, which orders the documents
    of a slot. Null texts count as empty, a null source is a source, rows that repeat a
    document share its row. An empty table gives an empty schedule. The number of sources is
    taken to be small: their totals, and one cycle of slots, are broadcast.
    """
    documents = stage(_documents(docs))
    totals = documents.groupBy("sid").agg(
        F.min("source").alias("source"), F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_docs")
    )
    shared = stage(shares(totals, weights))
    slots = stage(cycle_slots(shared))

    def slot_of(k: Column) -> Column:
        return F.floor(k / F.col("share")) * F.col("cycle") + F.col("slot")

    # Blocks of each source, and the slot by which every source was seen once.
    blocks = shared.withColumn("n_blocks", F.ceil(F.col("n_bytes") / BLOCK).cast("long"))
    last = F.max(slot_of(F.col("n_blocks") - 1)).over(Window.partitionBy())
    timed_blocks = blocks.withColumn("k", F.pmod(F.col("n_blocks") - 1, F.col("share"))).join(
        slots.select("sid", "k", "slot"), ["sid", "k"]
    ).select("sid", "share", "n_blocks", last.alias("last"))
    laid = _laid(documents, shared).withColumn("block", F.floor(F.col("start") / BLOCK).cast("long"))
    timed = laid.join(F.broadcast(timed_blocks), "sid").withColumn(
        "epoch", F.explode(F.expr(f"sequence(0, {EPOCHS - 1})"))
    )
    k = F.col("block") + F.col("epoch") * F.col("n_blocks")
    out = (
        timed.withColumn("turn", k).withColumn("k", F.pmod(k, F.col("share")))
        .join(F.broadcast(slots.drop("share")), ["sid", "k"])
        .withColumn("slot", slot_of(F.col("turn")).cast("long"))
        .where((F.col("epoch") == 0) | (F.col("slot") <= F.col("last")))
        .select("key", "doc_id", "source", "share", "cycle", "block", "epoch", "slot", F.col("start").alias("place"))
    )
    done = stage(out)
    discard(documents, shared, slots)
    return done


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """``docs`` in the order of the schedule, documents of later epochs repeated.

    The order is that of the rows over the partitions, so files written from it keep it.
    """
    plan = schedule(docs, weights).select(
        F.col("key").alias("__key"), F.col("slot").alias("__slot"), F.col("place").alias("__place")
    )
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn("__key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", _sid(), text))
    order = ["__slot", "__place", "__key"]
    return keyed.join(plan, "__key").repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
