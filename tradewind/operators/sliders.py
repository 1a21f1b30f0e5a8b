"""Questions about all settings of the weight sliders at once.

A score is linear in each weight, so over a box of settings it lies between its values at the corners.
That decides most of a grid of settings without visiting it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.ordering import top_with_ties_by
from tradewind.operators.scoring import WEIGHT_COLUMNS, score_tree
from tradewind.operators.staging import materialise

_INDICATORS = ("size_n", "gap_n", "cagr_n", "gdp_n", "tariff_n", "dist_n")
_BOX = ["lo", "hi"]
# Scores are rounded to this.
_UNIT = 1e-4


# A box of so many settings at most is scored whole: splitting it would cost as much.
_WHOLE = 1024


def _settings() -> tuple[Column, Column]:
    """Whether all settings of a box are scored, and those that are: for a large one its corners."""
    widths = [F.col("hi")[i] - F.col("lo")[i] for i in range(len(WEIGHT_COLUMNS))]
    count = F.lit(1).cast("long")
    for width in widths:
        count = count * (width + 1)
    counts = [F.when(count <= _WHOLE, w + 1).when(w > 0, 2).otherwise(1).cast("long") for w in widths]
    strides = [F.when(count <= _WHOLE, 1).otherwise(w) for w in widths]
    total = F.lit(1).cast("long")
    for k in counts:
        total = total * k

    def setting(j: Column) -> Column:
        out, left = [], j
        for i, (k, stride) in enumerate(zip(counts, strides)):
            out.append((F.col("lo")[i] + left % k * stride).cast("int"))
            left = F.floor(left / k)
        return F.array(*out)

    return count <= _WHOLE, F.transform(F.sequence(F.lit(0).cast("long"), total - 1), setting)


def _crossed(boxes: Column, parts: Column) -> Column:
    """Each box with each part (a, b) as the range of its next weight."""
    return F.flatten(F.transform(boxes, lambda box: F.transform(parts, lambda part: F.struct(
        F.concat(box["lo"], F.array(part["a"])).alias("lo"), F.concat(box["hi"], F.array(part["b"])).alias("hi"),
    ))))


def _halves() -> Column:
    """The boxes that a box falls into when every weight is cut in the middle."""
    none = F.array().cast("array<int>")
    boxes = F.array(F.struct(none.alias("lo"), none.alias("hi")))
    for i in range(len(WEIGHT_COLUMNS)):
        a, b = F.col("lo")[i], F.col("hi")[i]
        middle = F.floor((a + b) / 2).cast("int")
        parts = F.when(a < b, F.array(
            F.struct(a.alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), b.alias("b"))
        )).otherwise(F.array(F.struct(a.alias("a"), b.alias("b"))))
        boxes = _crossed(boxes, parts)
    return boxes


def ever_in_top(rows: DataFrame, n: int = 12, steps: int = 100, key: tuple[str, ...] = ("country_id", "name")) -> DataFrame:
    """The ``key`` of partners that are among the ``n`` best, ties at the edge included, at any setting
    of the five weights on the grid 0, 1/steps, … 1.

    ``rows`` has one row per partner with the scaled indicators. Each round scores the corners of all
    open boxes. Who is among the best at a corner is found. Who scores less at every corner than the
    n-th best of the lowest corner scores is beaten in the whole box and leaves it. A box stays open
    while it holds a partner that is neither found nor beaten, and is cut in the middle of every
    weight, so there are at most log2(steps) rounds. Small boxes are scored whole and done. How many
    boxes stay open depends on how many partners lie close below the edge. Partners without a
    score are never among the best.
    """
    key = list(key)
    partners = materialise(rows.select(*key, *_INDICATORS))
    ends = [F.array(*[F.lit(v).cast("int") for _ in WEIGHT_COLUMNS]) for v in (0, steps)]
    boxes = partners.select(*[c.alias(b) for c, b in zip(ends, _BOX)], *key)
    known = partners.select(*key).limit(0)
    whole, settings = _settings()
    while True:
        corners = boxes.select(*_BOX, *key, F.explode(settings).alias("corner")).join(partners, key)
        weighted = corners.withColumns(
            {w: F.col("corner")[i] / F.lit(float(steps)) for i, w in enumerate(WEIGHT_COLUMNS)}
        )
        scored = materialise(
            score_tree(weighted).where("market_score IS NOT NULL").select(*_BOX, "corner", *key, "market_score")
        )
        best = top_with_ties_by(scored, [*_BOX, "corner"], "market_score", n).select(*key)
        known = materialise(known.unionByName(best).distinct())
        reach = materialise(scored.groupBy(*_BOX, *key).agg(
            F.min("market_score").alias("least"), F.max("market_score").alias("most")
        ))
        cuts = top_with_ties_by(reach, _BOX, "least", n).groupBy(*_BOX).agg(F.min("least").alias("cut"))
        able = materialise(
            reach.where(~whole).join(cuts, _BOX).where(F.col("most") >= F.col("cut") - _UNIT).select(*_BOX, *key)
        )
        open_ = able.join(known, key, "left_anti").select(*_BOX).distinct()
        if open_.isEmpty():
            return known
        halves = open_.select(*_BOX, F.explode(_halves()).alias("half"))
        boxes = materialise(
            able.join(halves, _BOX).select(F.col("half.lo").alias("lo"), F.col("half.hi").alias("hi"), *key)
        )
