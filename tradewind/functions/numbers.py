"""Numeric cleaning, blank-aware arithmetic and number text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A plain number: no NaN, no Infinity, no type letter at the end.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def finite(c: str | Column) -> Column:
    """The number, or NULL where it is NaN or infinite."""
    c = as_column(c)
    return F.when(F.abs(c.cast("double")) < float("inf"), c)


def to_double(c: str | Column) -> Column:
    """Text to double; anything but a plain finite number becomes NULL."""
    c = as_column(c)
    return finite(F.when(c.cast("string").rlike(_NUMBER), c.try_cast("double")))


def to_whole(c: str | Column, kind: str = "int") -> Column:
    """Text to a whole number. '12.5' is cut to 12, unreadable text is NULL."""
    c = as_column(c)
    return F.coalesce(c.try_cast(kind), to_double(c).try_cast(kind))


def strip_symbol(c: str | Column, symbol: str = "€") -> Column:
    return F.replace(as_column(c), F.lit(symbol), F.lit(""))


def null_if_sentinel(c: str | Column, sentinel: str = ".") -> Column:
    return F.nullif(as_column(c), F.lit(sentinel))


def both_or_null(left: str | Column, right: str | Column) -> Column:
    """``left - right``; NULL unless both sides are known."""
    return as_column(left) - as_column(right)


def unit_scale(value: Column, low: Column, high: Column) -> Column:
    """Place ``value`` on [0, 1]. A range of zero width gives NULL."""
    return F.try_divide(value - low, high - low)


def compound_growth(first: Column, last: Column, steps: Column) -> Column:
    """Mean growth per step; NULL for a zero start, zero steps, or a change of sign."""
    return finite(F.pow(F.try_divide(last, first), F.try_divide(F.lit(1.0), steps)) - F.lit(1.0))


def blank_sum(*terms: Column) -> Column:
    """Sum in which a missing term counts as nothing, and all missing is NULL."""
    total = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in terms])
    return F.when(F.coalesce(*terms).isNotNull(), total)


def plain_number(c: str | Column, scale: int = 10) -> Column:
    """Number as text without exponent and without trailing zeros, rounded to ``scale`` places."""
    fixed = as_column(c).cast(f"decimal(38,{scale})").cast("string")
    # Zeros before the point stay.
    return F.regexp_replace(fixed, r"\.0+$|(\.\d*?)0+$", "$1")


def blank_text(*parts: str | Column) -> Column:
    """Join text parts, a missing part adding nothing; plain strings are literals."""
    columns = [F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(*columns)
