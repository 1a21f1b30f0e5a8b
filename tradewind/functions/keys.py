"""Composite text keys and their parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.numbers import as_column


def joined_key(*parts: str | Column, separator: str = "_") -> Column:
    """Parts joined by a separator; missing parts are left out."""
    return F.concat_ws(separator, *[as_column(p).cast("string") for p in parts])


def state_month_key(state: str | Column, year_month: str | Column) -> Column:
    """``state-yyyy-MM``; a missing part counts as empty text."""
    return F.concat(
        F.coalesce(as_column(state), F.lit("")),
        F.lit("-"),
        F.coalesce(as_column(year_month), F.lit("")),
    )


def state_of_key(key: str | Column) -> Column:
    """Text before the first dash (a state name holding a dash is cut there)."""
    return F.substring_index(as_column(key), "-", 1)


def month_of_key(key: str | Column) -> Column:
    return F.right(as_column(key), F.lit(7))


def whole_key(*keys: str) -> Column:
    """True when no key column is NULL."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present
