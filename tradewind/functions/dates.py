"""Date parsing, ISO weeks and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.numbers import as_column


def parse_day(c: str | Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.try_to_date(as_column(c), pattern)


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(as_column(c))


def year_week(year: str | Column, week: str | Column) -> Column:
    return F.concat(
        as_column(year).cast("string"), F.lpad(as_column(week).cast("string"), 2, "0")
    )


def majority_month(begin: str | Column, end: str | Column) -> Column:
    """Struct ``(year, month_number)`` of the month holding most days of a period.

    The largest share of the days wins, the earlier month on a tie. Only the first
    three months a period touches can win: of two whole months in a row one has 31
    days, which no later month beats. So the answer is a plain expression of the row,
    without expanding days and without a shuffle. NULL when either date is missing.
    """
    a, b = as_column(begin), as_column(end)
    low, high = F.least(a, b), F.greatest(a, b)
    months = [F.add_months(F.trunc(low, "MM"), i) for i in range(3)]

    def days_in(month: Column) -> Column:
        return F.datediff(F.least(F.last_day(month), high), F.greatest(month, low)) + 1

    first, second, third = (days_in(m) for m in months)
    best = (
        F.when((first >= second) & (first >= third), months[0])
        .when(second >= third, months[1])
        .otherwise(months[2])
    )
    return F.when(
        a.isNotNull() & b.isNotNull(),
        F.struct(F.year(best).alias("year"), F.month(best).alias("month_number")),
    )


def month_text(year: str | Column, month: str | Column) -> Column:
    """``yyyy-MM``; NULL for an impossible year or month."""
    first_day = F.try_to_date(
        F.concat_ws(
            "-", as_column(year).cast("string"), as_column(month).cast("string"), F.lit("1")
        ),
        "y-M-d",
    )
    return F.when(
        as_column(year).isNotNull() & as_column(month).isNotNull(),
        F.date_format(first_day, "yyyy-MM"),
    )


def named_month_text(month_name: str | Column, year: str | Column) -> Column:
    """``('January', 2024)`` to ``2024-01``."""
    day = F.try_to_date(
        F.concat(as_column(month_name), F.lit(" 1 "), as_column(year).cast("string")),
        "MMMM d yyyy",
    )
    return F.date_format(day, "yyyy-MM")


def month_start(year_month: str | Column) -> Column:
    return F.try_to_date(F.concat(as_column(year_month), F.lit("-01")), "yyyy-MM-dd")
