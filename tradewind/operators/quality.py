"""Data checks: one pass for row rules, one grouped pass per uniqueness rule."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ValidationStopped(RuntimeError):
    """A structural check failed; the run must not go on."""


@dataclass(frozen=True)
class NotNull:
    column: str
    rule = "expect_column_values_to_not_be_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between:
    column: str
    low: float | None = None
    high: float | None = None
    rule = "expect_column_values_to_be_between"

    def failing(self) -> Column:
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | (F.col(self.column) < self.low)
        if self.high is not None:
            bad = bad | (F.col(self.column) > self.high)
        # NaN stands above every number, so it would pass a lower limit.
        number = F.col(self.column).try_cast("double")
        return F.coalesce(bad | F.isnan(number) | (F.abs(number) == float("inf")), F.lit(False))


@dataclass(frozen=True)
class UniqueTogether:
    """No two rows have one key. ``wide`` is for keys that are large, such as texts: their hashes
    are counted, and keys are compared among rows whose hash came twice only."""

    columns: tuple[str, ...]
    wide: bool = False
    rule = "expect_compound_columns_to_be_unique"
    column = "N/A"


@dataclass(frozen=True)
class ColumnOrder:
    """The table has these columns in this order; if not, every row counts."""

    columns: tuple[str, ...]
    rule = "expect_table_columns_to_match_ordered_list"
    column = "N/A"

    def holds(self, df: DataFrame) -> bool:
        return columns_match(df, list(self.columns))


@dataclass(frozen=True)
class ColumnType:
    """The column has this type; if not, every row counts."""

    column: str
    kind: str
    rule = "expect_column_values_to_be_of_type"

    def holds(self, df: DataFrame) -> bool:
        return not type_mismatches(df, {self.column: self.kind})


Check = NotNull | Between | UniqueTogether | ColumnOrder | ColumnType

# The layout of the log table.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)


def repeated_rows(df: DataFrame, columns: tuple[str, ...], wide: bool = False) -> DataFrame:
    """One row, one column: how many rows belong to a repeated key.

    Every row of a repeated key counts. Rows whose key parts are all NULL do not. With ``wide``
    the frame is read twice, but shuffled are 8 bytes a row and the keys of suspected rows.
    """
    some_key = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
    rows = df.where(some_key).select(*columns)
    if wide:
        hashed = rows.withColumn("__hash", F.xxhash64(*columns))
        met = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__hash")
        rows = hashed.join(met, "__hash", "left_semi")
    sizes = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.agg(
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("repeated")
    )


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: rule, column, unexpected and total count, success."""
    counted = [
        F.count_if(c.failing()).alias(f"c{i}")
        for i, c in enumerate(checks)
        if isinstance(c, (NotNull, Between))
    ]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counted)

    def outcome(i: int, check: Check) -> Column:
        if isinstance(check, UniqueTogether):
            unexpected = repeated_rows(df, check.columns, check.wide).scalar()
        elif isinstance(check, (ColumnOrder, ColumnType)):
            unexpected = F.lit(0).cast("long") if check.holds(df) else F.col("total")
        else:
            unexpected = F.col(f"c{i}")
        return F.struct(
            F.lit(i).alias("position"),
            F.lit(check.rule).alias("rule"),
            F.lit(check.column).alias("column"),
            unexpected.alias("unexpected_count"),
            F.col("total").alias("element_count"),
        )

    rows = totals.select(F.inline(F.array(*[outcome(i, c) for i, c in enumerate(checks)])))
    return rows.withColumn("success", F.col("unexpected_count") == 0)


def suite_message(results: DataFrame, file_name: str) -> DataFrame:
    """One row ``(severity, message)`` summing up the checks of one file.

    ``results`` holds one row per check, so ordering them costs nothing.
    """
    failed = F.transform(
        F.array_sort(
            F.collect_list(
                F.when(
                    ~F.col("success"),
                    F.struct("position", "rule", "column", "unexpected_count", "element_count"),
                )
            )
        ),
        lambda r: F.format_string(
            "%s(%s): %d/%d failed",
            r["rule"],
            r["column"],
            r["unexpected_count"],
            r["element_count"],
        ),
    )
    return results.agg(failed.alias("failed")).select(
        F.when(F.size("failed") > 0, "WARNING").otherwise("SUCCESS").alias("severity"),
        F.when(
            F.size("failed") > 0,
            F.concat(
                F.lit(f"⚠️ Validation failed for file {file_name}: "),
                F.array_join("failed", "; "),
            ),
        )
        .otherwise(F.lit(f"✅ File {file_name} passed validation successfully."))
        .alias("message"),
    )


def log_rows(messages: DataFrame, ingestion_date: dt.date) -> DataFrame:
    """Messages as rows of the log table."""
    return messages.select(
        F.current_timestamp().alias("timestamp"),
        "severity",
        "message",
        F.lit(ingestion_date).cast("date").alias("ingestion_date"),
    )


def error_row(df: DataFrame, text: str, ingestion_date: dt.date) -> DataFrame:
    """A single ERROR log row, made in the session of ``df``."""
    row = df.sparkSession.range(1).select(
        F.lit("ERROR").alias("severity"), F.lit(text).alias("message")
    )
    return log_rows(row, ingestion_date)


def columns_match(df: DataFrame, expected: list[str]) -> bool:
    """The columns are the expected ones, in the expected order."""
    return df.columns == expected


def type_mismatches(df: DataFrame, expected: dict[str, str]) -> dict[str, str]:
    """Columns whose type is not the expected one, with the type found."""
    found = dict(df.dtypes)
    return {c: found.get(c, "missing") for c, t in expected.items() if found.get(c) != t}
