"""What has been appended, so that a run or batch that is repeated appends nothing.

Rows go to a partition of their own, named by run and batch; then one row in the ledger says that they
are complete. A repeat after that does nothing. A repeat of a run that died between the two writes
its partition anew in place of what it left, so its rows never come twice either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.schemas import conform
from tradewind.sources import tables

_LEDGER = "table_name string, run_id string, batch_id bigint, at timestamp"
# Columns that an appended table carries behind its own.
RUN, BATCH = "run_id", "batch_id"


@dataclass(frozen=True)
class RunLedger:
    """The ledger kept in table ``name``; one row per finished run and batch of a table. With
    ``folder``, it and the tables it makes lie below that and not in the warehouse."""

    name: str
    folder: str | None = None

    def _make(self, spark: SparkSession, table: str, ddl: str, by: list[str] | None = None) -> None:
        location = f"{self.folder}/{table}" if self.folder else None
        tables.create_if_missing(spark, table, ddl, by, location=location)

    def done(self, spark: SparkSession, table: str, run: str, batch: int = 0) -> bool:
        self._make(spark, self.name, _LEDGER)
        spark.catalog.refreshTable(self.name)
        held = spark.table(self.name).where(
            (F.col("table_name") == table) & (F.col(RUN) == run) & (F.col(BATCH) == batch)
        )
        return not held.isEmpty()

    def record(self, spark: SparkSession, table: str, run: str, batch: int = 0) -> None:
        row = spark.range(1).select(
            F.lit(table).alias("table_name"), F.lit(run).alias(RUN),
            F.lit(batch).cast("bigint").alias(BATCH), F.current_timestamp().alias("at"),
        )
        tables.append_table(row, self.name, _LEDGER)

    def replace(self, rows: DataFrame, table: str, ddl: str, run: str, batch: int = 0) -> None:
        """Put ``rows`` in place of what this run and batch wrote before."""
        self._make(rows.sparkSession, table, f"{ddl}, {RUN} string, {BATCH} bigint", [RUN, BATCH])
        stamped = conform(rows, ddl).withColumns({RUN: F.lit(run), BATCH: F.lit(batch).cast("bigint")})
        tables.overwrite_partitions(stamped, table)

    def append_once(self, rows: DataFrame, table: str, ddl: str, run: str, batch: int = 0) -> bool:
        """Append ``rows`` unless this run and batch did so before; True when rows were written."""
        spark = rows.sparkSession
        if self.done(spark, table, run, batch):
            return False
        self.replace(rows, table, ddl, run, batch)
        self.record(spark, table, run, batch)
        return True
