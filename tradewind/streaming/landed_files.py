"""Daily files as a stream: each landed file is taken once and merged.

The trigger takes what has landed and stops, so a schedule of daily runs becomes a
checkpointed stream that knows which files it has already seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators.staging import materialise
from tradewind.schemas import layout
from tradewind.sources.ledger import RunLedger
from tradewind.sources.tables import merge_new_rows


def stream_files(
    spark: SparkSession,
    root: str,
    key: str,
    extension: str,
    schema: T.StructType | str,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Landed files of one source as a stream."""
    reader = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", f"{key}_*.{extension}")
        .option("recursiveFileLookup", True)
    )
    if extension == "csv":
        return reader.option("header", True).csv(f"{root}/{key}")
    return reader.option("multiLine", True).json(f"{root}/{key}")


def merge_stream(
    stream: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    table: str,
    ddl: str,
    keys: list[str],
    checkpoint: str,
    range_key: str | None = None,
    partition_by: list[str] | None = None,
    ledger: RunLedger | None = None,
) -> StreamingQuery:
    """Clean each batch and add its new rows to a table.

    A batch repeated after a failure adds no whole key twice: the table holds it. Rows whose key has
    a NULL match nothing, so with a ``ledger`` they go to the table ``{table}_unkeyed`` under
    the stream (its checkpoint) and batch, and come once however often the batch is repeated.
    ``with_unkeyed`` reads both. Without a ledger they join the others, once per attempt.
    Batches run in a session of their own; a session that has already read the table
    sees new rows after ``spark.catalog.refreshTable(table)``.
    """

    def apply(batch: DataFrame, number: int) -> None:
        cleaned = clean(batch)
        if ledger is None:
            merge_new_rows(cleaned, table, ddl, keys, range_key, partition_by)
            return
        if ledger.done(batch.sparkSession, table, checkpoint, number):
            return
        cleaned = materialise(cleaned)
        keyed = F.lit(True)
        for key in keys:
            keyed = keyed & F.col(key).isNotNull()
        merge_new_rows(cleaned.where(keyed), table, ddl, keys, range_key, partition_by)
        ledger.append_once(cleaned.where(~keyed), f"{table}_unkeyed", ddl, checkpoint, number)
        ledger.record(batch.sparkSession, table, checkpoint, number)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def with_unkeyed(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    """All rows that a stream with a ledger has added."""
    names = layout(ddl).names
    return spark.table(table).select(*names).unionByName(spark.table(f"{table}_unkeyed").select(*names))
