"""Tables by name or folder: create, replace, append, merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.merge import rows_to_insert, upsert
from tradewind.operators.ordering import stable_ids
from tradewind.operators.staging import materialise
from tradewind.schemas import conform, layout


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


@dataclass(frozen=True)
class Buckets:
    """Rows of equal keys share one of ``n`` files per write, by the hash a join shuffles by. ``n`` should
    not be below ``spark.sql.shuffle.partitions``, or the planner shuffles the table after all."""

    n: int
    keys: tuple[str, ...]


def create_if_missing(
    spark: SparkSession,
    name: str,
    ddl: str,
    partition_by: list[str] | None = None,
    buckets: Buckets | None = None,
    location: str | None = None,
) -> bool:
    """Create an empty table with the layout; True when it was made."""
    if table_exists(spark, name):
        return False
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout(ddl).fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if buckets:
        parts += f" CLUSTERED BY ({', '.join(buckets.keys)}) INTO {buckets.n} BUCKETS"
    if location:
        parts += f" LOCATION '{location}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")
    return True


def overwrite_path(df: DataFrame, path: str) -> None:
    """Replace a Parquet folder. ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, name: str, ddl: str) -> None:
    """Replace a table after bringing the frame to its layout."""
    create_if_missing(df.sparkSession, name, ddl)
    conform(df, ddl).write.mode("overwrite").format("parquet").saveAsTable(name)


def _append(
    df: DataFrame, name: str, partition_by: list[str] | None, buckets: Buckets | None = None
) -> None:
    """Append in the table's column order. Rows of a partitioned table are rebalanced:
    few files per partition, and a partition holding most rows is split. Rows of a bucketed
    table come by bucket, so that a task writes one file."""
    df = df.select(*df.sparkSession.table(name).columns)
    if buckets:
        df = df.repartition(buckets.n, *buckets.keys)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("append").insertInto(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Put ``df`` in place of the partitions of a table it has rows of; the others stay."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"  # the only way insertInto heeds it
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def write_by(df: DataFrame, path: str, by: str, value: str) -> None:
    """Write a fact to ``path`` in one folder per value of ``by``, and beside it a small table of
    these values: how many rows each has, and in how many ``value`` is known.

    The facts must be written before their summary names them, so a reader never sees a value of ``by``
    whose rows are missing. Rows without one go to a folder of their own, which no reader of a
    value opens.
    """
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(f"{path}/rows")
    read = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    read.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.count(value).alias("n_known")
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/{by}s")


def latest_of(spark: SparkSession, path: str, by: str, back: int = 0) -> DataFrame:
    """Rows of a fact of ``write_by`` for the newest value of ``by`` that has any known value, or of
    the numbers ``back`` before it up to it.

    The newest value is a scalar subquery over the summary, and ``by`` is a partition column: it reaches
    the scan as a filter on folders while the query runs, so other folders are not opened.
    """
    newest = (
        spark.read.parquet(f"{path}/{by}s").where("n_known > 0").agg(F.max(by).alias("newest")).scalar()
    )
    rows = spark.read.parquet(f"{path}/rows")
    if back:
        return rows.where((F.col(by) >= newest - back) & (F.col(by) <= newest))
    return rows.where(F.col(by) == newest)


def append_table(
    df: DataFrame, name: str, ddl: str, partition_by: list[str] | None = None
) -> None:
    create_if_missing(df.sparkSession, name, ddl, partition_by)
    _append(conform(df, ddl), name, partition_by)


def refresh_ids(keys: DataFrame, name: str, ddl: str, on: list[str], into: str) -> DataFrame:
    """The map of keys to ids in table ``name``, after ids for new keys were added to it.

    Ids that were given never change and are never given again.
    """
    spark = keys.sparkSession
    create_if_missing(spark, name, ddl)
    fresh = materialise(stable_ids(keys, spark.table(name), on, into))
    append_table(fresh, name, ddl)
    return spark.table(name)


def merge_new_rows(
    updates: DataFrame,
    name: str,
    ddl: str,
    keys: list[str],
    range_key: str | None = None,
    partition_by: list[str] | None = None,
    buckets: Buckets | None = None,
    location: str | None = None,
) -> None:
    """Append the rows whose key the table does not hold; matched rows stay as they are.

    The updates are written once, since the merge reads them several times and they may be a parsed
    extract. A new table is bucketed as ``buckets`` says: by the keys, a merge shuffles the updates
    only. The files of the table are listed before the append starts, so a retried task
    never compares with rows of its own run.
    """
    spark = updates.sparkSession
    create_if_missing(spark, name, ddl, partition_by, buckets, location)
    staged = materialise(conform(updates, ddl))
    new = rows_to_insert(spark.table(name), staged, keys, range_key)
    _append(new, name, partition_by, buckets)


def upsert_table(
    source: DataFrame,
    name: str,
    ddl: str,
    keys: list[str],
    values: list[str],
    unique_source: bool = False,
    partition_by: str | None = None,
) -> None:
    """Update matched rows and insert the others.

    The result is staged, then replaces the table. With ``partition_by``, one of the
    keys, only the partitions the source touches are read and rewritten. Rows whose
    partition key is NULL can match nothing and are only appended.
    """
    spark = source.sparkSession
    create_if_missing(spark, name, ddl, [partition_by] if partition_by else None)
    source = conform(source, ddl)
    target = spark.table(name)
    order = target.columns
    if partition_by is None:
        source = materialise(source)  # read by the update and by the insert
        merged = materialise(upsert(target, source, keys, values, unique_source).select(*order))
        merged.write.insertInto(name, overwrite=True)
        return
    source = materialise(source)
    loose = source.where(F.col(partition_by).isNull())
    source = source.where(F.col(partition_by).isNotNull())
    touched = source.select(partition_by).distinct()
    hit = target.join(touched, partition_by, "left_semi")
    merged = materialise(upsert(hit, source, keys, values, unique_source).select(*order))
    overwrite_partitions(merged.hint("rebalance", partition_by), name)
    _append(loose, name, [partition_by])
