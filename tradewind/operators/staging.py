"""Written intermediate tables.

A frame used by several branches is written once as Parquet below the shared
folder named by ``spark.checkpoint.dir`` and read back. That cuts the lineage,
survives lost executors, and gives the optimizer true file sizes, so joins turn
into broadcasts only when the written side really is below
``spark.sql.autoBroadcastJoinThreshold``. No broadcast hint is used for data.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Folder for written intermediates of this application."""
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tradewind-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tradewind-")
    return _local_roots[app]


def clear_staging(spark: SparkSession) -> None:
    """Delete the written intermediates of this application. Frames that read them,
    results of earlier calls included, can no longer be evaluated."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
