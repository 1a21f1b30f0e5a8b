"""Landed files: ``{root}/{key}/{key}_{yyyy-MM-dd}.{json|csv}``.

One naming rule serves writers and readers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.staging import materialise

# The landed sources and their file formats.
LANDED = {
    "ue_pork_prices": "json",
    "ue_pork_production": "json",
    "population": "json",
    "gdp_per_capita": "json",
    "pork_consumption_per_capita": "csv",
    "pork_consumption": "csv",
    "pork_domestic_supply": "csv",
    "pork_production": "csv",
    "gdp_growth": "csv",
    "pork_import": "csv",
    "pigs_trade_export": "csv",
    "pigs_trade_import": "csv",
    "pork_tariff": "csv",
    "distance": "csv",
}

CORRUPT = "_corrupt_record"
# JSON bytes a file of objects should hold: one task sorts and writes it.
FILE_BYTES = 16 << 20
_DATE_IN_NAME = r"_(\d{4}-\d{2}-\d{2})\.[a-z]+$"


def landing_path(root: str, key: str, day: dt.date | str, extension: str | None = None) -> str:
    return f"{root}/{key}/{key}_{day}.{extension or LANDED[key]}"


def _text_schema(columns: list[str] | T.StructType) -> T.StructType:
    if isinstance(columns, T.StructType):
        return columns
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], keep_corrupt: bool = False
) -> DataFrame:
    """CSV with a header, every column as text. The schema is given, not inferred:
    no extra pass over the file. ``keep_corrupt`` adds the raw text of bad rows."""
    schema = _text_schema(columns)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names as the file states them."""
    return spark.read.option("header", True).csv(path).columns


def read_json(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, array: bool = True
) -> DataFrame:
    """JSON records. ``array=True`` reads a file that is one array (not splittable);
    large sources should land one object per line and pass ``array=False``."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_json_array(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Objects of files that are each one JSON array, read by many tasks.

    Files are split into pieces that end at a closing brace, wherever it stands. Per block of a file,
    running sums count quotes and open brackets of its pieces, once as if the block began inside a
    text and once as if not; the blocks before it tell which holds, and how deep it begins. An object
    ends where one bracket, the array's, is still open. Its pieces, also those from the next block, meet
    by the object's number in its file. Only a block (``spark.sql.files.maxPartitionBytes``) and an
    object are ever held by one task.

    Elements must be objects or null; nulls, and an array without objects, give no row. An object that
    does not fit the schema has NULLs, like a row of any JSON reader, and so has the unfinished one of a
    file that was cut short.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    text = F.col("value")
    # Escaped characters are no quotes; a piece never ends within an escape.
    plain = F.regexp_replace(text, r"\\.", "")
    quotes = F.regexp_count(plain, F.lit('"'))

    def depth(bare: Column) -> Column:
        outside = F.regexp_replace(bare, r'"[^"]*("|$)', "")
        opened = F.length(F.regexp_replace(outside, r"[^\[{]", ""))
        closed = F.length(F.regexp_replace(outside, r"[^\]}]", ""))
        return (opened - closed).cast("long")

    # The brace that ended the piece counts if the piece ends outside a text.
    odd = quotes % 2 == 1
    pieces = (
        spark.read.option("lineSep", "}").text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), "value", quotes.alias("quotes"),
            (depth(plain) - F.when(odd, 0).otherwise(1)).alias("from_outside"),
            (depth(F.concat(F.lit('"'), plain)) - F.when(odd, 1).otherwise(0)).alias("from_inside"),
        )
    )
    upto = Window.partitionBy("file", "block").orderBy("at")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    swapped = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1

    def running(swap: Column, straight: str, crossed: str) -> Column:
        return F.sum(F.when(swap, F.col(crossed)).otherwise(F.col(straight))).over(upto)

    local = materialise(
        pieces.withColumn("swapped", swapped)
        .withColumn("deep_outside", running(F.col("swapped"), "from_outside", "from_inside"))
        .withColumn("deep_inside", running(F.col("swapped"), "from_inside", "from_outside"))
        .withColumn("even", (F.sum("quotes").over(upto) % 2) == 0)
        .drop("swapped", "from_outside", "from_inside")
    )
    # One row per block from here on.
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.max_by("deep_outside", "at").alias("outside"),
        F.max_by("deep_inside", "at").alias("inside"),
    )
    inside = F.coalesce(F.sum("quotes").over(blocks), F.lit(0)) % 2 == 1
    begins = totals.withColumn("began_inside", inside).withColumn(
        "deep", F.coalesce(
            F.sum(F.when(F.col("began_inside"), F.col("inside")).otherwise(F.col("outside"))).over(blocks), F.lit(0)
        ),
    ).select("file", "block", "began_inside", "deep")
    ended = (F.col("even") != F.col("began_inside")) & (
        F.col("deep") + F.when(F.col("began_inside"), F.col("deep_inside")).otherwise(F.col("deep_outside")) == 1
    )
    marked = local.join(begins, ["file", "block"]).select(
        "file", "block", "at", "value", F.coalesce(ended, F.lit(False)).cast("int").alias("ended")
    )
    counted = materialise(marked.withColumn("objects", F.coalesce(F.sum("ended").over(before), F.lit(0))))
    earlier = counted.groupBy("file", "block").agg(F.sum("ended").alias("ended")).select(
        "file", "block", F.coalesce(F.sum("ended").over(blocks), F.lit(0)).alias("earlier")
    )
    objects = (
        counted.join(earlier, ["file", "block"])
        .groupBy("file", (F.col("earlier") + F.col("objects")).alias("number"))
        .agg(
            F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("pieces"),
            F.max("ended").alias("whole"),
        )
        .where("whole = 1")
    )
    joined = F.concat(F.array_join(F.transform("pieces", lambda p: p["value"]), "}"), F.lit("}"))
    # What stands before an object's first brace is the array's bracket, a comma, or nulls.
    return (
        objects.select(joined.alias("json"))
        .select(F.from_json(F.expr("substring(json, instr(json, '{'))"), wanted).alias("__row"))
        .select("__row.*")
    )


def land_arrays(df: DataFrame, path: str, files: int = 16) -> str:
    """Write a frame below ``path`` as files that are each one JSON array over many lines.

    ``files`` at most, or as many as it takes for ``FILE_BYTES`` in each: a file is one task's work,
    which must not grow with the frame.
    """
    order = Window.partitionBy("file").orderBy("hash", "json")
    head = F.when(F.lag("json").over(order).isNull(), "[").otherwise(",")
    tail = F.when(F.lead("json").over(order).isNull(), "]").otherwise("")
    objects = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
    size = objects.agg(F.sum(F.octet_length("json"))).first()[0] or 0
    files = max(files, -(-size // FILE_BYTES))
    rows = objects.withColumn("hash", F.xxhash64("json")).withColumn("file", F.pmod("hash", F.lit(files))).repartition(files, "file")
    rows.select("file", F.concat(head, "json", tail).alias("value")).write.partitionBy("file").text(path)
    return path


def file_date(path: Column) -> Column:
    """Ingestion date in a landed file's name; NULL for other names."""
    return F.try_to_date(F.regexp_extract(path, _DATE_IN_NAME, 1), "yyyy-MM-dd")


def landed_dates(spark: SparkSession, root: str, key: str, extension: str | None = None) -> DataFrame:
    """Landed files of a source with their dates. Reads names, not contents."""
    files = spark.read.format("binaryFile").load(f"{root}/{key}/{key}_*.{extension or LANDED[key]}")
    return files.select("path", file_date(F.col("path")).alias("ingestion_date")).where(
        F.col("ingestion_date").isNotNull()
    )


def latest_date(spark: SparkSession, root: str, key: str, extension: str | None = None) -> dt.date:
    """Date of the newest landed file: one value, found from file names alone."""
    try:
        newest = landed_dates(spark, root, key, extension).agg(F.max("ingestion_date")).first()[0]
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        raise FileNotFoundError(f"nothing landed for {key} below {root}")
    return newest


def landed_paths(
    spark: SparkSession, root: str, keys: list[str], days: dt.date | dict[str, dt.date] | None
) -> tuple[dict[str, str], dt.date]:
    """The file of every source, and the newest of their dates.

    ``days`` is one date, or a date per source; a source without one has its newest file. A file
    that is not there is an error.
    """
    if isinstance(days, dt.date):
        days = dict.fromkeys(keys, days)
    found = {k: (days or {}).get(k) or latest_date(spark, root, k) for k in keys}
    paths = {k: landing_path(root, k, day) for k, day in found.items()}
    missing = []
    for k, name in paths.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            missing.append(k)
    if missing:
        raise FileNotFoundError(f"not landed below {root}: {', '.join(missing)}")
    return paths, max(found.values())


def with_file_date(df: DataFrame) -> DataFrame:
    """Add the ingestion date of each row's file."""
    return df.withColumn("ingestion_date", file_date(F.col("_metadata.file_path")))


def latest_snapshot(df: DataFrame, date_column: str = "ingestion_date") -> DataFrame:
    """Rows of the newest date. The date is a scalar subquery: no driver round trip,
    and on a table partitioned by it only that partition is read."""
    newest = df.agg(F.max(date_column).alias("newest")).scalar()
    return df.where(F.col(date_column) == newest)


def unwrap_payload(df: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """Rows of ``[paging, rows]`` documents; a document without rows gives none.

    ``fields`` maps a result name to ``'$.path type'``. Other columns are kept.
    """
    view = df.select(
        *[c for c in df.columns if c != payload],
        F.try_parse_json(F.col(payload)).alias("__doc"),
    ).select("*", F.try_variant_get("__doc", "$[1]", "variant").alias("__rows"))
    rows = view.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("__rows").outer()).select(
            F.col("value").alias("__row")
        )
    )
    picked = []
    for name, spec in fields.items():
        path, kind = spec.split(" ")
        picked.append(F.try_variant_get("__row", path, kind).alias(name))
    return rows.select(*[c for c in df.columns if c != payload], *picked)


def land(df: DataFrame, root: str, key: str, day: dt.date | str, extension: str) -> str:
    """Write a frame in landing layout (a folder of part files bearing the name)."""
    path = landing_path(root, key, day, extension)
    if extension == "csv":
        df.write.option("header", True).csv(path)
    else:
        df.write.option("ignoreNullFields", False).json(path)
    return path
