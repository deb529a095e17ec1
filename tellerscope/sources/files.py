"""Files in, files out."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

FORMATS = ("csv", "json")
RESCUED = "_rescued_data"


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unhandled file format: {fmt}")
    return fmt


def _options(fmt: str, header: bool) -> dict[str, str]:
    return {"header": str(header).lower()} if _checked(fmt) == "csv" else {}


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file metadata, the file path and the time of processing."""
    return df.select("*", "_metadata").select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("processing_time"),
    )


def infer_schema(spark: SparkSession, path: str, fmt: str = "csv") -> T.StructType:
    """Typed schema of all existing files, to be given to ``ingest_files``.

    A value of a file that comes later and does not fit becomes NULL, or rescued content
    where ``read_with_rescue`` is used.
    """
    reader = spark.read.options(**_options(fmt, True))
    if fmt == "csv":
        reader = reader.option("inferSchema", True)
    return reader.format(fmt).load(path).schema


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    header: bool = True,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Batch read; without a header columns are named ``_c0``, ``_c1``, ..."""
    reader = spark.read.options(**_options(fmt, header))
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    return reader.format(fmt).load(path)


def read_with_rescue(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", header: bool = True
) -> DataFrame:
    """Rows that do not fit the schema keep their text in ``_rescued_data``."""
    return (
        spark.read.options(**_options(fmt, header))
        .schema(T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUED)
        .format(fmt)
        .load(path)
    )


def _first_start(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds of the first start of this ingest, kept beside its checkpoint."""
    path = f"{checkpoint.rstrip('/')}_first_start"
    try:
        return spark.read.schema("ms long").json(path).first()["ms"]
    except (AnalysisException, TypeError):
        now = int(time.time() * 1000)
        spark.range(1).select(F.lit(now).alias("ms")).write.mode("overwrite").json(path)
        return now


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", header: bool = True
) -> DataFrame:
    return spark.readStream.schema(schema).options(**_options(fmt, header)).format(fmt).load(path)


def ingest_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fmt: str = "csv",
    header: bool = True,
    include_existing: bool = True,
    columns: Sequence[str] | None = None,
) -> StreamingQuery:
    """Append every file of ``path`` not seen before to ``target``, once, and stop.

    ``target`` is a folder when it holds a ``/``, else a table. With
    ``include_existing=False`` files older than the first start are skipped for good.
    The call returns when all files present are loaded.
    """
    rows = with_provenance(file_stream(spark, path, schema, fmt, header))
    if not include_existing:
        start = F.timestamp_millis(F.lit(_first_start(spark, checkpoint)))
        rows = rows.filter(F.col("_metadata.file_modification_time") > start)
    if columns:
        rows = rows.select(*columns)
    writer = (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if "/" in target:
        query = writer.format("parquet").option("path", target).start()
    else:
        query = writer.toTable(target)
    query.awaitTermination()
    return query


def _save(rows: DataFrame, target: str, mode: str, location: str | None) -> None:
    writer = rows.write.mode(mode)
    (writer.option("path", location) if location else writer).saveAsTable(target)


def load_static(
    spark: SparkSession,
    path: str,
    target: str,
    fmt: str = "csv",
    header: bool = True,
    location: str | None = None,
) -> bool:
    """Create a table from files; ``False``, and nothing changed, if it is there already.

    Files that are not there, or cannot be read, raise an error.

    ``location`` keeps the table's data in a folder of its own, outside the warehouse.
    """
    if spark.catalog.tableExists(target):
        return False
    _save(read_files(spark, path, fmt, header), target, "errorifexists", location)
    return True


def replace_static(
    spark: SparkSession,
    path: str,
    target: str,
    fmt: str = "csv",
    header: bool = True,
    location: str | None = None,
) -> None:
    """Create the table anew from files, without rescued content."""
    _save(read_files(spark, path, fmt, header).drop(RESCUED), target, "overwrite", location)


def pull_csv(
    spark: SparkSession,
    path: str,
    target: str,
    columns: Sequence[str] | None = None,
    fmt: str = "csv",
    location: str | None = None,
) -> None:
    """Overwrite a table with some columns of a CSV location. Only CSV is handled."""
    if fmt != "csv":
        raise ValueError(f"unhandled file format: {fmt}")
    rows = read_files(spark, path)
    _save(rows.select(*columns) if columns else rows, target, "overwrite", location)


def export_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Write CSV with a header. ``single`` makes one file, in one task: small results only."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)
