"""Sources and sinks: capture scans, bronze copies, typed loads, snapshots.

Formats are arguments.  Avro and Delta need packages that are not on the
test machine; Parquet and JSON are the tested formats.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import parse_event_time
from feeflow.session import file_system


NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")  # no folder, or no file in it


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table holds files.  Any other trouble than a missing or empty
    folder (no access, a broken file) is raised, not taken for "no table"."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() not in NO_DATA:
            raise
        return False


# -- capture and bronze -----------------------------------------------------------

def read_capture(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                 merge_schema: bool = False, options: dict | None = None) -> DataFrame:
    """Read the whole capture tree (all sub-folders, any file name).

    ``fmt`` is any Spark source; ``avro`` needs the spark-avro package on the
    classpath (not on the test machine).  ``options`` pass through.
    """
    r = spark.read.format(fmt).options(**(options or {})).option("recursiveFileLookup", "true")
    if fmt == "avro":
        r = r.option("ignoreExtension", "true")
    if merge_schema:
        r = r.option("mergeSchema", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def landing_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files under ``path``: name, size and modification time (no content read)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(path).select("path", "length", "modificationTime")


def write_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


# -- parsed table -----------------------------------------------------------------

def write_parsed(df: DataFrame, path: str, partition_col: str = "event_date",
                 time_col: str = "enqueued_time") -> None:
    """Replace the whole flat table, partitioned by day (prunes by date)."""
    (df.withColumn(partition_col, F.to_date(F.col(time_col)))
       .write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy(partition_col).parquet(path))


def landing_json(parsed: DataFrame) -> DataFrame:
    """Parsed rows as landing JSON text, times in the capture text format."""
    payload = [c for c in parsed.columns if c not in ("sequence_number", "enqueued_time", "block_index")]
    rec = F.struct(
        F.col("sequence_number"),
        F.date_format("enqueued_time", S.CAPTURE_TIME_FORMAT).alias("enqueued_time"),
        *[F.col(c) for c in payload],
    )
    return parsed.select(F.to_json(rec).alias("value"))


def typed_paths(v: Column) -> list[Column]:
    """The 14 typed columns of a landing record held as VARIANT (``$1:f::TYPE``
    per field).  ``try_variant_get``: a value of the wrong type becomes NULL
    instead of failing the load."""
    def get(name, typ):
        return F.try_variant_get(v, f"$.{name}", typ)

    return [
        get("sequence_number", "bigint").alias("sequence_number"),
        parse_event_time(get("enqueued_time", "string")).alias("enqueued_time"),
        get("block_size", "bigint").alias("block_size"),
        get("block_vsize", "bigint").alias("block_vsize"),
        get("median_fee", "double").alias("median_fee"),
        get("n_tx", "int").alias("n_tx"),
        get("total_fees", "bigint").alias("total_fees"),
        *[get(c, "double").alias(c) for c in S.FEE_PERCENTILE_COLUMNS],
    ]


def typed_load(landing: DataFrame, text: str = "value") -> DataFrame:
    """Landing records as JSON text -> the 14 typed columns."""
    return landing.select(*typed_paths(F.try_parse_json(F.col(text))))


def variant_landing(landing: DataFrame, text: str = "value") -> DataFrame:
    """Landing records as one VARIANT column ``record`` (NULL where the text is
    not JSON): parsed once, when they land."""
    return landing.select(F.try_parse_json(F.col(text)).alias("record"))


def write_variant_landing(landing: DataFrame, path: str, text: str = "value") -> None:
    """Append landing records to a Parquet table with a VARIANT column.  Spark
    shreds it: fields that most records share become typed Parquet columns."""
    variant_landing(landing, text).write.mode("append").parquet(path)


def typed_load_variant(records: DataFrame, column: str = "record") -> DataFrame:
    """Stored VARIANT records -> the 14 typed columns.  The paths reach the scan,
    which reads the shredded columns of these fields and no JSON text."""
    return records.select(*typed_paths(F.col(column)))


def typed_columns(df: DataFrame) -> DataFrame:
    """The parsed table's columns, typed.  A time held as text is read in the
    capture format (or as a plain timestamp); a missing column is NULL."""
    kinds = dict(df.dtypes)

    def column(f):
        if f.name not in kinds:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if f.name == "enqueued_time" and kinds[f.name] == "string":
            return F.coalesce(parse_event_time(f.name), F.col(f.name).try_cast(f.dataType)).alias(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in S.PARSED.fields])


def load_parsed(spark: SparkSession, path: str, since=None, recursive: bool = False) -> DataFrame:
    """Replace-load of the staged ``*.parquet`` files with typed casts.

    ``since`` (a time) keeps the day partitions from that day on, so an
    incremental run opens no older file.  ``recursive`` reads any sub-folder,
    at the price of that pruning.  A folder without files is an empty table.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        df = reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], S.PARSED)
    if since is not None and "event_date" in df.columns:
        df = df.where(F.col("event_date") >= F.lit(since).cast("date"))
    return typed_columns(df)


def unread_times(df: DataFrame) -> DataFrame:
    """(n_rows, n_unread_times) of a load: rows whose time text gave no time."""
    text = F.col("enqueued_time").cast("string")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(
        text.isNotNull() & F.coalesce(parse_event_time(text), text.try_cast("timestamp_ntz")).isNull()
    ).alias("n_unread_times"))


# -- materialization and serving ------------------------------------------------------

def materialize(df: DataFrame, path: str, kind: str = "table", cluster_by: list[str] | None = None,
                partition_by: list[str] | None = None, files_per_partition: int | None = None) -> DataFrame:
    """Write a model.  ``table``: full overwrite, optionally range-clustered
    (``repartitionByRange`` + sort) so readers prune row groups by the
    cluster columns; ``view``: nothing is written."""
    if kind == "view":
        return df
    out = df
    if cluster_by:
        out = (out.repartitionByRange(files_per_partition, *cluster_by) if files_per_partition
               else out.repartitionByRange(*cluster_by)).sortWithinPartitions(*cluster_by)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def _versions(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(folder, finish time in ms) of the complete snapshot versions, oldest first."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        mark = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if status.getPath().getName().startswith("version=") and fs.exists(mark):
            found.append((status.getPath().toString(), fs.getFileStatus(mark).getModificationTime()))
    return sorted(found)


def export_snapshot(df: DataFrame, path: str, time_col: str, n: int = 500) -> DataFrame:
    """Newest ``n`` rows, lower-case names, to Parquet (a top-k: bounded).

    Each export is a new version folder; readers take the newest complete one,
    so a failing export leaves the old snapshot readable.  One earlier version
    is kept for readers that have it open.
    """
    from feeflow.operators.serving import top_newest

    spark = df.sparkSession
    top_newest(df, time_col, n).coalesce(1).write.parquet(f"{path}/version={time.time_ns():020d}-{uuid.uuid4().hex}")
    for old, _ in _versions(spark, path)[:-2]:
        fs, folder = file_system(spark, old)
        fs.delete(folder, True)
    return read_snapshot(spark, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a snapshot."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no snapshot at {path}")
    return spark.read.parquet(versions[-1][0])


CACHE_SECONDS = 60


def load_mart(spark: SparkSession, name: str, snapshot_path: str, time_col: str, n: int = 500,
              reuse_seconds: float = CACHE_SECONDS):
    """Read-through with fallback: (frame, source label).

    A snapshot younger than ``reuse_seconds`` is served as it is ("cached").
    Otherwise the live table refreshes the snapshot and that is served
    ("live"); if the live read fails, at analysis or at run time, the last
    complete snapshot is served ("snapshot"); without one the error is raised.
    """
    versions = _versions(spark, snapshot_path)
    if versions and time.time() * 1000 - versions[-1][1] < reuse_seconds * 1000:
        return read_snapshot(spark, snapshot_path), "cached"
    try:
        # serve the refreshed snapshot itself (n rows), not a recomputation
        return export_snapshot(spark.table(name), snapshot_path, time_col, n), "live"
    except (PySparkException, Py4JError) as live_error:
        try:
            return read_snapshot(spark, snapshot_path), "snapshot"
        except FileNotFoundError:
            raise RuntimeError(f"mart {name!r} unavailable and no snapshot: {live_error}") from live_error


def register_sources(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Name frames for SQL (source declarations)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
