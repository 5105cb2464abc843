"""Typed staging, surrogate key, high-water mark, latest-per-key, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import surrogate_key


def stage(parsed: DataFrame, keep_block_index: bool = True) -> DataFrame:
    """Parsed rows -> staging: key + 14 typed columns (n_tx renamed).

    ``block_index`` is carried (last) as the deterministic dedup tie-break.
    """
    cols = [
        surrogate_key(parsed, "sequence_number", "enqueued_time").alias("mempool_id"),
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
        F.col("enqueued_time").cast("timestamp_ntz").alias("enqueued_time"),
        F.col("block_size").cast("bigint").alias("block_size"),
        F.col("block_vsize").cast("bigint").alias("block_vsize"),
        F.col("median_fee").cast("double").alias("median_fee"),
        F.col("n_tx").cast("int").alias("number_of_transactions"),
        F.col("total_fees").cast("bigint").alias("total_fees"),
    ] + [F.col(c).cast("double").alias(c) for c in S.FEE_PERCENTILE_COLUMNS]
    if keep_block_index and "block_index" in parsed.columns:
        cols.append(F.col("block_index").cast("int").alias("block_index"))
    return parsed.select(*cols)


def high_water_mark(spark: SparkSession, target: DataFrame | None, col: str = "enqueued_time"):
    """``max(col)`` of the target as one driver-side scalar (None if empty)."""
    if target is None:
        return None
    row = target.agg(F.max(col).alias("m")).first()
    return row["m"] if row else None


def table_high_water_mark(spark: SparkSession, path: str, col: str = "enqueued_time",
                          partition_col: str = "event_date"):
    """High-water mark of a day-partitioned table, reading one partition.

    The newest day is the greatest partition folder's name: one listing of the
    table's root, of as many names as days, whatever the number of files.
    Only that partition's ``col`` is scanned for the maximum.  None for a
    missing or empty table (full load).
    """
    from feeflow.session import file_system
    from feeflow.sources.sinks import table_exists

    if not table_exists(spark, path):
        return None
    df = spark.read.parquet(path)
    fs, root = file_system(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    null_dir = "__HIVE_DEFAULT_PARTITION__"  # rows without a time: never the newest day
    days = sorted(n.split("=", 1)[1] for n in names
                  if n.startswith(f"{partition_col}=") and not n.endswith(null_dir))
    if not days:
        return high_water_mark(spark, df, col)
    newest = df.where(F.col(partition_col) == F.lit(days[-1]).cast(df.schema[partition_col].dataType))
    return high_water_mark(spark, newest, col)


def incremental_slice(
    src: DataFrame,
    target: DataFrame | None,
    col: str = "enqueued_time",
    lookback_seconds: int = 0,
    mark=None,
) -> DataFrame:
    """Rows newer than the target's high-water mark.

    The mark is read once and passed as a literal, so the comparison reaches
    the Parquet scan as a pushed filter.  An empty or absent target (NULL
    mark) means a full load.  ``lookback_seconds`` re-reads an overlap; the
    keyed upsert makes the overlap harmless.
    """
    if mark is None and target is not None:
        mark = high_water_mark(src.sparkSession, target, col)
    if mark is None:
        return src
    bound = F.lit(mark).cast(src.schema[col].dataType)
    if lookback_seconds:
        bound = F.timestamp_add("SECOND", F.lit(-int(lookback_seconds)), bound)
        return src.where(F.col(col) >= bound)
    return src.where(F.col(col) > bound)


def dedup_columns(columns: list[str]) -> list[str]:
    """The value columns that break ties of a key, in order."""
    values = ("block_index", "block_size", "total_fees", "median_fee", "block_vsize",
              "number_of_transactions", *S.FEE_PERCENTILE_COLUMNS)
    return [c for c in values if c in columns]


def dedup_order(df: DataFrame, time_col: str = "enqueued_time") -> list:
    """Newest first, then lowest block position, then every value column: only
    rows equal in all of them tie, and those are interchangeable."""
    return [F.col(time_col).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in dedup_columns(df.columns)]


def latest_per_key(df: DataFrame, key: str = "mempool_id", order: list | None = None) -> DataFrame:
    """``row_number() over (partition by key order by ...) = 1``.

    Catalyst plans a partial ``WindowGroupLimit`` before the shuffle and a
    final one after it, so each map task forwards at most one row per key:
    a key that holds a third of all rows still costs one row per task.
    """
    w = Window.partitionBy(key).orderBy(*(order or dedup_order(df)))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def merge_rows(target: DataFrame, batch: DataFrame, key: str = "mempool_id") -> DataFrame:
    """Logical upsert: the best row per key of target and batch together, by
    the order of a full refresh, so the result does not depend on how the rows
    were split into loads."""
    return latest_per_key(target.unionByName(batch.select(*target.columns)), key)


def upsert(
    spark: SparkSession,
    target_path: str,
    batch: DataFrame,
    key: str = "mempool_id",
    partition_col: str = "event_date",
    time_col: str = "enqueued_time",
) -> int:
    """Keyed upsert into a day-partitioned Parquet table; replay-safe.

    Only the day partitions the batch touches are read and rewritten
    (dynamic partition overwrite).  A key never changes day, because the
    key contains the time.  The merged rows are first written to the shared
    ``spark.checkpoint.dir`` (computed once), so the overwrite never reads
    the files it replaces and a lost executor re-reads that copy, not the
    half-written table.  Returns the number of touched days.
    """
    from feeflow.session import file_system, materialize_shared
    from feeflow.sources.sinks import table_exists

    batch = batch.withColumn(partition_col, F.to_date(F.col(time_col)))
    if not table_exists(spark, target_path):
        latest_per_key(batch, key).write.mode("overwrite").partitionBy(partition_col).parquet(target_path)
        fs, root = file_system(spark, target_path)
        return sum(s.getPath().getName().startswith(f"{partition_col}=") for s in fs.listStatus(root))
    batch = materialize_shared(batch, "upsert-batch")  # read twice: its days, then its rows
    target = spark.read.parquet(target_path)
    # The batch's days (a short list: one value per day the batch spans) go
    # back as literals, so the target scan prunes to those partitions at
    # plan time instead of reading the whole table for a semi-join.
    days = [r[0] for r in batch.select(partition_col).distinct().collect()]
    part = F.col(partition_col)
    in_days = part.isin([d for d in days if d is not None])
    touched = target.where(in_days | part.isNull() if None in days else in_days)
    merged = materialize_shared(merge_rows(touched, batch.select(*target.columns), key), "upsert")
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(target_path)
    )
    return len(days)


def drop_exact_duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Structural dedup (hash aggregate on the listed columns, map-side first)."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def fill_defaults(df: DataFrame, values: dict) -> DataFrame:
    """Opt-in fill of missing payload values (changes NULL-row semantics)."""
    return df.fillna(values)
