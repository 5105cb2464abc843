"""Staging bucketed and sorted by its key, for merges without a shuffle of it.

The table lies in day folders, and within a day its rows are dealt to a fixed
number of buckets by the key's hash, each sorted.  An upsert reads the touched
days; the scan already has the partitioning and order that a join by key needs,
so only the batch is shuffled, to the same buckets.  A key keeps its day, as it
contains the time.

Spark knows buckets from its catalog, not from the files: a table is declared
over its folder (:func:`declare`), in whatever session reads it.  Each merge
writes the touched days beside the table and moves nothing until they are
complete; the days then replace the old ones by dynamic partition overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.operators.staging import dedup_columns, latest_per_key
from feeflow.session import materialize_shared

KEY, DAY = "mempool_id", "event_date"
BUCKETS = 64     # per day; a day of 100 GB is 1.6 GB a bucket


def declare(spark: SparkSession, name: str, path: str, schema, buckets: int = BUCKETS, key: str = KEY) -> DataFrame:
    """(Re)declare the table over ``path`` and return it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")   # external: the files stay
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{DAY}`) "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int = BUCKETS, key: str = KEY,
                   time_col: str = "enqueued_time") -> DataFrame:
    """Create the table ``name`` at ``path`` from the latest row per key."""
    spark = df.sparkSession
    rows = latest_per_key(df.withColumn(DAY, F.to_date(time_col)), key)
    # one file per bucket and day: rows meet by bucket before the write
    (_by_bucket(rows, buckets, key).write.mode("overwrite").option("path", path).partitionBy(DAY)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def _by_bucket(rows: DataFrame, buckets: int, key: str) -> DataFrame:
    return rows.repartition(buckets, F.col(key))


def merged_with(target: DataFrame, batch: DataFrame, key: str = KEY,
                time_col: str = "enqueued_time") -> DataFrame:
    """Target and batch rows, the better one per key by the order of a full
    refresh.  ``target`` has one row per key and lies by the key; only the batch
    moves."""
    columns = target.columns
    order = [time_col, *dedup_columns(columns)]
    best = latest_per_key(batch.select(*columns), key)
    t, b = target.alias("t"), best.alias("b")
    joined = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    # newest first, then the smallest values, nulls last in both
    worse = F.lit(False)
    for name in reversed(order):
        old, new = F.col(f"t.{name}"), F.col(f"b.{name}")
        new_first = (new > old) if name == time_col else (new < old)
        worse = F.when(old.eqNullSafe(new), worse).when(old.isNull(), True).when(new.isNull(), False).otherwise(new_first)
    take = F.col(f"t.{key}").isNull() | (F.col(f"b.{key}").isNotNull() & worse)
    return joined.select(*[F.when(take, F.col(f"b.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in columns])


def upsert_bucketed(spark: SparkSession, name: str, batch: DataFrame, buckets: int = BUCKETS, key: str = KEY,
                    time_col: str = "enqueued_time") -> int:
    """Merge ``batch`` into the table by key; the number of touched days.  Other
    days are neither read nor written; a replay changes nothing."""
    batch = materialize_shared(batch.withColumn(DAY, F.to_date(time_col)), "bucketed-batch")
    days = [r[0] for r in batch.select(DAY).distinct().collect()]   # one value a day
    target = spark.table(name)
    in_days = F.col(DAY).isin([d for d in days if d is not None])
    touched = target.where(in_days | F.col(DAY).isNull() if None in days else in_days)
    merged = materialize_shared(merged_with(touched, batch, key, time_col), "bucketed-merge")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _by_bucket(merged, buckets, key).select(*target.columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return len(days)
