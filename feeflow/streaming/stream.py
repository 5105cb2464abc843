"""Structured Streaming forms of ingest, dedup, marts and the alert feed.

The same column functions as the batch jobs; what differs is state:

* dedup: a message is one key, so the latest-per-key winner is its first
  block item; taking ``get(data, 0)`` before the explode gives it without
  a window (windows are refused on streams), and
  ``dropDuplicatesWithinWatermark`` drops replays of a message;
* marts: tumbling ``window`` + watermark.  A single aggregate refuses the exact
  distinct and the exact median on streams, so :func:`stream_mart` uses
  ``approx_count_distinct`` and ``percentile_approx``; :func:`exact_stream_mart`
  chains two aggregates, which makes the distinct counts exact, in append mode;
* incremental load: a file source with a checkpoint reads each landed
  file once; ``foreachBatch`` applies the keyed upsert, so even a replay
  changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import fee_percentile_columns, parse_event_time, surrogate_key
from feeflow.operators.features import features
from feeflow.operators.mart_state import hourly_outputs, merged_measures, minute_outputs, row_measures
from feeflow.operators.marts import (
    DAILY_AGGS,
    HOURLY_AGGS,
    MINUTE_AGGS,
    agg_expr,
    daily_alerts,
    hourly_alerts,
    minute_alerts,
    round_outputs,
)
from feeflow.operators.parse import (
    decode_body,
    explode_transactions,
    parse_messages,
    route_frames,
    split_corrupt,
)

GRAINS = {
    "minute": ("1 minute", "time_minute", MINUTE_AGGS, minute_alerts),
    "hour": ("1 hour", "time_hour", HOURLY_AGGS, hourly_alerts),
    "day": ("1 day", "mempool_date", DAILY_AGGS, daily_alerts),
}


def stream_capture(spark: SparkSession, path: str | None, fmt: str = "parquet", schema=S.CAPTURE,
                   max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Endless capture source: every file landing under ``path``.

    Other sources (e.g. ``kafka`` with its bootstrap/topic ``options``, when
    that package is present) go through ``fmt`` + ``options``; a source with
    its own schema is read without ``schema=None``.
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path) if path else r.load()


def parsed_stream(capture: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows of all blocks, quarantined messages) of a capture stream.

    The batch parse is narrow, so the same functions run on a stream.
    Quarantined are messages whose body is not JSON or whose time cannot be
    read: a row without a time has no window, and would vanish from a mart
    without a trace."""
    good, bad = split_corrupt(decode_body(capture))
    timed = parse_event_time("EnqueuedTimeUtc").isNotNull()
    return parse_messages(good.where(timed)), bad.unionByName(good.where(~timed))


def event_stream(frames: DataFrame, time_col: str = "enqueued_time") -> tuple[DataFrame, DataFrame]:
    """(routed events, transaction events) of a stream of live frames."""
    return route_frames(frames, time_col=time_col), explode_transactions(frames)


def dropped_late_rows(progresses: list) -> int:
    """Rows that the watermark dropped, from a query's progress reports
    (``query.recentProgress``): the sum over all stateful operators."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in progresses for op in
               (p["stateOperators"] if isinstance(p, dict) else p.stateOperators or []))


def first_block_rows(capture: DataFrame) -> DataFrame:
    """Captured messages -> one parsed row per message (its first block item,
    or the all-NULL row) - the row batch dedup would keep."""
    df = decode_body(capture)
    env = F.from_json(F.col("body_str"), S.BLOCKS_ENVELOPE)
    b = F.get(env["data"], 0)
    return df.select(
        F.col("SequenceNumber").cast("bigint").alias("sequence_number"),
        parse_event_time("EnqueuedTimeUtc").alias("enqueued_time"),
        F.when(b.isNotNull(), F.lit(0)).cast("int").alias("block_index"),
        b["blockSize"].cast("bigint").alias("block_size"),
        b["blockVSize"].try_cast("bigint").alias("block_vsize"),
        b["medianFee"].alias("median_fee"),
        b["nTx"].alias("n_tx"),
        b["totalFees"].alias("total_fees"),
        *fee_percentile_columns(b["feeRange"]),
    )


def stream_intermediate(capture: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Stream of intermediate rows: first block per message, keyed, replays
    dropped within the watermark, features added.  ``event_ts`` is the
    TIMESTAMP copy of ``enqueued_time`` that watermarks require."""
    rows = first_block_rows(capture)
    staged = rows.select(
        surrogate_key(rows, "sequence_number", "enqueued_time").alias("mempool_id"),
        "sequence_number", "enqueued_time", "block_size", "block_vsize", "median_fee",
        F.col("n_tx").alias("number_of_transactions"), "total_fees", *S.FEE_PERCENTILE_COLUMNS,
    )
    inter = features(staged).withColumn("event_ts", F.col("enqueued_time").cast("timestamp"))
    return inter.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["mempool_id"])


def stream_mart(inter: DataFrame, grain: str = "minute", delay: str | None = None,
                precision: int | None = None) -> DataFrame:
    """Tumbling-window mart over a stream of intermediate rows.

    ``delay`` sets the watermark when the input has none yet (the output of
    :func:`stream_intermediate` already carries one; a stream may define it
    once)."""
    width, time_name, spec, alerts = GRAINS[grain]
    keys = [F.window("event_ts", width).alias("w")]
    if grain != "day":
        keys.append(F.col("network_congestion_status"))
    aggs = [agg_expr(kind, col, distinct="approx", median="approx").alias(name) for name, kind, col in spec]
    src = inter.withWatermark("event_ts", delay) if delay else inter
    out = src.groupBy(*keys).agg(*aggs, *alerts())
    out = out.select(F.col("w.start").cast("timestamp_ntz").alias(time_name), *[c for c in out.columns if c != "w"])
    return round_outputs(out, spec, precision)


EXACT_GRAINS = {
    "minute": ("1 minute", "time_minute", minute_outputs),
    "hour": ("1 hour", "time_hour", hourly_outputs),
}


def exact_stream_mart(inter: DataFrame, grain: str = "minute", precision: int | None = None) -> DataFrame:
    """The minute or hour mart of a stream, in append mode, all columns exact.

    Two chained aggregates: the mergeable measures per window, status and
    sequence number, then per window and status, where each number counts once.
    A window is written once, when the watermark has passed its end, and then
    leaves the state; rows behind the watermark are dropped and counted
    (:func:`dropped_late_rows`).  ``inter`` carries the watermark
    (:func:`stream_intermediate`).
    """
    width, time_name, outputs = EXACT_GRAINS[grain]
    status = "network_congestion_status"
    per_number = inter.groupBy(F.window("event_ts", width).alias("w"), status, "sequence_number").agg(*row_measures())
    merged = per_number.groupBy("w", status).agg(
        *merged_measures(), F.count("sequence_number").alias("blocks"))
    return outputs(merged.withColumn(time_name, F.col("w.start").cast("timestamp_ntz")), precision)


def append_by_day(df: DataFrame, path: str, checkpoint: str, time_col: str):
    """Drain everything available, in append mode, into a Parquet table
    partitioned by day: closed windows are added, none is rewritten."""
    q = (df.withColumn("event_date", F.to_date(time_col)).writeStream.outputMode("append").format("parquet")
         .partitionBy("event_date").option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def alert_filter(minute: DataFrame) -> DataFrame:
    """Minute rows with at least one alert that is not NORMAL (stateless:
    the same function serves the batch mart and the streaming feed)."""
    hot = ((F.col("fee_spike_alert") != S.NORMAL) | (F.col("fee_skewness_alert") != S.NORMAL)
           | (F.col("congestion_alert") != S.NORMAL))
    return minute.where(hot).select(
        "time_minute", "network_congestion_status", "fee_spike_alert", "fee_skewness_alert", "congestion_alert",
        "peak_fee_p99", "max_fee_skewness_ratio", "total_transactions",
    )


def alert_feed(capture: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Streaming alert feed: capture -> minute mart -> non-NORMAL rows
    (run with output mode ``update`` to see rows before the mark passes)."""
    return alert_filter(stream_mart(stream_intermediate(capture, delay), "minute"))


def run_available(df: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Drain everything available into a memory table (tests, backfills)."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_to_table(df: DataFrame, path: str, checkpoint: str):
    """Drain everything available into a Parquet table (complete mode: each
    trigger replaces the table with the whole result)."""
    q = (df.writeStream.outputMode("complete")
         .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def load_parsed_incremental(spark: SparkSession, landing_path: str, target_path: str, checkpoint: str,
                            schema=S.PARSED):
    """Incremental typed load: each landed Parquet file once, keyed upsert
    into the day-partitioned staging table (replay-safe)."""
    from feeflow.operators.staging import stage, upsert

    src = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "*.parquet").load(landing_path)

    def apply(batch: DataFrame, _epoch: int) -> None:
        upsert(spark, target_path, stage(batch, keep_block_index=True), "mempool_id")

    q = (src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
