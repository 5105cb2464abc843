"""Declared schemas, labels and thresholds.

Schemas are declared, never sampled from one record, so every payload
type parses the same way in batch and stream jobs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the modelled system's labels and limits for
# results to agree.  Natural order, as the models state them.
# ---------------------------------------------------------------------------
HIGH = "High Congestion"
MODERATE = "Moderate Congestion"
LOW = "Low Congestion"
CONGESTION_LABELS = (HIGH, MODERATE, LOW)
CONGESTION_HIGH_ABOVE = 50        # median fee > 50            -> High
CONGESTION_MODERATE_FROM = 20     # median fee between 20 and 50 -> Moderate

DAILY_STRESS_ALERT = "ALERT: Network Stress Day"
DAILY_STRESS_HIGH_BLOCKS = 20     # more than 20 High rows in a day
DAILY_VOLATILITY_ALERT = "ALERT: Severe Fee Volatility Day"
DAILY_VOLATILITY_P99 = 300        # max p99 above 300
NORMAL = "NORMAL"
STABLE = "STABLE"

HOURLY_FEE_CRITICAL = "CRITICAL: Hourly Network Congestion"
HOURLY_FEE_WARNING = "WARNING: Elevated Fees"
HEALTHY = "HEALTHY"
HOURLY_FEE_CRITICAL_ABOVE = 50    # avg median fee > 50
HOURLY_FEE_WARNING_FROM = 20      # avg median fee between 20 and 50
HOURLY_SKEW_ALERT = "ALERT: Extreme Fee Distortion"
HOURLY_SKEW_ABOVE = 35            # max skewness > 35

MINUTE_SPIKE_CRITICAL = "CRITICAL: High Fee Spike"
MINUTE_SPIKE_WARNING = "WARNING: Moderate Fee Spike"
MINUTE_SPIKE_CRITICAL_ABOVE = 100  # max p99 > 100
MINUTE_SPIKE_WARNING_ABOVE = 50    # max p99 > 50
MINUTE_WHALE_ALERT = "ALERT: Whale Fee Outlier"
MINUTE_WHALE_ABOVE = 100           # max skewness > 100
MINUTE_CONGESTION_ALERT = "ALERT: High Mempool Congestion"
MINUTE_CONGESTION_TX_ABOVE = 150000  # sum of transactions > 150000

# Status words the dashboard paints as "normal" (upper-cased substring test).
NORMAL_STATUS_WORDS = ("NORMAL", "HEALTHY", "LOW")

# Fee-range positions -> percentile column names.
FEE_PERCENTILE_COLUMNS = ("fee_p10", "fee_p25", "fee_p50", "fee_p75", "fee_p90", "fee_p95", "fee_p99")

# Payload types of the typed event envelope.
BLOCK_EVENT = "block_event"
MEMPOOL_BLOCKS_EVENT = "mempool_blocks_event"
STATS_EVENT = "stats_event"
MEMPOOL_TX = "mempool_tx"

# Frame keys -> payload types, in routing order.
FRAME_ROUTES = (
    ("block", BLOCK_EVENT),
    ("mempool-blocks", MEMPOOL_BLOCKS_EVENT),
    ("stats", STATS_EVENT),
)

# Capture time text format ("9/4/2026 1:02:03 PM"); single letters accept
# both padded and unpadded fields.
CAPTURE_TIME_FORMAT = "M/d/yyyy h:mm:ss a"

# Token that stands for NULL inside the surrogate-key text (keeps NULL != '').
SURROGATE_NULL_TOKEN = "<null>"
# ---------------------------------------------------------------------------

BLOCK_ITEM = T.StructType(
    [
        T.StructField("blockSize", T.LongType()),
        T.StructField("blockVSize", T.DoubleType()),
        T.StructField("nTx", T.IntegerType()),
        T.StructField("totalFees", T.LongType()),
        T.StructField("medianFee", T.DoubleType()),
        T.StructField("feeRange", T.ArrayType(T.DoubleType())),
    ]
)

# Envelope of a blocks event; ``data`` is the array of projected blocks.
BLOCKS_ENVELOPE = T.StructType(
    [
        T.StructField("payload_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("data", T.ArrayType(BLOCK_ITEM)),
    ]
)

TX_ITEM = T.StructType(
    [
        T.StructField("txid", T.StringType()),
        T.StructField("fee", T.LongType()),
        T.StructField("vsize", T.DoubleType()),
        T.StructField("value", T.LongType()),
        T.StructField("rate", T.DoubleType()),
    ]
)

TX_EVENT = T.StructType([T.StructField("payload_type", T.StringType())] + TX_ITEM.fields)

# A live frame: any subset of four keys.  Objects are kept as JSON text so
# the router can pass them on unchanged.
FRAME = T.StructType(
    [
        T.StructField("block", T.StringType()),
        T.StructField("mempool-blocks", T.StringType()),
        T.StructField("stats", T.StringType()),
        T.StructField("transactions", T.ArrayType(TX_ITEM)),
    ]
)

CAPTURE = T.StructType(
    [
        T.StructField("SequenceNumber", T.LongType()),
        T.StructField("EnqueuedTimeUtc", T.StringType()),
        T.StructField("Body", T.BinaryType()),
    ]
)

# Flat parsed row (14 columns of the parsed table plus our block_index).
PARSED = T.StructType(
    [
        T.StructField("sequence_number", T.LongType()),
        T.StructField("enqueued_time", T.TimestampNTZType()),
        T.StructField("block_index", T.IntegerType()),
        T.StructField("block_size", T.LongType()),
        T.StructField("block_vsize", T.LongType()),
        T.StructField("median_fee", T.DoubleType()),
        T.StructField("n_tx", T.IntegerType()),
        T.StructField("total_fees", T.LongType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in FEE_PERCENTILE_COLUMNS]
)

STAGING_COLUMNS = (
    "mempool_id",
    "sequence_number",
    "enqueued_time",
    "block_size",
    "block_vsize",
    "median_fee",
    "number_of_transactions",
    "total_fees",
) + FEE_PERCENTILE_COLUMNS

FEATURE_COLUMNS = (
    "fee_spread_range",
    "interquartile_fee_range",
    "fee_skewness_ratio",
    "block_compression_ratio",
    "miner_revenue_per_byte",
    "avg_fee_per_tx",
    "network_congestion_status",
)

INTERMEDIATE_COLUMNS = (
    "mempool_id",
    "sequence_number",
    "enqueued_time",
    "block_size",
    "block_vsize",
    "number_of_transactions",
    "total_fees",
    "median_fee",
) + FEE_PERCENTILE_COLUMNS + FEATURE_COLUMNS
