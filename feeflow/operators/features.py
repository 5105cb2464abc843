"""Intermediate model: pass-through columns plus seven derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import congestion_status, safe_ratio
from feeflow.operators.staging import latest_per_key


def feature_columns() -> list:
    return [
        (F.col("fee_p99") - F.col("fee_p10")).alias("fee_spread_range"),
        (F.col("fee_p75") - F.col("fee_p25")).alias("interquartile_fee_range"),
        # NULL (not 0) when p10 is not positive; the guard also keeps ANSI
        # division by zero from failing the job.
        safe_ratio("fee_p99", "fee_p10", otherwise=None).alias("fee_skewness_ratio"),
        # 0 when the denominator is missing or not positive.
        safe_ratio("block_vsize", "block_size").alias("block_compression_ratio"),
        safe_ratio("total_fees", "block_size").alias("miner_revenue_per_byte"),
        safe_ratio("total_fees", "number_of_transactions").alias("avg_fee_per_tx"),
        congestion_status("median_fee").alias("network_congestion_status"),
    ]


def features(staged: DataFrame) -> DataFrame:
    """Staging rows (already one per key) -> 22 intermediate columns."""
    passthrough = [c for c in S.INTERMEDIATE_COLUMNS if c not in S.FEATURE_COLUMNS]
    return staged.select(*passthrough, *feature_columns())


def intermediate(staged: DataFrame, key: str = "mempool_id") -> DataFrame:
    """Latest row per key, then features (the intermediate model)."""
    return features(latest_per_key(staged, key))
