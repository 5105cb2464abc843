"""Serving queries that dashboards read from the marts.

Every function returns a lazy DataFrame; only final, bounded results
(a top-k, one newest row) are ever collected by callers.  Newest-row and
top-k selection plan as ``TakeOrderedAndProject`` (each task keeps k rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import (
    first_nonzero_sql,
    lower_columns,
    status_class_sql,
)

HOUR_TIME = "time_hour"
MINUTE_TIME = "time_minute"
STATUS = "network_congestion_status"


def newest_first(df: DataFrame, time_col: str) -> list:
    """Newest first; ties (several statuses per bucket) broken by status."""
    order = [F.col(time_col).desc_nulls_last()]
    if STATUS in df.columns:
        order.append(F.col(STATUS).asc_nulls_last())
    return order


def top_newest(df: DataFrame, time_col: str, n: int = 500) -> DataFrame:
    """The newest ``n`` mart rows with lower-case names (serving snapshot)."""
    return lower_columns(df.orderBy(*newest_first(df, time_col)).limit(n))


def latest_row(df: DataFrame, time_col: str) -> DataFrame:
    return df.orderBy(*newest_first(df, time_col)).limit(1)


def ascending(df: DataFrame, time_col: str) -> DataFrame:
    """Series in time order for charts (a range-partitioned global sort;
    series are one row per bucket, so this sorts mart-sized data)."""
    order = [F.col(time_col).asc_nulls_last()]
    if STATUS in df.columns:
        order.append(F.col(STATUS).asc_nulls_last())
    return df.orderBy(*order)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows (no order); for eyeballing only."""
    return df.limit(n)


def kpi_hourly(hourly: DataFrame) -> DataFrame:
    """KPI row of the newest hour: 3 statuses, 6 volume, 7 fee, 5 whale figures.

    Values read the real mart columns first; zero counts as missing, as
    the dashboard does (average = total / blocks, maximum = total when 0).
    Built as SQL expressions: one JVM call per figure keeps the lookup cheap.
    """
    nz = first_nonzero_sql
    tot, blocks = nz("total_transactions", default="0"), nz("total_blocks", default="1")
    avg, mx = nz("avg_transactions_per_block", default="0"), nz("max_transactions_in_block", default="0")
    return latest_row(hourly, HOUR_TIME).selectExpr(
        f"`{HOUR_TIME}`",
        f"`{STATUS}` AS congestion_status",
        "hourly_fee_alert AS fee_alert",
        "hourly_skewness_alert AS skewness_alert",
        f"CAST({tot} AS BIGINT) AS total_transactions",
        f"CAST({blocks} AS BIGINT) AS total_blocks",
        f"CAST(CASE WHEN {avg} = 0 AND {blocks} > 0 THEN ({tot}) / ({blocks}) "
        f"ELSE {avg} END AS DOUBLE) AS avg_tx_per_block",
        f"CAST(CASE WHEN {mx} = 0 THEN {tot} ELSE {mx} END AS BIGINT) AS max_tx_per_block",
        f"{nz('total_block_size', default='0')} / 1000000.0D AS total_block_size_mb",
        f"CAST({nz('avg_block_vsize')} AS DOUBLE) AS avg_block_vsize",
        f"{nz('avg_fee_p10')} AS p10_fee",
        f"{nz('avg_fee_p25')} AS p25_fee",
        f"{nz('avg_fee_p50', 'avg_median_fee')} AS p50_fee",
        f"{nz('avg_fee_p75')} AS p75_fee",
        f"{nz('avg_fee_p90')} AS p90_fee",
        f"{nz('avg_fee_p95')} AS p95_fee",
        f"{nz('avg_fee_p99', 'max_fee_p99_hourly')} AS p99_fee",
        f"{nz('avg_fee_spread')} AS avg_fee_spread",
        f"{nz('avg_iqr_fee')} AS iqr_fee",
        f"{nz('avg_fee_skewness')} AS fee_skewness",
        f"{nz('avg_miner_revenue_per_byte')} AS miner_revenue_ratio",
        f"{nz('avg_block_compression')} AS block_compactness",
        f"{status_class_sql(STATUS)} AS congestion_class",
        f"{status_class_sql('hourly_fee_alert')} AS fee_alert_class",
        f"{status_class_sql('hourly_skewness_alert')} AS skewness_alert_class",
    )


def kpi_minute(minute: DataFrame) -> DataFrame:
    """KPI row of the newest minute: 4 statuses and 5 fee figures."""
    nz = first_nonzero_sql
    return latest_row(minute, MINUTE_TIME).selectExpr(
        f"`{MINUTE_TIME}`",
        "fee_spike_alert",
        "fee_skewness_alert",
        "congestion_alert",
        f"`{STATUS}` AS congestion_status",
        f"{nz('avg_fee_p10')} AS p10_fee",
        f"{nz('avg_fee_p50', 'avg_median_fee')} AS p50_fee",
        f"{nz('avg_fee_p90')} AS p90_fee",
        f"{nz('avg_fee_p99')} AS p99_fee",
        f"{nz('peak_fee_p99')} AS peak_p99_fee",
        f"{status_class_sql('fee_spike_alert')} AS spike_class",
        f"{status_class_sql('fee_skewness_alert')} AS whale_class",
        f"{status_class_sql('congestion_alert')} AS congestion_alert_class",
    )


def fee_series(hourly: DataFrame, long: bool = True) -> DataFrame:
    """Hourly fee percentile series (p10, p50, p90, p99), long form by ``unpivot``."""
    cols = ["avg_fee_p10", "avg_fee_p50", "avg_fee_p90", "avg_fee_p99"]
    wide = hourly.select(HOUR_TIME, STATUS, *cols)
    if not long:
        return wide
    return wide.unpivot([HOUR_TIME, STATUS], cols, "percentile", "fee")


def throughput_pivot(hourly: DataFrame) -> DataFrame:
    """Transactions per hour, one column per congestion class (fixed list, so
    the pivot needs no extra distinct job)."""
    names = {S.HIGH: "high_tx", S.MODERATE: "moderate_tx", S.LOW: "low_tx"}
    p = hourly.groupBy(HOUR_TIME).pivot(STATUS, list(S.CONGESTION_LABELS)).agg(
        F.sum("total_transactions").cast("bigint")
    )
    return p.select(HOUR_TIME, *[F.col(f"`{k}`").alias(v) for k, v in names.items()])


def fees_series(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(HOUR_TIME).agg(F.sum("total_fees_collected").cast("bigint").alias("total_fees_collected"))


def spike_series(minute: DataFrame) -> DataFrame:
    return minute.select(MINUTE_TIME, STATUS, "peak_fee_p99")


def whale_points(minute: DataFrame, only_alerts: bool = True) -> DataFrame:
    pts = minute.select(MINUTE_TIME, STATUS, "max_fee_skewness_ratio", "fee_skewness_alert")
    return pts.where(F.col("fee_skewness_alert") != S.NORMAL) if only_alerts else pts


def context_record(hourly: DataFrame, minute: DataFrame, as_json: bool = False) -> DataFrame:
    """Newest hour and newest minute as one record of 8 named figures.

    Both sides are single rows; they are combined by a global ``first``
    aggregate over a two-row union (no join needed).
    """
    h = latest_row(hourly, HOUR_TIME).select(
        F.struct(
            F.col(STATUS).alias("network_congestion"),
            F.col("total_transactions"),
            F.col("avg_fee_p50"),
            F.col("avg_fee_p99"),
            F.col("hourly_fee_alert"),
        ).alias("h"),
        F.lit(None).cast("struct<fee_spike_alert:string,peak_fee_p99:double,fee_skewness_alert:string>").alias("m"),
    )
    m = latest_row(minute, MINUTE_TIME).select(
        F.lit(None).cast(h.schema["h"].dataType).alias("h"),
        F.struct(F.col("fee_spike_alert"), F.col("peak_fee_p99"), F.col("fee_skewness_alert")).alias("m"),
    )
    both = h.unionByName(m).agg(F.first("h", ignorenulls=True).alias("h"), F.first("m", ignorenulls=True).alias("m"))
    out = both.select("h.*", F.col("m.fee_spike_alert").alias("minute_fee_spike_alert"),
                      F.col("m.peak_fee_p99").alias("minute_peak_fee_p99"),
                      F.col("m.fee_skewness_alert").alias("minute_whale_alert"))
    if as_json:
        return out.select(F.to_json(F.struct(*out.columns)).alias("context"))
    return out


def daily_fee_spread(daily: DataFrame) -> DataFrame:
    return daily.select("mempool_date", "daily_min_p10_fee", "daily_max_p99_fee", "daily_avg_median_fee")


def daily_revenue(daily: DataFrame) -> DataFrame:
    return daily.select("mempool_date", "daily_total_miner_revenue", "daily_overall_median_fee")


def daily_efficiency(daily: DataFrame) -> DataFrame:
    return daily.select("mempool_date", "daily_avg_compression_ratio", "daily_avg_fee_skewness")


def efficiency_correlation(daily: DataFrame) -> DataFrame:
    return daily.agg(F.corr("daily_avg_compression_ratio", "daily_avg_fee_skewness").alias("corr"))
