"""Daily, hourly and minute marts, plus the report aggregates.

One aggregate list per mart, shared by batch and stream jobs.  Every mart
is a single partial+final hash aggregate (the one exact distinct column is
planned without an Expand); the exact daily median runs as the
distributed :func:`exact_quantiles` and joins back on the day.

Numeric conventions: sums of integer columns are BIGINT; averages are summed
exactly, so they do not depend on the partitioning, and nothing is rounded
unless ``precision`` is given (comparisons between engines).  Alert
conditions compare the same averages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import exact_avg_sql, round_sql, round_to, time_bucket
from feeflow.operators.quantiles import _ns_join, exact_quantiles

# (output name, aggregate kind, input column) per mart, in output order.
DAILY_AGGS = [
    ("total_blocks_processed", "count_distinct", "sequence_number"),
    ("total_daily_transactions", "sum", "number_of_transactions"),
    ("avg_tx_per_block", "avg", "number_of_transactions"),
    ("max_tx_in_single_block", "max", "number_of_transactions"),
    ("total_daily_bytes", "sum", "block_size"),
    ("avg_daily_block_size", "avg", "block_size"),
    ("total_daily_vbytes", "sum", "block_vsize"),
    ("daily_total_miner_revenue", "sum", "total_fees"),
    ("daily_avg_block_fees", "avg", "total_fees"),
    ("max_single_block_fee", "max", "total_fees"),
    ("daily_avg_median_fee", "avg", "median_fee"),
    ("daily_overall_median_fee", "median", "median_fee"),
    ("daily_min_p10_fee", "min", "fee_p10"),
    ("daily_max_p99_fee", "max", "fee_p99"),
    ("daily_avg_fee_spread", "avg", "fee_spread_range"),
    ("daily_avg_fee_skewness", "avg", "fee_skewness_ratio"),
    ("daily_avg_compression_ratio", "avg", "block_compression_ratio"),
    ("daily_avg_revenue_per_byte", "avg", "miner_revenue_per_byte"),
    ("daily_avg_fee_per_tx", "avg", "avg_fee_per_tx"),
    ("high_congestion_blocks", "count_status", S.HIGH),
    ("moderate_congestion_blocks", "count_status", S.MODERATE),
    ("low_congestion_blocks", "count_status", S.LOW),
]

_BLOCK_AGGS = [
    ("total_blocks", "count_distinct", "sequence_number"),
    ("total_transactions", "sum", "number_of_transactions"),
    ("avg_transactions_per_block", "avg", "number_of_transactions"),
    ("max_transactions_in_block", "max", "number_of_transactions"),
]

HOURLY_AGGS = _BLOCK_AGGS + [
    ("total_block_size", "sum", "block_size"),
    ("avg_block_size", "avg", "block_size"),
    ("total_block_vsize", "sum", "block_vsize"),
    ("avg_block_vsize", "avg", "block_vsize"),
    ("total_fees_collected", "sum", "total_fees"),
    ("avg_fees_per_block", "avg", "total_fees"),
    ("peak_block_fee", "max", "total_fees"),
    ("avg_median_fee", "avg", "median_fee"),
    ("max_median_fee", "max", "median_fee"),
] + [(f"avg_{c}", "avg", c) for c in S.FEE_PERCENTILE_COLUMNS] + [
    ("max_fee_p99_hourly", "max", "fee_p99"),
    ("avg_fee_spread", "avg", "fee_spread_range"),
    ("max_fee_spread", "max", "fee_spread_range"),
    ("avg_iqr_fee", "avg", "interquartile_fee_range"),
    ("avg_fee_skewness", "avg", "fee_skewness_ratio"),
    ("max_fee_skewness", "max", "fee_skewness_ratio"),
    ("avg_block_compression", "avg", "block_compression_ratio"),
    ("avg_miner_revenue_per_byte", "avg", "miner_revenue_per_byte"),
    ("avg_fee_per_tx", "avg", "avg_fee_per_tx"),
    ("max_fee_per_tx", "max", "avg_fee_per_tx"),
]

MINUTE_AGGS = _BLOCK_AGGS + [
    ("total_block_bytes", "sum", "block_size"),
    ("avg_block_size", "avg", "block_size"),
    ("total_block_vsize", "sum", "block_vsize"),
    ("avg_block_vsize", "avg", "block_vsize"),
    ("total_fees", "sum", "total_fees"),
    ("avg_block_fees", "avg", "total_fees"),
    ("max_block_fees", "max", "total_fees"),
    ("avg_median_fee", "avg", "median_fee"),
    ("max_median_fee", "max", "median_fee"),
] + [(f"avg_{c}", "avg", c) for c in S.FEE_PERCENTILE_COLUMNS] + [
    ("peak_fee_p99", "max", "fee_p99"),
    ("avg_fee_spread_range", "avg", "fee_spread_range"),
    ("max_fee_spread_range", "max", "fee_spread_range"),
    ("avg_interquartile_fee_range", "avg", "interquartile_fee_range"),
    ("avg_fee_skewness_ratio", "avg", "fee_skewness_ratio"),
    ("max_fee_skewness_ratio", "max", "fee_skewness_ratio"),
    ("avg_block_compression_ratio", "avg", "block_compression_ratio"),
    ("avg_miner_revenue_per_byte", "avg", "miner_revenue_per_byte"),
    ("avg_fee_per_tx", "avg", "avg_fee_per_tx"),
    ("max_fee_per_tx", "max", "avg_fee_per_tx"),
]


def _sql_rounded(expr: str, precision: int | None) -> Column:
    """A SQL expression, rounded to ``precision`` (one JVM call)."""
    return F.expr(round_sql(expr, precision) if precision is not None else expr)


def _count_status(label: str) -> Column:
    return F.count(F.when(F.col("network_congestion_status") == F.lit(label), F.lit(1)))


_AGG_SQL = {"sum": "CAST(sum(`{c}`) AS BIGINT)", "max": "max(`{c}`)", "min": "min(`{c}`)"}
INTEGER_COLUMNS = ("number_of_transactions", "block_size", "block_vsize", "total_fees")
ROUNDED_KINDS = ("avg", "median")


def agg_expr(kind: str, col: str, distinct: str = "exact", median: str = "builtin") -> Column:
    """One unrounded aggregate (built as SQL text: one JVM call per column)."""
    if kind == "avg" and col in INTEGER_COLUMNS:  # an integer sum is exact as it is
        return F.expr(f"CASE WHEN count(`{col}`) > 0 THEN CAST(sum(`{col}`) AS DOUBLE) / count(`{col}`) END")
    if kind == "avg":
        return F.expr(exact_avg_sql(col))
    if kind in _AGG_SQL:
        return F.expr(_AGG_SQL[kind].format(c=col))
    if kind == "count_distinct":
        return F.expr(f"count(DISTINCT `{col}`)" if distinct == "exact" else f"approx_count_distinct(`{col}`)")
    if kind == "median":
        return F.expr(f"median(`{col}`)" if median == "builtin"
                      else f"CAST(percentile_approx(`{col}`, 0.5, 100000) AS DOUBLE)")
    if kind == "count_status":
        return _count_status(col)
    raise ValueError(kind)


def round_outputs(df: DataFrame, spec: list, precision: int | None) -> DataFrame:
    """Round the average/median outputs of ``spec`` in one projection
    (Catalyst folds it into the aggregate's result expressions)."""
    if precision is None:
        return df
    names = {n for n, k, _ in spec if k in ROUNDED_KINDS}
    return df.select(*[round_to(c, precision).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


# -- alert classes (over the unrounded aggregates) ------------------------------

# The measures are aggregates of rows, or columns that hold them already.

def daily_alerts(high: Column | None = None, p99: Column | None = None) -> list[Column]:
    high = _count_status(S.HIGH) if high is None else high
    p99 = F.max("fee_p99") if p99 is None else p99
    return [
        F.when(high > S.DAILY_STRESS_HIGH_BLOCKS, F.lit(S.DAILY_STRESS_ALERT))
        .otherwise(F.lit(S.NORMAL))
        .alias("daily_network_stress_alert"),
        F.when(p99 > S.DAILY_VOLATILITY_P99, F.lit(S.DAILY_VOLATILITY_ALERT))
        .otherwise(F.lit(S.STABLE))
        .alias("daily_fee_volatility_alert"),
    ]


def hourly_alerts(avg_med: Column | None = None, skewness: Column | None = None) -> list[Column]:
    avg_med = F.expr(exact_avg_sql("median_fee")) if avg_med is None else avg_med
    skewness = F.max("fee_skewness_ratio") if skewness is None else skewness
    return [
        F.when(avg_med > S.HOURLY_FEE_CRITICAL_ABOVE, F.lit(S.HOURLY_FEE_CRITICAL))
        .when(avg_med.between(S.HOURLY_FEE_WARNING_FROM, S.HOURLY_FEE_CRITICAL_ABOVE), F.lit(S.HOURLY_FEE_WARNING))
        .otherwise(F.lit(S.HEALTHY))
        .alias("hourly_fee_alert"),
        F.when(skewness > S.HOURLY_SKEW_ABOVE, F.lit(S.HOURLY_SKEW_ALERT))
        .otherwise(F.lit(S.STABLE))
        .alias("hourly_skewness_alert"),
    ]


def minute_alerts(p99: Column | None = None, skewness: Column | None = None,
                  transactions: Column | None = None) -> list[Column]:
    p99 = F.max("fee_p99") if p99 is None else p99
    skewness = F.max("fee_skewness_ratio") if skewness is None else skewness
    transactions = F.sum("number_of_transactions") if transactions is None else transactions
    return [
        F.when(p99 > S.MINUTE_SPIKE_CRITICAL_ABOVE, F.lit(S.MINUTE_SPIKE_CRITICAL))
        .when(p99 > S.MINUTE_SPIKE_WARNING_ABOVE, F.lit(S.MINUTE_SPIKE_WARNING))
        .otherwise(F.lit(S.NORMAL))
        .alias("fee_spike_alert"),
        F.when(skewness > S.MINUTE_WHALE_ABOVE, F.lit(S.MINUTE_WHALE_ALERT))
        .otherwise(F.lit(S.NORMAL))
        .alias("fee_skewness_alert"),
        F.when(transactions > S.MINUTE_CONGESTION_TX_ABOVE, F.lit(S.MINUTE_CONGESTION_ALERT))
        .otherwise(F.lit(S.NORMAL))
        .alias("congestion_alert"),
    ]


def _mart(
    df: DataFrame,
    group_cols: list[Column],
    key_names: list[str],
    spec: list,
    alerts: list[Column],
    precision: int | None,
    distinct: str,
    median: str,
) -> DataFrame:
    """Aggregate ``spec`` per group; a 'median' entry in distributed mode is
    computed by :func:`exact_quantiles` and joined back on the keys."""
    medians = [(n, c) for n, k, c in spec if k == "median"] if median == "distributed" else []
    aggs = [
        agg_expr(kind, col, distinct, median).alias(name)
        for name, kind, col in spec
        if not (kind == "median" and medians)
    ]
    out = df.groupBy(*group_cols).agg(*aggs, *alerts)
    if medians:
        keyed = df.select(*group_cols, *{c for _, c in medians})
        for name, col in medians:
            out = _ns_join(out, exact_quantiles(keyed, key_names, col, [0.5], [name]), key_names, "left")
        names = {n for n, _, _ in spec}
        out = out.select(*key_names, *[n for n, _, _ in spec],
                         *[a for a in out.columns if a not in key_names and a not in names])
    return round_outputs(out, spec, precision)


def mart_daily(int_df: DataFrame, precision: int | None = None, distinct: str = "exact",
               median: str = "distributed", time_col: str = "enqueued_time") -> DataFrame:
    """Daily mart (25 columns): one row per day.  ``median="none"`` leaves its
    column out, for readers that do not use it: the median is the one output
    that needs more than a single aggregate."""
    spec = [x for x in DAILY_AGGS if median != "none" or x[1] != "median"]
    return _mart(int_df, [time_bucket(time_col, "day").alias("mempool_date")], ["mempool_date"],
                 spec, daily_alerts(), precision, distinct, median)


def mart_hourly(int_df: DataFrame, precision: int | None = None, distinct: str = "exact",
                time_col: str = "enqueued_time") -> DataFrame:
    """Hourly mart (34 columns): one row per hour and congestion status."""
    return _mart(int_df, [time_bucket(time_col, "hour").alias("time_hour"), F.col("network_congestion_status")],
                 ["time_hour", "network_congestion_status"], HOURLY_AGGS, hourly_alerts(), precision, distinct, "builtin")


def mart_minute(int_df: DataFrame, precision: int | None = None, distinct: str = "exact",
                time_col: str = "enqueued_time") -> DataFrame:
    """Minute mart (35 columns): one row per minute and congestion status."""
    return _mart(int_df, [time_bucket(time_col, "minute").alias("time_minute"), F.col("network_congestion_status")],
                 ["time_minute", "network_congestion_status"], MINUTE_AGGS, minute_alerts(), precision, distinct, "builtin")


# -- report aggregates ----------------------------------------------------------

PERCENTILE_LEVELS = (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def fee_percentiles(tx: DataFrame, by: str = "ts", grain: str = "day", value: str = "rate",
                    precision: int | None = None) -> DataFrame:
    """Exact P10..P99 of transaction fee rates per time bucket (distributed)."""
    names = [f"rate_p{int(round(q * 100))}" for q in PERCENTILE_LEVELS]
    keyed = tx.select(time_bucket(by, grain).alias("bucket"), F.col(value))
    q = exact_quantiles(keyed, ["bucket"], value, list(PERCENTILE_LEVELS), names)
    n = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_tx"))
    out = _ns_join(n, q, ["bucket"], "left")
    if precision is not None:
        out = out.select("bucket", "n_tx", *[round_to(c, precision).alias(c) for c in names])  # by name: SQL path
    return out


def congestion_share(int_df: DataFrame, precision: int | None = None) -> DataFrame:
    """Rows and share of all rows per congestion class (three groups; the
    window total runs over the already-aggregated three rows)."""
    counts = int_df.groupBy("network_congestion_status").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select("network_congestion_status", "n_rows",
                         _sql_rounded("`n_rows` / sum(`n_rows`) OVER ()", precision).alias("share"))


def exec_kpis(daily: DataFrame, dates: list | None = None, precision: int | None = None) -> DataFrame:
    """Whole-period totals over (optionally selected) days of the daily mart."""
    d = daily_slice(daily, dates) if dates else daily
    return d.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum("total_daily_transactions").cast("bigint").alias("total_transactions"),
        F.sum("daily_total_miner_revenue").cast("bigint").alias("total_revenue"),
        _sql_rounded(exact_avg_sql("avg_daily_block_size"), precision).alias("avg_block_size"),
        _sql_rounded(exact_avg_sql("daily_overall_median_fee"), precision).alias("avg_median_fee"),
    )


def daily_slice(daily: DataFrame, dates: list | None = None, start=None, end=None) -> DataFrame:
    """Date slicer over the daily mart: a list of days or an inclusive range."""
    c = F.col("mempool_date")
    if dates:
        return daily.where(c.isin([F.lit(d).cast("timestamp_ntz") for d in dates]))
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (c <= F.lit(end).cast("timestamp_ntz"))
    return daily.where(cond)


def rows_of_days(rows: DataFrame, days: list, time_col: str = "enqueued_time") -> DataFrame:
    """The rows of the given days, as time ranges that a scan can prune by."""
    day = [F.lit(d).cast("timestamp_ntz") for d in days]
    c = F.col(time_col)
    return rows.where(reduce(lambda a, b: a | b, [
        (c >= d) & (c < d + F.expr("INTERVAL 1 DAY")) for d in day]))


GRAIN_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def tx_velocity(int_df: DataFrame, grain: str = "hour", precision: int | None = None,
                time_col: str = "enqueued_time") -> DataFrame:
    """Transactions per second per bucket and the change against the
    calendar-previous bucket (NULL when that bucket has no rows).

    The previous bucket is found by an equi-join on ``bucket - 1 grain``
    rather than an unpartitioned ``lag`` window, so no single task sees
    every bucket however long the time range grows.
    """
    b = int_df.groupBy(time_bucket(time_col, grain).alias("bucket")).agg(
        F.sum("number_of_transactions").cast("bigint").alias("transactions")
    )
    prev = b.select(
        F.timestamp_add("SECOND", F.lit(GRAIN_SECONDS[grain]), F.col("bucket")).alias("bucket"),
        F.col("transactions").alias("_prev"),
    )
    rate = f"`transactions` / {float(GRAIN_SECONDS[grain])!r}D"
    return b.join(prev, "bucket", "left").select(
        "bucket", "transactions", _sql_rounded(rate, precision).alias("tx_per_second"),
        (F.col("transactions") - F.col("_prev")).alias("change_vs_previous"),
    )
