"""DuckDB SQL for every catalogued query (the correctness oracle).

Written independently of the Spark code from the model definitions and
the fixture mapping; tables ``orders lineitem events`` are views.
Conventions: integer sums cast to BIGINT; averages, medians and ratios
compared at ``DIGITS`` decimals; times as TIMESTAMP (no zone).  The marts are
generated from the output lists of the mart definitions; alert classes come
from a relation of limits.
"""

from __future__ import annotations

from feeflow import schemas as S
from feeflow.operators.marts import DAILY_AGGS, HOURLY_AGGS, MINUTE_AGGS
from feeflow.plans.catalog import DIGITS

P = ["fee_p10", "fee_p25", "fee_p50", "fee_p75", "fee_p90", "fee_p95", "fee_p99"]
OK = "o.o_orderstatus <> 'P'"

_LABELS = ", ".join(f"'{x}'" for x in (S.LOW, S.MODERATE, S.HIGH))

# (alert, limit, whether the limit itself counts, label)
ALERT_LIMITS = [
    ("stress_day", S.DAILY_STRESS_HIGH_BLOCKS, False, S.DAILY_STRESS_ALERT),
    ("volatile_day", S.DAILY_VOLATILITY_P99, False, S.DAILY_VOLATILITY_ALERT),
    ("hour_fee", S.HOURLY_FEE_WARNING_FROM, True, S.HOURLY_FEE_WARNING),
    ("hour_fee", S.HOURLY_FEE_CRITICAL_ABOVE, False, S.HOURLY_FEE_CRITICAL),
    ("hour_skew", S.HOURLY_SKEW_ABOVE, False, S.HOURLY_SKEW_ALERT),
    ("minute_spike", S.MINUTE_SPIKE_WARNING_ABOVE, False, S.MINUTE_SPIKE_WARNING),
    ("minute_spike", S.MINUTE_SPIKE_CRITICAL_ABOVE, False, S.MINUTE_SPIKE_CRITICAL),
    ("minute_whale", S.MINUTE_WHALE_ABOVE, False, S.MINUTE_WHALE_ALERT),
    ("minute_load", S.MINUTE_CONGESTION_TX_ABOVE, False, S.MINUTE_CONGESTION_ALERT),
]
_LIMITS = ", ".join(f"('{a}', CAST({b} AS DOUBLE), {str(c).lower()}, '{x}')" for a, b, c, x in ALERT_LIMITS)

# (column, alert, measured value, label below all limits) per mart
DAILY_ALERTS = [
    ("daily_network_stress_alert", "stress_day", "high_congestion_blocks", S.NORMAL),
    ("daily_fee_volatility_alert", "volatile_day", "daily_max_p99_fee", S.STABLE),
]
HOURLY_ALERTS = [
    ("hourly_fee_alert", "hour_fee", "raw_avg_median_fee", S.HEALTHY),
    ("hourly_skewness_alert", "hour_skew", "max_fee_skewness", S.STABLE),
]
MINUTE_ALERTS = [
    ("fee_spike_alert", "minute_spike", "peak_fee_p99", S.NORMAL),
    ("fee_skewness_alert", "minute_whale", "max_fee_skewness_ratio", S.NORMAL),
    ("congestion_alert", "minute_load", "total_transactions", S.NORMAL),
]


def exact_avg(c: str) -> str:
    """Average from exact integer sums of whole part and 52 fraction bits."""
    x, piece = f"CAST({c} AS DOUBLE)", 1 << 26
    bits = f"({x} - floor({x})) * {piece}"
    return (f"((CAST(sum(CAST(floor({x}) AS BIGINT)) AS DOUBLE)"
            f" + CAST(sum(CAST(floor({bits}) AS BIGINT)) AS DOUBLE) / CAST({piece} AS DOUBLE)"
            f" + CAST(sum(CAST(floor((({bits}) - floor({bits})) * {piece}) AS BIGINT)) AS DOUBLE)"
            f" / CAST({piece ** 2} AS DOUBLE)) / count({c}))")


_AGGREGATES = {
    "sum": lambda c: f"CAST(sum({c}) AS BIGINT)",
    "avg": lambda c: f"round({exact_avg(c)}, 6)",
    "max": lambda c: f"max({c})",
    "min": lambda c: f"min({c})",
    "median": lambda c: f"round(median({c}), 6)",
    "count_distinct": lambda c: f"count(DISTINCT {c})",
    "count_status": lambda c: f"count(*) FILTER (WHERE network_congestion_status = '{c}')",
}


def _mart(name: str, unit: str, key: str, outputs: list, by_status: bool, alerts: list,
          source: str = "inter") -> str:
    """One mart as two named steps: the aggregates, then the alert classes."""
    status = "network_congestion_status, " if by_status else ""
    columns = ", ".join(f"{_AGGREGATES[kind](c)} AS {out}" for out, kind, c in outputs)
    classes = ", ".join(
        f"coalesce((SELECT arg_max(label, bound) FROM limits WHERE alert = '{alert}'"
        f" AND ({value} > bound OR (closed AND {value} = bound))), '{calm}') AS {out}"
        for out, alert, value, calm in alerts)
    return (f"{name}_sums AS (SELECT CAST(date_trunc('{unit}', enqueued_time) AS TIMESTAMP) AS {key}, {status}"
            f"{columns}, {exact_avg('median_fee')} AS raw_avg_median_fee FROM {source} GROUP BY ALL),\n"
            f"{name} AS (SELECT * EXCLUDE (raw_avg_median_fee), {classes} FROM {name}_sums)")


def _features(prefix: str, source: str) -> str:
    """The feature columns of ``source`` as two named steps."""
    return f"""{prefix}per_unit AS (
  SELECT d.*, safe.bytes, safe.txs, safe.low
  FROM {source} d, LATERAL (SELECT CASE WHEN d.block_size > 0 THEN CAST(d.block_size AS DOUBLE) END AS bytes,
                                CASE WHEN d.number_of_transactions > 0
                                     THEN CAST(d.number_of_transactions AS DOUBLE) END AS txs,
                                CASE WHEN d.fee_p10 > 0 THEN d.fee_p10 END AS low) safe
),
{prefix}inter AS (
  SELECT mempool_id, sequence_number, enqueued_time, block_size, block_vsize, number_of_transactions,
         total_fees, median_fee, {", ".join(P)},
         fee_p99 - fee_p10 AS fee_spread_range,
         fee_p75 - fee_p25 AS interquartile_fee_range,
         fee_p99 / low AS fee_skewness_ratio,
         coalesce(block_vsize / bytes, 0.0) AS block_compression_ratio,
         coalesce(total_fees / bytes, 0.0) AS miner_revenue_per_byte,
         coalesce(total_fees / txs, 0.0) AS avg_fee_per_tx,
         [{_LABELS}][1 + (coalesce(median_fee, 0) >= {S.CONGESTION_MODERATE_FROM})::INT
                       + (coalesce(median_fee, 0) > {S.CONGESTION_HIGH_ABOVE})::INT] AS network_congestion_status
  FROM {prefix}per_unit
)"""


BASE = f"""
li_sums AS (
  SELECT l_orderkey,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS li_bytes,
         sum(CAST(l_quantity AS BIGINT)) AS li_qty
  FROM lineitem GROUP BY l_orderkey
),
li_fees AS (
  SELECT l_orderkey, list_sort(list(l_extendedprice / (250 * (1 + l_orderkey % 4)))) AS fr
  FROM lineitem GROUP BY l_orderkey
),
parsed AS (
  SELECT o.o_orderkey // 4 AS sequence_number,
         TIMESTAMP '2026-09-17 00:00:00'
           + to_seconds(((o.o_orderkey // 2) % 9) * 86400 + ((o.o_orderkey // 2) * 7919) % 7200) AS enqueued_time,
         CAST(o.o_orderkey % 2 AS INTEGER) AS block_index,
         CASE WHEN {OK} THEN CAST(s.li_bytes AS BIGINT) END AS block_size,
         CASE WHEN {OK} THEN CAST(s.li_bytes * (50 + o.o_orderkey % 50) // 100 AS BIGINT) END AS block_vsize,
         CASE WHEN {OK} THEN o.o_totalprice / 7000 END AS median_fee,
         CASE WHEN {OK} THEN TRY_CAST(s.li_qty * 1000 AS INTEGER) END AS n_tx,
         CASE WHEN {OK} THEN CAST(round(o.o_totalprice * 100) AS BIGINT) END AS total_fees,
         {", ".join(f"CASE WHEN {OK} THEN f.fr[{i + 1}] END AS {c}" for i, c in enumerate(P))}
  FROM orders o
  LEFT JOIN li_sums s ON s.l_orderkey = o.o_orderkey
  LEFT JOIN li_fees f ON f.l_orderkey = o.o_orderkey
),
staging AS (
  SELECT md5(concat_ws('-',
             coalesce(CAST(sequence_number AS VARCHAR), '<null>'),
             coalesce(strftime(enqueued_time, '%Y-%m-%d %H:%M:%S.%f'), '<null>'))) AS mempool_id,
         sequence_number, enqueued_time, block_size, block_vsize, median_fee,
         n_tx AS number_of_transactions, total_fees, {", ".join(P)}, block_index
  FROM parsed
),
dedup AS (
  SELECT DISTINCT ON (mempool_id) * FROM staging
  ORDER BY mempool_id, enqueued_time DESC NULLS LAST, block_index NULLS LAST, block_size NULLS LAST,
           total_fees NULLS LAST, median_fee NULLS LAST, block_vsize NULLS LAST,
           number_of_transactions NULLS LAST, {", ".join(f"{c} NULLS LAST" for c in P)}
),
{_features("", "dedup")},
limits(alert, bound, closed, label) AS (VALUES {_LIMITS}),
{_mart("daily", "day", "mempool_date", DAILY_AGGS, False, DAILY_ALERTS)},
{_mart("hourly", "hour", "time_hour", HOURLY_AGGS, True, HOURLY_ALERTS)},
{_mart("minute", "minute", "time_minute", MINUTE_AGGS, True, MINUTE_ALERTS)},
messages AS (
  SELECT sequence_number, enqueued_time,
         count(median_fee) AS n_ok,
         count(*) AS n_rows
  FROM parsed GROUP BY 1, 2
),
msg_rows AS (
  SELECT p.*, row_number() OVER (PARTITION BY sequence_number, enqueued_time ORDER BY block_index) - 1 AS pos
  FROM parsed p WHERE median_fee IS NOT NULL
),
exploded AS (
  SELECT sequence_number, enqueued_time, CAST(pos AS INTEGER) AS block_index, block_size, block_vsize,
         median_fee, n_tx, total_fees, {", ".join(P)}
  FROM msg_rows
  UNION ALL
  SELECT sequence_number, enqueued_time, CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
         CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT),
         {", ".join("CAST(NULL AS DOUBLE)" for _ in P)}
  FROM messages WHERE n_ok = 0
),
first_blocks AS (
  SELECT CAST(NULL AS VARCHAR) AS mempool_id, * EXCLUDE (n_tx), n_tx AS number_of_transactions
  FROM exploded WHERE coalesce(block_index, 0) = 0
),
{_features("capture_", "first_blocks")},
{_mart("capture_minute", "minute", "time_minute", MINUTE_AGGS, True, MINUTE_ALERTS, "capture_inter")},
hour_tx AS (
  SELECT CAST(date_trunc('hour', enqueued_time) AS TIMESTAMP) AS bucket,
         CAST(sum(number_of_transactions) AS BIGINT) AS transactions
  FROM inter GROUP BY 1
),
tx AS (
  SELECT event_id, ts, md5(CAST(event_id AS VARCHAR)) AS txid,
         CAST(round(value * 100) AS BIGINT) AS fee,
         CAST(100 + event_id % 400 AS DOUBLE) AS vsize,
         CAST(round(value * 100) AS BIGINT) AS value,
         CAST(round(value * 100) AS BIGINT) / CAST(100 + event_id % 400 AS DOUBLE) AS rate
  FROM events
)
"""


def rounded(expr: str) -> str:
    """Rounding to ``DIGITS`` decimals with plain IEEE steps."""
    x = f"CAST({expr} AS DOUBLE)"

    def step(v, d):
        scale = f"CAST({10 ** d} AS DOUBLE)"
        return f"(round_even({v} * {scale}, 0) / {scale})"

    return step(step(x, DIGITS + 3), DIGITS)


def _expand_round(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` into :func:`rounded`."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        arg, _, digits = inner.rpartition(",")
        if digits.strip() != "6":
            out.append(sql[i:k])
        else:
            out.append(sql[i:j] + rounded(_expand_round(arg.strip())))
        i = k


def q(body: str) -> str:
    return "WITH " + _expand_round(BASE.strip()) + "\n" + _expand_round(body)


def _status_class(col: str) -> str:
    u = f"upper(CAST({col} AS VARCHAR))"
    return (f"CASE WHEN coalesce({u} LIKE '%NORMAL%' OR {u} LIKE '%HEALTHY%' OR {u} LIKE '%LOW%', false) "
            f"THEN 'normal' ELSE 'alert' END")


def _nz(*cols: str, default: str = "0") -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN {c} <> 0 THEN {c} END" for c in cols) + f", {default})"


_LATEST_H = "(SELECT * FROM hourly ORDER BY time_hour DESC NULLS LAST, network_congestion_status ASC NULLS LAST LIMIT 1)"
_LATEST_M = "(SELECT * FROM minute ORDER BY time_minute DESC NULLS LAST, network_congestion_status ASC NULLS LAST LIMIT 1)"

_KPI_H = f"""
SELECT time_hour, network_congestion_status AS congestion_status, hourly_fee_alert AS fee_alert,
       hourly_skewness_alert AS skewness_alert,
       CAST({_nz('total_transactions')} AS BIGINT) AS total_transactions,
       CAST({_nz('total_blocks', default='1')} AS BIGINT) AS total_blocks,
       CAST(CASE WHEN {_nz('avg_transactions_per_block')} = 0 AND {_nz('total_blocks', default='1')} > 0
                 THEN {_nz('total_transactions')} / {_nz('total_blocks', default='1')}
                 ELSE {_nz('avg_transactions_per_block')} END AS DOUBLE) AS avg_tx_per_block,
       CAST(CASE WHEN {_nz('max_transactions_in_block')} = 0 THEN {_nz('total_transactions')}
                 ELSE {_nz('max_transactions_in_block')} END AS BIGINT) AS max_tx_per_block,
       {_nz('total_block_size')} / 1e6 AS total_block_size_mb,
       CAST({_nz('avg_block_vsize', default='0.0')} AS DOUBLE) AS avg_block_vsize,
       {_nz('avg_fee_p10', default='0.0')} AS p10_fee,
       {_nz('avg_fee_p25', default='0.0')} AS p25_fee,
       {_nz('avg_fee_p50', 'avg_median_fee', default='0.0')} AS p50_fee,
       {_nz('avg_fee_p75', default='0.0')} AS p75_fee,
       {_nz('avg_fee_p90', default='0.0')} AS p90_fee,
       {_nz('avg_fee_p95', default='0.0')} AS p95_fee,
       {_nz('avg_fee_p99', 'max_fee_p99_hourly', default='0.0')} AS p99_fee,
       {_nz('avg_fee_spread', default='0.0')} AS avg_fee_spread,
       {_nz('avg_iqr_fee', default='0.0')} AS iqr_fee,
       {_nz('avg_fee_skewness', default='0.0')} AS fee_skewness,
       {_nz('avg_miner_revenue_per_byte', default='0.0')} AS miner_revenue_ratio,
       {_nz('avg_block_compression', default='0.0')} AS block_compactness,
       {_status_class('network_congestion_status')} AS congestion_class,
       {_status_class('hourly_fee_alert')} AS fee_alert_class,
       {_status_class('hourly_skewness_alert')} AS skewness_alert_class
FROM {_LATEST_H} h
"""

_KPI_M = f"""
SELECT time_minute, fee_spike_alert, fee_skewness_alert, congestion_alert,
       network_congestion_status AS congestion_status,
       {_nz('avg_fee_p10', default='0.0')} AS p10_fee,
       {_nz('avg_fee_p50', 'avg_median_fee', default='0.0')} AS p50_fee,
       {_nz('avg_fee_p90', default='0.0')} AS p90_fee,
       {_nz('avg_fee_p99', default='0.0')} AS p99_fee,
       {_nz('peak_fee_p99', default='0.0')} AS peak_p99_fee,
       {_status_class('fee_spike_alert')} AS spike_class,
       {_status_class('fee_skewness_alert')} AS whale_class,
       {_status_class('congestion_alert')} AS congestion_alert_class
FROM {_LATEST_M} m
"""

# Fields of the three landings: the third message of each three has the
# contradicting timestamp; kinds only widen, versions count the changes.
_REGISTRY = """,
landed AS (
  SELECT CAST(1 + sequence_number % 3 AS INTEGER) AS landing, n_ok > 0 AS blocks,
         CASE WHEN n_ok > 0 THEN 'mempool_blocks_event' ELSE 'stats_event' END AS payload_type
  FROM messages
),
counted AS (SELECT landing, payload_type, blocks, count(*) AS n FROM landed GROUP BY ALL),
field_names AS (
  SELECT * FROM (VALUES ('payload_type', 1), ('timestamp', 1), ('data', 1), ('node', 2)) f(field, appears)
)
SELECT landing, payload_type, field,
       CASE field WHEN 'payload_type' THEN 'string' WHEN 'node' THEN 'string'
                  WHEN 'timestamp' THEN CASE WHEN landing = 1 THEN 'long' ELSE 'double' END
                  ELSE CASE WHEN blocks THEN 'array' ELSE 'object' END END AS kind,
       CAST(CASE WHEN field = 'node' OR (field = 'timestamp' AND landing > 1) THEN 2 ELSE 1 END AS INTEGER)
         AS since_version,
       CASE WHEN landing = appears THEN 'added'
            WHEN field = 'timestamp' AND landing = 2 THEN 'widened'
            WHEN field = 'node' THEN 'absent' ELSE 'same' END AS change,
       CASE WHEN field = 'node' AND landing = 3 THEN 0 ELSE n END AS n_messages,
       CASE WHEN field = 'timestamp' AND landing = 3 THEN n ELSE 0 END AS n_conflicts
FROM counted, field_names WHERE landing >= appears
UNION ALL
SELECT l, '', '*', 'quarantine', l, 'quarantined', 0, (SELECT count(*) FROM landed WHERE landing = 3 AND l = 3)
FROM (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS l)
"""

_PCT = [0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]

ORACLE = {
    "q_mart_daily": q("SELECT * FROM daily"),
    "q_mart_hourly": q("SELECT * FROM hourly"),
    "q_mart_minute": q("SELECT * FROM minute"),
    "q_staging": q("SELECT * FROM staging"),
    "q_surrogate_key": q(
        "SELECT mempool_id, sequence_number, enqueued_time, count(*) AS n_rows FROM staging GROUP BY 1, 2, 3"
    ),
    "q_dedup_latest": q("SELECT * FROM dedup"),
    "q_features": q("SELECT * FROM inter"),
    "q_congestion": q(
        "SELECT mempool_id, block_index, median_fee, "
        "CASE WHEN median_fee > 50 THEN 'High Congestion' WHEN median_fee BETWEEN 20 AND 50 "
        "THEN 'Moderate Congestion' ELSE 'Low Congestion' END AS network_congestion_status FROM staging"
    ),
    "q_row_count": q(
        "SELECT (SELECT count(*) FROM messages) AS n_messages, (SELECT count(*) FROM exploded) AS n_rows"
    ),
    "q_json_parse": q(
        "SELECT sequence_number, enqueued_time, "
        "CASE WHEN n_ok > 0 THEN 'mempool_blocks_event' ELSE 'stats_event' END AS payload_type, "
        "CAST(epoch(enqueued_time) AS BIGINT) AS timestamp, "
        "CASE WHEN n_ok > 0 THEN CAST(n_ok AS INTEGER) END AS n_items FROM messages"
    ),
    "q_explode_outer": q(
        "SELECT sequence_number, enqueued_time, block_index, block_size, block_vsize, median_fee, n_tx, total_fees "
        "FROM exploded"
    ),
    "q_fee_pivot": q(f"SELECT sequence_number, enqueued_time, block_index, {', '.join(P)} FROM exploded"),
    "q_typed_load": q("SELECT * EXCLUDE (block_index) FROM parsed"),
    "q_variant_load": q("SELECT * EXCLUDE (block_index) FROM parsed"),
    "q_time_parse": q(
        "SELECT sequence_number, strftime(enqueued_time, '%-m/%-d/%Y %-I:%M:%S %p') AS capture_text, "
        "enqueued_time FROM messages"
    ),
    "q_event_routing": q(
        "SELECT m.sequence_number, m.enqueued_time, e.payload_type, "
        "CAST(epoch(m.enqueued_time) AS BIGINT) AS timestamp, "
        "CASE WHEN e.payload_type = 'mempool_blocks_event' THEN CAST(m.n_ok AS INTEGER) END AS n_items, "
        "f.block_size, CASE WHEN e.payload_type = 'stats_event' THEN m.n_rows END AS mempool_size "
        "FROM messages m JOIN (VALUES ('block_event'), ('mempool_blocks_event'), ('stats_event')) e(payload_type) "
        "ON CASE e.payload_type WHEN 'stats_event' THEN m.n_ok = 0 "
        "WHEN 'block_event' THEN m.n_ok > 0 AND m.sequence_number % 3 = 0 ELSE m.n_ok > 0 END "
        "LEFT JOIN msg_rows f ON f.pos = 0 AND f.sequence_number = m.sequence_number "
        "AND f.enqueued_time = m.enqueued_time"
    ),
    "q_schema_fields": q(
        "SELECT CASE WHEN n_ok > 0 THEN 'mempool_blocks_event' ELSE 'stats_event' END AS payload_type, "
        "f.field, CASE f.field WHEN 'payload_type' THEN 'string' WHEN 'timestamp' THEN 'number' "
        "ELSE CASE WHEN n_ok > 0 THEN 'array' ELSE 'object' END END AS json_type, count(*) AS n_messages "
        "FROM messages, (VALUES ('payload_type'), ('timestamp'), ('data')) f(field) GROUP BY ALL"
    ),
    "q_capture_scan": q(
        "SELECT sequence_number, strftime(enqueued_time, '%-m/%-d/%Y %-I:%M:%S %p') AS capture_text, "
        "CASE WHEN sequence_number % 2 = 1 THEN CAST(3 AS INTEGER) END AS partition_id FROM messages"
    ),
    "q_envelope": q(
        "SELECT e.payload_type, CAST(epoch(m.enqueued_time) AS BIGINT) AS timestamp, "
        "CASE WHEN e.payload_type = 'mempool_blocks_event' THEN CAST(m.n_ok AS INTEGER) END AS n_items "
        "FROM messages m JOIN (VALUES ('block_event'), ('mempool_blocks_event'), ('stats_event')) e(payload_type) "
        "ON CASE e.payload_type WHEN 'stats_event' THEN m.n_ok = 0 "
        "WHEN 'block_event' THEN m.n_ok > 0 AND m.sequence_number % 3 = 0 ELSE m.n_ok > 0 END"
    ),
    "q_raw_block": q(
        "SELECT sequence_number, enqueued_time, block_index, block_size AS raw_block_size, "
        "total_fees AS raw_total_fees FROM exploded"
    ),
    "q_materialized": q("SELECT * FROM hourly"),
    "q_number_format": q(
        "SELECT time_hour, network_congestion_status, format('{:,}', total_transactions) AS transactions_text "
        "FROM hourly"
    ),
    "q_stream_minute": q("SELECT * EXCLUDE (total_blocks) FROM capture_minute"),
    "q_stream_minute_exact": q("SELECT * FROM capture_minute"),
    "q_stream_load": q("SELECT * FROM dedup"),
    "q_stream_parsed": q(
        "SELECT sequence_number, enqueued_time, block_index, median_fee, total_fees FROM exploded UNION ALL "
        "SELECT unnest([-1, -2]), NULL, NULL, NULL, NULL"
    ),
    "q_stream_late": q(
        "SELECT count(*) AS n_kept, CAST(0 AS BIGINT) AS n_late_first, "
        "count(*) FILTER (WHERE enqueued_time <= (SELECT max(enqueued_time) FROM messages) - INTERVAL 1 HOUR) "
        "AS n_late_second FROM messages"
    ),
    "q_bronze": q(
        "SELECT sequence_number, strftime(enqueued_time, '%-m/%-d/%Y %-I:%M:%S %p') AS capture_text, "
        "CASE WHEN n_ok > 0 THEN 'mempool_blocks_event' ELSE 'stats_event' END AS payload_type FROM messages"
    ),
    "q_landing_inventory": q(
        "SELECT CAST(list_position(['High Congestion', 'Moderate Congestion', 'Low Congestion'], "
        "network_congestion_status) - 1 AS VARCHAR) AS folder, CAST(1 AS BIGINT) AS n_files, "
        "CAST(1 AS BIGINT) AS n_filled, count(*) AS n_rows FROM inter GROUP BY 1"
    ),
    "q_source_names": q(
        "SELECT CAST(enqueued_time AS DATE) AS day, count(*) AS n_rows, count(DISTINCT mempool_id) AS n_keys "
        "FROM staging GROUP BY 1"
    ),
    "q_mart_incremental": q("SELECT * FROM daily"),
    "q_mart_incremental_hours": q("SELECT * FROM hourly"),
    "q_mart_incremental_minutes": q("SELECT * FROM minute"),
    "q_mart_weekly": q(", " + _mart("weekly", "week", "week_start", [x for x in DAILY_AGGS if x[1] != "median"],
                                   False, DAILY_ALERTS) + " SELECT * FROM weekly"),
    "q_late_load": q("SELECT * FROM dedup"),
    "q_gate": q("SELECT * FROM dedup"),
    "q_atomic_replace": q("SELECT * FROM hourly"),
    "q_newest_minutes": q("SELECT * FROM minute ORDER BY time_minute DESC, network_congestion_status LIMIT 500"),
    "q_parsed_roundtrip": q("SELECT * FROM parsed"),
    "q_overwrite_shrink": q(
        "SELECT * FROM parsed WHERE enqueued_time >= TIMESTAMP '2026-09-18 00:00:00' "
        "AND enqueued_time < TIMESTAMP '2026-09-19 00:00:00'"
    ),
    "q_quarantine": q(
        "SELECT sequence_number, '{broken' AS body_str FROM messages WHERE sequence_number % 10 = 0"
    ),
    "q_snapshot": q(
        "SELECT * FROM hourly ORDER BY time_hour DESC NULLS LAST, network_congestion_status ASC NULLS LAST LIMIT 500"
    ),
    "q_tx_fanout": q("SELECT 'mempool_tx' AS payload_type, txid, fee, vsize, value, rate FROM tx"),
    "q_high_watermark": q(
        "SELECT * FROM staging WHERE enqueued_time > "
        "(SELECT max(enqueued_time) FROM staging WHERE enqueued_time < TIMESTAMP '2026-09-21 00:00:00')"
    ),
    "q_incremental_upsert": q("SELECT * FROM dedup"),
    "q_bucketed_upsert": q("SELECT * FROM dedup"),
    "q_schema_registry": q(_REGISTRY),
    "q_drop_duplicates": q("SELECT DISTINCT * FROM parsed"),
    "q_fill_defaults": q(
        "SELECT mempool_id, sequence_number, enqueued_time, coalesce(block_size, 0) AS block_size, "
        "coalesce(block_vsize, 0) AS block_vsize, coalesce(median_fee, 0.0) AS median_fee, "
        "coalesce(number_of_transactions, 0) AS number_of_transactions, coalesce(total_fees, 0) AS total_fees, "
        + ", ".join(f"{c}" for c in P) + ", block_index FROM staging"
    ),
    "q_count_distinct_by_hour": q(
        "SELECT CAST(date_trunc('hour', enqueued_time) AS TIMESTAMP) AS time_hour, "
        "count(DISTINCT sequence_number) AS total_blocks FROM inter GROUP BY 1"
    ),
    "q_median_by_day": q(
        "SELECT CAST(date_trunc('day', enqueued_time) AS TIMESTAMP) AS mempool_date, "
        "round(median(median_fee), 6) AS median_fee FROM inter GROUP BY 1 HAVING count(median_fee) > 0"
    ),
    "q_conditional_count": q(
        "SELECT mempool_date, high_congestion_blocks, moderate_congestion_blocks, low_congestion_blocks FROM daily"
    ),
    "q_alert_daily": q("SELECT mempool_date, daily_network_stress_alert, daily_fee_volatility_alert FROM daily"),
    "q_alert_hourly": q(
        "SELECT time_hour, network_congestion_status, hourly_fee_alert, hourly_skewness_alert FROM hourly"
    ),
    "q_alert_minute": q(
        "SELECT time_minute, network_congestion_status, fee_spike_alert, fee_skewness_alert, congestion_alert "
        "FROM minute"
    ),
    "q_fee_percentiles": q(
        "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket, count(*) AS n_tx, "
        + ", ".join(f"round(quantile_cont(rate, {p}), 6) AS rate_p{int(round(p * 100))}" for p in _PCT)
        + " FROM tx GROUP BY 1"
    ),
    "q_congestion_share": q(
        "SELECT network_congestion_status, count(*) AS n_rows, "
        "round(count(*) / sum(count(*)) OVER (), 6) AS share FROM inter GROUP BY 1"
    ),
    "q_exec_kpis": q(
        "SELECT count(*) AS n_days, CAST(sum(total_daily_transactions) AS BIGINT) AS total_transactions, "
        "CAST(sum(daily_total_miner_revenue) AS BIGINT) AS total_revenue, "
        f"round({exact_avg('avg_daily_block_size')}, 6) AS avg_block_size, "
        f"round({exact_avg('daily_overall_median_fee')}, 6) AS avg_median_fee FROM daily"
    ),
    "q_daily_slice": q(
        "SELECT * FROM daily WHERE mempool_date IN "
        "(TIMESTAMP '2026-09-18 00:00:00', TIMESTAMP '2026-09-20 00:00:00', TIMESTAMP '2026-09-24 00:00:00')"
    ),
    "q_tx_velocity": q(
        "SELECT b.bucket, b.transactions, round(b.transactions / 3600.0, 6) AS tx_per_second, "
        "b.transactions - p.transactions AS change_vs_previous "
        "FROM hour_tx b LEFT JOIN hour_tx p ON p.bucket + INTERVAL 1 HOUR = b.bucket"
    ),
    "q_top500_hours": q(
        "SELECT * FROM hourly ORDER BY time_hour DESC NULLS LAST, network_congestion_status ASC NULLS LAST LIMIT 500"
    ),
    "q_top500_minutes": q(
        "SELECT * FROM minute ORDER BY time_minute DESC NULLS LAST, network_congestion_status ASC NULLS LAST "
        "LIMIT 500"
    ),
    "q_latest_hour": q(f"SELECT * FROM {_LATEST_H} h"),
    "q_latest_minute": q(f"SELECT * FROM {_LATEST_M} m"),
    "q_check_unique": q(
        "SELECT 'staging' AS model, 'unique' AS test, 'mempool_id' AS column_name, "
        "(SELECT count(*) FROM (SELECT mempool_id FROM staging WHERE mempool_id IS NOT NULL "
        " GROUP BY 1 HAVING count(*) > 1)) AS failures "
        "UNION ALL SELECT 'intermediate', 'unique', 'mempool_id', "
        "(SELECT count(*) FROM (SELECT mempool_id FROM inter WHERE mempool_id IS NOT NULL "
        " GROUP BY 1 HAVING count(*) > 1))"
    ),
    "q_check_not_null": q(
        "SELECT 'not_null' AS test, 'mempool_id' AS column_name, CAST(count_if(mempool_id IS NULL) AS BIGINT) AS failures FROM inter "
        "UNION ALL SELECT 'not_null', 'network_congestion_status', CAST(count_if(network_congestion_status IS NULL) AS BIGINT) "
        "FROM inter UNION ALL SELECT 'not_null', 'avg_fee_per_tx', CAST(count_if(avg_fee_per_tx IS NULL) AS BIGINT) FROM inter "
        "UNION ALL SELECT 'not_null', 'enqueued_time', CAST(count_if(enqueued_time IS NULL) AS BIGINT) FROM inter "
        "UNION ALL SELECT 'p10_le_p99', 'fee_p10', CAST(count_if(fee_p10 > fee_p99) AS BIGINT) FROM inter"
    ),
    "q_check_accepted": q(
        "SELECT 'accepted_values' AS test, 'network_congestion_status' AS column_name, "
        "CAST(count_if(network_congestion_status NOT IN ('High Congestion', 'Moderate Congestion', 'Low Congestion')) AS BIGINT) "
        "AS failures FROM inter"
    ),
    "q_kpi_hourly": q(_KPI_H),
    "q_kpi_minute": q(_KPI_M),
    "q_fee_series_long": q(
        " UNION ALL ".join(
            f"SELECT time_hour, network_congestion_status, '{c}' AS percentile, {c} AS fee FROM hourly"
            for c in ("avg_fee_p10", "avg_fee_p50", "avg_fee_p90", "avg_fee_p99"))
    ),
    "q_throughput_pivot": q(
        "SELECT time_hour, "
        "CAST(sum(CASE WHEN network_congestion_status = 'High Congestion' THEN total_transactions END) AS BIGINT) "
        "AS high_tx, "
        "CAST(sum(CASE WHEN network_congestion_status = 'Moderate Congestion' THEN total_transactions END) AS BIGINT) "
        "AS moderate_tx, "
        "CAST(sum(CASE WHEN network_congestion_status = 'Low Congestion' THEN total_transactions END) AS BIGINT) "
        "AS low_tx FROM hourly GROUP BY 1"
    ),
    "q_fees_series": q(
        "SELECT time_hour, CAST(sum(total_fees_collected) AS BIGINT) AS total_fees_collected FROM hourly GROUP BY 1"
    ),
    "q_spike_series": q("SELECT time_minute, network_congestion_status, peak_fee_p99 FROM minute"),
    "q_whale_points": q(
        "SELECT time_minute, network_congestion_status, max_fee_skewness_ratio, fee_skewness_alert FROM minute "
        "WHERE fee_skewness_alert <> 'NORMAL'"
    ),
    "q_context": q(
        "SELECT h.network_congestion_status AS network_congestion, h.total_transactions, h.avg_fee_p50, "
        "h.avg_fee_p99, h.hourly_fee_alert, m.fee_spike_alert AS minute_fee_spike_alert, "
        "m.peak_fee_p99 AS minute_peak_fee_p99, m.fee_skewness_alert AS minute_whale_alert "
        f"FROM {_LATEST_H} h, {_LATEST_M} m"
    ),
    "q_daily_fee_spread": q(
        "SELECT mempool_date, daily_min_p10_fee, daily_max_p99_fee, daily_avg_median_fee FROM daily"
    ),
    "q_daily_revenue": q("SELECT mempool_date, daily_total_miner_revenue, daily_overall_median_fee FROM daily"),
    "q_daily_efficiency": q("SELECT mempool_date, daily_avg_compression_ratio, daily_avg_fee_skewness FROM daily"),
    "q_status_class": q(
        "SELECT DISTINCT status, " + _status_class("status") + " AS status_class FROM ("
        "SELECT network_congestion_status AS status FROM hourly UNION ALL SELECT hourly_fee_alert FROM hourly "
        "UNION ALL SELECT hourly_skewness_alert FROM hourly UNION ALL SELECT fee_spike_alert FROM minute "
        "UNION ALL SELECT fee_skewness_alert FROM minute UNION ALL SELECT congestion_alert FROM minute "
        "UNION ALL SELECT daily_network_stress_alert FROM daily UNION ALL SELECT daily_fee_volatility_alert FROM daily)"
    ),
    "q_alert_feed": q(
        "SELECT time_minute, network_congestion_status, fee_spike_alert, fee_skewness_alert, congestion_alert, "
        "peak_fee_p99, max_fee_skewness_ratio, total_transactions FROM minute "
        "WHERE fee_spike_alert <> 'NORMAL' OR fee_skewness_alert <> 'NORMAL' OR congestion_alert <> 'NORMAL'"
    ),
}
