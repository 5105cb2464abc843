from feeflow.functions.expressions import (  # noqa: F401
    congestion_status,
    epoch_seconds,
    fee_percentile_columns,
    key_text,
    lower_columns,
    number_format,
    parse_event_time,
    safe_ratio,
    surrogate_key,
    time_bucket,
)
