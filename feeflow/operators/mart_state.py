"""Mergeable state of the marts.

The state holds, per minute, congestion status and block of sequence numbers,
what the marts' aggregates are made of: row counts, integer sums (of integer
columns, and of the pieces of exact averages), minima, maxima, and a bitmap of
the sequence numbers seen.  All of it merges without loss, so

* the minute, hour and day marts come from one pass over the rows, and wider
  periods (weeks, months) from the state alone;
* a refresh replaces the state of the days that a load touches and leaves the
  others, and the marts equal a full rebuild bit for bit (values of 1e15 and
  more are added as doubles, in whatever order they come);
* a stream can aggregate in two steps, per sequence number and then per window,
  which makes its distinct counts exact.

The daily median is the one output that does not merge; it is computed from the
rows of its day (:func:`exact_quantiles`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import EXACT_PIECES, exact_sum_sql, exact_total_sql, time_bucket
from feeflow.operators.marts import (
    DAILY_AGGS,
    HOURLY_AGGS,
    INTEGER_COLUMNS,
    MINUTE_AGGS,
    daily_alerts,
    hourly_alerts,
    minute_alerts,
    round_outputs,
)
from feeflow.operators.quantiles import _ns_join, exact_quantiles

STATUS = "network_congestion_status"
STATE_TIME = "time_minute"
SEQUENCES = "sequence_block"      # sequence numbers by bitmap: 32,768 of them a block
BITMAP = "sequences"

_SPECS = [*DAILY_AGGS, *HOURLY_AGGS, *MINUTE_AGGS]


def _columns(*kinds: str) -> list[str]:
    return list(dict.fromkeys(c for _, k, c in _SPECS if k in kinds))


def _measures() -> dict[str, tuple[str, str]]:
    """State column -> (aggregate of rows, aggregate that merges states)."""
    found = {"rows": ("count(1)", "sum")}
    for c in _columns("avg", "sum"):
        found[f"{c}__n"] = (f"count(`{c}`)", "sum")
        if c in INTEGER_COLUMNS:
            found[f"{c}__sum"] = (f"CAST(sum(`{c}`) AS BIGINT)", "sum")
        else:
            for piece, sql in exact_sum_sql(c).items():
                found[f"{c}__{piece}"] = (sql, "sum")
    for kind in ("max", "min"):
        found.update({f"{c}__{kind}": (f"{kind}(`{c}`)", kind) for c in _columns(kind)})
    return found


MEASURES = _measures()
MEDIAN = [(name, c) for name, kind, c in DAILY_AGGS if kind == "median"]


def row_measures() -> list[Column]:
    """The state's measures as aggregates of intermediate rows."""
    return [F.expr(sql).alias(name) for name, (sql, _) in MEASURES.items()]


def merged_measures() -> list[Column]:
    """The state's measures as aggregates of states."""
    return [F.expr(f"CAST(sum(`{name}`) AS BIGINT)" if how == "sum" and not name.endswith("__far")
                   else f"{how}(`{name}`)").alias(name) for name, (_, how) in MEASURES.items()]


def mart_state(inter: DataFrame, time_col: str = "enqueued_time") -> DataFrame:
    """The state of intermediate rows, per minute, status and block of
    sequence numbers (NULL where the number is)."""
    seq = F.col("sequence_number")
    keys = [time_bucket(time_col, "minute").alias(STATE_TIME), F.col(STATUS),
            F.bitmap_bucket_number(seq).alias(SEQUENCES)]
    names = [STATE_TIME, STATUS, SEQUENCES]
    used = dict.fromkeys(_columns("avg", "sum", "max", "min"))
    rows = inter.select(*[k.alias(name) for k, name in zip(keys, names)], F.bitmap_bit_position(seq).alias("_bit"),
                        *[F.col(c) for c in used if c not in names])
    # the rows move, not the many sums made of each of them; the sequence numbers
    # of a minute first: their rows merge by hash, and the bitmaps are built from
    # one row per number
    per_number = rows.repartition(*names).groupBy(*names, "_bit").agg(*row_measures())
    return per_number.groupBy(*names).agg(*merged_measures(), F.bitmap_construct_agg("_bit").alias(BITMAP))


def merged_state(state: DataFrame, unit: str, bucket: str, by_status: bool = True) -> DataFrame:
    """States of a coarser time unit, one row per bucket (and status), with the
    exact number of distinct sequence numbers (``blocks``) and the rows of each
    status."""
    keys = [time_bucket(STATE_TIME, unit).alias(bucket), *([F.col(STATUS)] if by_status else [])]
    names = [bucket, *([STATUS] if by_status else [])]
    classes = {f"rows_{i}": label for i, label in enumerate(S.CONGESTION_LABELS)}
    merged = state.groupBy(*keys).agg(*merged_measures(), *[
        F.sum(F.when(F.col(STATUS) == label, F.col("rows")).otherwise(0)).cast("bigint").alias(c)
        for c, label in classes.items()])
    # the bitmaps are merged apart from the measures, which are few rows a task
    seen = state.where(F.col(SEQUENCES).isNotNull()).groupBy(*keys, SEQUENCES).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP)) \
        .groupBy(*names).agg(F.sum(F.bitmap_count(BITMAP)).cast("bigint").alias("blocks"))
    return _ns_join(merged, seen, names, "left").withColumn("blocks", F.coalesce("blocks", F.lit(0).cast("bigint")))


def _output(kind: str, c: str) -> Column:
    """A mart's column from merged measures."""
    if kind == "count_distinct":
        return F.col("blocks")
    if kind == "count_status":
        return F.col(f"rows_{S.CONGESTION_LABELS.index(c)}")
    if kind in ("max", "min"):
        return F.col(f"{c}__{kind}")
    if kind == "sum":
        return F.col(f"{c}__sum")
    if kind == "avg" and c in INTEGER_COLUMNS:
        return F.expr(f"CASE WHEN `{c}__n` > 0 THEN CAST(`{c}__sum` AS DOUBLE) / `{c}__n` END")
    if kind == "avg":
        total = exact_total_sql({p: f"`{c}__{p}`" for p in EXACT_PIECES})
        return F.expr(f"CASE WHEN `{c}__n` > 0 THEN {total} / `{c}__n` END")
    raise ValueError(kind)


def _outputs(merged: DataFrame, names: list[str], spec: list, alerts: list[Column],
             precision: int | None) -> DataFrame:
    out = merged.select(*names, *[_output(k, c).alias(n) for n, k, c in spec], *alerts)
    return round_outputs(out, spec, precision)


def _avg(c: str) -> Column:
    return _output("avg", c)


def hourly_from_state(state: DataFrame, precision: int | None = None) -> DataFrame:
    """The hourly mart of a state."""
    return hourly_outputs(merged_state(state, "hour", "time_hour"), precision)


def minute_from_state(state: DataFrame, precision: int | None = None) -> DataFrame:
    """The minute mart of a state."""
    return minute_outputs(merged_state(state, "minute", "time_minute"), precision)


def minute_outputs(merged: DataFrame, precision: int | None = None) -> DataFrame:
    alerts = minute_alerts(F.col("fee_p99__max"), F.col("fee_skewness_ratio__max"),
                           F.col("number_of_transactions__sum"))
    return _outputs(merged, ["time_minute", STATUS], MINUTE_AGGS, alerts, precision)


def hourly_outputs(merged: DataFrame, precision: int | None = None) -> DataFrame:
    alerts = hourly_alerts(_avg("median_fee"), F.col("fee_skewness_ratio__max"))
    return _outputs(merged, ["time_hour", STATUS], HOURLY_AGGS, alerts, precision)


def daily_from_state(state: DataFrame, rows: DataFrame | None = None, precision: int | None = None,
                     time_col: str = "enqueued_time") -> DataFrame:
    """The daily mart of a state.  ``rows``, the intermediate rows of the
    state's days, give the medians; without them that column is left out."""
    return period_from_state(state, "day", rows, precision, "mempool_date", time_col)


def period_from_state(state: DataFrame, unit: str, rows: DataFrame | None = None, precision: int | None = None,
                      bucket: str = "period_start", time_col: str = "enqueued_time") -> DataFrame:
    """The daily mart's columns per day, week, month, quarter or year.  Read
    from the state alone unless ``rows`` are given for the exact medians."""
    spec = [x for x in DAILY_AGGS if x[1] != "median"]
    high, p99 = F.col(f"rows_{S.CONGESTION_LABELS.index(S.HIGH)}"), F.col("fee_p99__max")
    out = _outputs(merged_state(state, unit, bucket, by_status=False), [bucket], spec, daily_alerts(high, p99), None)
    if rows is not None:
        keyed = rows.select(time_bucket(time_col, unit).alias(bucket), *{c for _, c in MEDIAN})
        for name, c in MEDIAN:
            out = _ns_join(out, exact_quantiles(keyed, [bucket], c, [0.5], [name]), [bucket], "left")
        spec = DAILY_AGGS
    alerts = ["daily_network_stress_alert", "daily_fee_volatility_alert"]
    return round_outputs(out.select(bucket, *[n for n, _, _ in spec], *alerts), spec, precision)
