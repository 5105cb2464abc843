"""Column expressions shared by batch and stream jobs.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feeflow import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- keys -------------------------------------------------------------------

def key_text(c, dtype: T.DataType | None = None) -> Column:
    """Canonical text of one key part; timestamps at microsecond precision."""
    col = _c(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        txt = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        txt = col.cast("string")
    return F.coalesce(txt, F.lit(S.SURROGATE_NULL_TOKEN))


def surrogate_key(df: DataFrame, *cols: str) -> Column:
    """Deterministic md5 key of several columns; NULL and '' stay different."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.md5(F.concat_ws("-", *[key_text(c, types.get(c)) for c in cols]))


# -- classification -----------------------------------------------------------

def congestion_status(median_fee="median_fee") -> Column:
    """High above 50, Moderate from 20 to 50 (both ends), else - NULL too - Low."""
    m = _c(median_fee)
    return (
        F.when(m > S.CONGESTION_HIGH_ABOVE, F.lit(S.HIGH))
        .when(m.between(S.CONGESTION_MODERATE_FROM, S.CONGESTION_HIGH_ABOVE), F.lit(S.MODERATE))
        .otherwise(F.lit(S.LOW))
    )


def first_nonzero_sql(*cols: str, default: str = "0.0D") -> str:
    """First column value that is present and non-zero, else ``default``."""
    picks = ", ".join(f"CASE WHEN `{c}` <> 0 THEN `{c}` END" for c in cols)
    return f"coalesce({picks}, {default})"


def status_class_sql(col: str) -> str:
    """'normal' when the upper-cased status contains a normal word, else 'alert'."""
    up = f"upper(CAST(`{col}` AS STRING))"
    hit = " OR ".join(f"contains({up}, '{w}')" for w in S.NORMAL_STATUS_WORDS)
    return f"CASE WHEN coalesce({hit}, false) THEN 'normal' ELSE 'alert' END"


def safe_ratio(num, den, otherwise=0.0) -> Column:
    """``num / den`` as double when ``den > 0``; ``otherwise`` (NULL allowed) else."""
    n, d = _c(num), _c(den)
    res = F.when(d > 0, n.cast("double") / d.cast("double"))
    return res if otherwise is None else res.otherwise(F.lit(float(otherwise)))


# -- parsing helpers ----------------------------------------------------------

def parse_event_time(c, fmt: str = S.CAPTURE_TIME_FORMAT) -> Column:
    """Capture-time text -> TIMESTAMP_NTZ; unparsable text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def fee_percentile_columns(fee_range) -> list[Column]:
    """Positions 0..6 of the fee array as fee_p10..fee_p99; short array -> NULL.

    ``get`` instead of ``[]``: under ANSI mode ``[]`` raises on a short array.
    """
    arr = _c(fee_range)
    return [F.get(arr, i).cast("double").alias(name) for i, name in enumerate(S.FEE_PERCENTILE_COLUMNS)]


def epoch_seconds(ts) -> Column:
    """Epoch seconds (bigint) of a timestamp; NTZ is read as UTC wall time."""
    return F.unix_timestamp(_c(ts).cast("timestamp")).cast("bigint")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


# -- time buckets -------------------------------------------------------------

def time_bucket(c, unit: str) -> Column:
    """``date_trunc`` kept as TIMESTAMP_NTZ (zone-less, like the source)."""
    return F.date_trunc(unit, _c(c)).cast("timestamp_ntz")


def number_format(c, decimals: int) -> Column:
    return F.format_number(_c(c), decimals)


# -- reproducible averages and rounding -----------------------------------------

_PIECE = 1 << 26

EXACT_PIECES = ("whole", "high", "low", "far")


def exact_sum_sql(c: str, floor_type: str = "BIGINT") -> dict[str, str]:
    """SQL text of the sums that make an exact average, by name.  All but
    ``far`` (values of 1e15 and more) are integers, so sums of parts of the rows
    add up to the sums of all rows."""
    x = f"CAST(`{c}` AS DOUBLE)"
    near = f"abs({x}) < 1e15D"
    rest = f"({x} - floor({x})) * {_PIECE}.0D"
    return {
        "whole": f"sum(CASE WHEN {near} THEN CAST(floor({x}) AS {floor_type}) ELSE 0 END)",
        "high": f"sum(CASE WHEN {near} THEN CAST(floor({rest}) AS {floor_type}) ELSE 0 END)",
        "low": f"sum(CASE WHEN {near} THEN CAST(floor(({rest} - floor({rest})) * {_PIECE}.0D) AS {floor_type}) "
               "ELSE 0 END)",
        "far": f"coalesce(sum(CASE WHEN NOT ({near}) THEN {x} END), 0.0D)",
    }


def exact_total_sql(pieces: dict[str, str]) -> str:
    """SQL text of the total that the sums of :func:`exact_sum_sql` stand for."""
    return (f"(CAST({pieces['whole']} AS DOUBLE) + CAST({pieces['high']} AS DOUBLE) / {_PIECE}.0D "
            f"+ CAST({pieces['low']} AS DOUBLE) / {float(_PIECE) ** 2!r}D + {pieces['far']})")


def exact_avg_sql(c: str, floor_type: str = "BIGINT") -> str:
    """SQL text of an average that does not depend on the summation order.

    A plain sum of doubles changes its last bits with the partitioning.  Here
    every value is cut, exactly, into its whole part and two 26-bit pieces of
    its fraction (52 bits; what lies below 2^-52 is beyond the double's own
    precision from 1 up); the pieces are integers, so their sums are exact.
    Values of 1e15 and more, infinities and NaN are added as they are.
    """
    return f"(CASE WHEN count(`{c}`) > 0 THEN {exact_total_sql(exact_sum_sql(c, floor_type))} / count(`{c}`) END)"


def round_sql(expr: str, digits: int) -> str:
    """SQL text of :func:`round_to` over a SQL expression."""
    x = f"CAST(({expr}) AS DOUBLE)"

    def step(v: str, d: int) -> str:
        return f"(rint({v} * {float(10 ** d)!r}D) / {float(10 ** d)!r}D)"

    return step(step(x, digits + 3), digits)


def round_to(c: str, digits: int) -> Column:
    """Round a column, for comparing results between engines.

    ``rint(x * 10^d) / 10^d``, first at three more digits: multiplication,
    rounding to the nearest whole double and division are exactly specified,
    so any engine that evaluates them returns the same double at every
    magnitude.  Stored tables are not rounded.
    """
    return F.expr(round_sql(f"`{c}`", digits))
