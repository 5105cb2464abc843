"""Captured message -> flat block rows; live frame -> typed events.

All narrow transformations (no shuffle): ``from_json`` with a declared
schema, ``posexplode_outer`` and positional ``get``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feeflow import schemas as S
from feeflow.functions.expressions import epoch_seconds, fee_percentile_columns, parse_event_time

CORRUPT = "_corrupt_record"


def decode_body(df: DataFrame, body: str = "Body") -> DataFrame:
    """Binary body -> text column ``body_str``."""
    return df.withColumn("body_str", F.col(body).cast("string"))


def split_corrupt(df: DataFrame, text: str = "body_str") -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows whose text is not JSON go to a quarantine frame.

    ``try_parse_json`` is a built-in expression; both outputs stay lazy and
    are usually written to separate tables in one job each.
    """
    bad_flag = F.try_parse_json(F.col(text)).isNull()
    return df.where(~bad_flag), df.where(bad_flag)


def parse_capture(df: DataFrame, mode: str = "compat") -> DataFrame:
    """Captured messages -> ``sequence_number, enqueued_time, payload_type, timestamp, data``.

    ``mode='compat'`` keeps every message: a body whose ``data`` is not an
    array of blocks (stats, block events, junk) parses to ``data = NULL``
    and later gives one all-NULL row, as the modelled parse does.
    ``mode='routed'`` keeps only ``mempool_blocks_event`` bodies.
    """
    if "body_str" not in df.columns:
        df = decode_body(df)
    parsed = df.select(
        F.col("SequenceNumber").cast("bigint").alias("sequence_number"),
        parse_event_time(F.col("EnqueuedTimeUtc")).alias("enqueued_time"),
        F.from_json(F.col("body_str"), S.BLOCKS_ENVELOPE).alias("env"),
    ).select("sequence_number", "enqueued_time", "env.*")
    if mode == "routed":
        parsed = parsed.where(F.col("payload_type") == S.MEMPOOL_BLOCKS_EVENT)
    elif mode != "compat":
        raise ValueError(f"unknown parse mode {mode!r}")
    return parsed


def explode_blocks(df: DataFrame, keep_raw: bool = False) -> DataFrame:
    """One row per block item; NULL or empty ``data`` -> one all-NULL row.

    The item position is kept as ``block_index`` (deterministic dedup order).
    """
    ex = df.select("sequence_number", "enqueued_time", F.posexplode_outer("data").alias("block_index", "b"))
    cols = [
        F.col("sequence_number"),
        F.col("enqueued_time"),
        F.col("block_index").cast("int").alias("block_index"),
        F.col("b.blockSize").cast("bigint").alias("block_size"),
        F.col("b.blockVSize").alias("block_vsize"),
        F.col("b.medianFee").alias("median_fee"),
        F.col("b.nTx").alias("n_tx"),
        F.col("b.totalFees").alias("total_fees"),
        F.col("b.feeRange").alias("fee_range"),
    ]
    if keep_raw:
        cols.append(F.to_json("b").alias("raw_block_object"))
    return ex.select(*cols)


def pivot_fee_range(df: DataFrame, fee_range: str = "fee_range", drop: bool = True) -> DataFrame:
    """``fee_range[0..6]`` -> ``fee_p10 .. fee_p99``; short arrays give NULL."""
    out = df.select("*", *fee_percentile_columns(F.col(fee_range)))
    return out.drop(fee_range) if drop else out


def to_parsed(df: DataFrame) -> DataFrame:
    """Typed flat table (the 14 parsed columns plus ``block_index``).

    ``try_cast``: a value that does not fit (e.g. a fractional or huge
    ``blockVSize``) becomes NULL instead of failing the job under ANSI.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.PARSED.fields])


def parse_messages(df: DataFrame, mode: str = "compat") -> DataFrame:
    """Whole ingest parse: decode -> JSON -> explode -> pivot -> typed rows."""
    return to_parsed(pivot_fee_range(explode_blocks(parse_capture(df, mode))))


# -- live frames ---------------------------------------------------------------

def route_frames(df: DataFrame, frame: str = "frame", time_col: str = "enqueued_time") -> DataFrame:
    """One frame -> 0..n typed events, one per present key, each independent.

    A key counts as present also when its value is JSON null (``data`` is then
    the text ``null``); a frame that is not a JSON object gives no event.
    Output: the input's other columns plus ``payload_type``, ``timestamp``
    (epoch seconds of ``time_col``) and ``data`` (JSON text of the branch).
    ``explode`` of a compacted array keeps it a single narrow projection.
    """
    keep = [c for c in df.columns if c != frame]
    # in a projection of their own: each branch would parse the frame once more
    routed = StructType([S.FRAME[key] for key, _ in S.FRAME_ROUTES])
    read = df.select(*keep, F.from_json(F.col(frame), routed).alias("_parsed"),
                     F.json_object_keys(F.col(frame)).alias("_present"))
    branches = [
        F.when(F.array_contains("_present", key),
               F.struct(F.lit(ptype).alias("payload_type"),
                        F.coalesce(F.col("_parsed")[key], F.lit("null")).alias("data")))
        for key, ptype in S.FRAME_ROUTES
    ]
    ev = read.select(*keep, F.explode(F.array_compact(F.array(*branches))).alias("ev"))
    return ev.select(
        *keep,
        F.col("ev.payload_type").alias("payload_type"),
        epoch_seconds(time_col).alias("timestamp"),
        F.col("ev.data").alias("data"),
    )


def envelope_json(df: DataFrame) -> DataFrame:
    """Typed events as the JSON envelope text ``{payload_type, timestamp, data}``."""
    return df.select(
        F.to_json(
            F.struct(F.col("payload_type"), F.col("timestamp"), F.parse_json(F.col("data")).alias("data"))
        ).alias("event")
    )


def explode_transactions(df: DataFrame, frame: str = "frame") -> DataFrame:
    """``transactions[]`` of each frame -> one flat ``mempool_tx`` event per item."""
    parsed = F.from_json(F.col(frame), S.FRAME)
    keep = [c for c in df.columns if c != frame]
    ex = df.select(*keep, F.explode(parsed["transactions"]).alias("tx"))
    return ex.select(
        *keep,
        F.lit(S.MEMPOOL_TX).alias("payload_type"),
        *[F.col(f"tx.{f.name}").alias(f.name) for f in S.TX_ITEM.fields],
    )


def payload_fields(df: DataFrame, text: str = "body_str") -> DataFrame:
    """Field inventory over all bodies: payload type, field, JSON type (array,
    object, string, number, boolean or null) and the number of messages."""
    if text not in df.columns:
        df = decode_body(df)
    body = F.col(text)
    fields = df.where(F.try_parse_json(body).isNotNull()).select(
        F.get_json_object(body, "$.payload_type").alias("payload_type"), body.alias("_body"),
        F.explode(F.json_object_keys(body)).alias("field"))
    kind = F.schema_of_variant(F.try_variant_get(
        F.parse_json("_body"), F.concat(F.lit("$['"), F.col("field"), F.lit("']")), "variant"))
    word = F.regexp_extract(F.coalesce(kind, F.lit("VOID")), "^[A-Z]+", 0)
    json_type = (F.when(word.isin("ARRAY", "OBJECT", "STRING", "BOOLEAN"), F.lower(word))
                 .when(word == "VOID", "null").otherwise("number"))
    return fields.select("payload_type", "field", json_type.alias("json_type")) \
        .groupBy("payload_type", "field", "json_type").agg(F.count(F.lit(1)).alias("n_messages"))


def infer_payload_schema(df: DataFrame, text: str = "body_str") -> DataFrame:
    """Schema discovery over *all* bodies per payload type (not one sample).

    ``schema_of_variant_agg`` merges partial schemas map-side, so this is a
    small aggregate even at scale.  Fields whose shape differs between
    records come out as VARIANT.
    """
    if text not in df.columns:
        df = decode_body(df)
    v = F.try_parse_json(F.col(text))
    return (
        df.select(F.try_variant_get(v, "$.payload_type", "string").alias("payload_type"), v.alias("v"))
        .groupBy("payload_type")
        .agg(F.schema_of_variant_agg("v").alias("schema"), F.count(F.lit(1)).alias("n_messages"))
    )
