"""Serving helpers, envelopes, formats and the streaming alert feed."""

import json
import os

from pyspark.sql import functions as F

from paths import SF001
from feeflow import schemas as S
from feeflow.functions.expressions import number_format
from feeflow.operators import parse as P
from feeflow.operators import serving as V
from feeflow.plans.model_run import run_models, staging_from_tables
from feeflow.sources import fixtures as X
from feeflow.sources.sinks import register_sources
from feeflow.streaming import stream as ST


def test_envelope_and_raw_block(spark):
    frames = X.frames_from_parsed(X.parsed_from_orders(spark, SF001))
    env = P.envelope_json(P.route_frames(frames)).limit(5).collect()
    for r in env:
        d = json.loads(r.event)
        assert set(d) == {"payload_type", "timestamp", "data"}
        assert isinstance(d["timestamp"], int)
    raw = P.explode_blocks(P.parse_capture(X.capture_from_orders(spark, SF001)), keep_raw=True)
    row = raw.where(F.col("block_size").isNotNull()).first()
    assert json.loads(row.raw_block_object)["blockSize"] == row.block_size


def test_register_sources_and_preview(spark):
    parsed = X.parsed_from_orders(spark, SF001)
    register_sources(spark, {"stg_parsed_test": parsed})
    assert spark.sql("SELECT count(*) AS n FROM stg_parsed_test").first().n == parsed.count()
    assert V.preview(parsed, 10).count() == 10


def test_series_kpis_and_formats(spark):
    m = run_models(staging_from_tables(spark, SF001))
    asc = V.ascending(V.spike_series(m.minute), "time_minute").collect()
    times = [r.time_minute for r in asc]
    assert times == sorted(times)
    kpi = V.kpi_hourly(m.hourly).first()
    assert kpi.total_blocks >= 1 and kpi.congestion_class in ("normal", "alert")
    ctx = V.context_record(m.hourly, m.minute, as_json=True).first()
    assert set(json.loads(ctx.context)) >= {"network_congestion", "minute_fee_spike_alert"}
    corr = V.efficiency_correlation(m.daily).first()[0]
    assert corr is None or -1.0 <= corr <= 1.0
    fmt = spark.createDataFrame([(1234567.891,)], "x double").select(number_format("x", 2)).first()[0]
    assert fmt == "1,234,567.89"


def test_streaming_alert_feed_update_mode(spark, scratch):
    landing = os.path.join(scratch, "capture")
    X.capture_from_orders(spark, SF001).write.parquet(landing)
    feed = ST.alert_feed(ST.stream_capture(spark, landing), "1 hour")
    ST.run_available(feed, "alert_feed_test", os.path.join(scratch, "ckpt"), mode="update")
    rows = spark.table("alert_feed_test").collect()
    assert rows and all(
        r.fee_spike_alert != S.NORMAL or r.fee_skewness_alert != S.NORMAL or r.congestion_alert != S.NORMAL
        for r in rows)


def test_a_frame_is_parsed_once(spark):
    frames = X.frames_from_parsed(X.parsed_from_orders(spark, SF001))
    plan = P.envelope_json(P.route_frames(frames))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
