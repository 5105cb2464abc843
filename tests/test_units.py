"""Hand-written unit rows for the semantics the fixture mapping does not reach."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feeflow import schemas as S
from feeflow.functions.expressions import (
    congestion_status,
    exact_avg_sql,
    first_nonzero_sql,
    parse_event_time,
    round_to,
    status_class_sql,
    surrogate_key,
)
from feeflow.operators import parse as P
from feeflow.operators.features import features
from feeflow.operators.marts import mart_daily, mart_hourly, mart_minute
from feeflow.operators.staging import incremental_slice, latest_per_key, stage

INTER_SCHEMA = T.StructType(
    [
        T.StructField("mempool_id", T.StringType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("enqueued_time", T.TimestampNTZType()),
        T.StructField("block_size", T.LongType()),
        T.StructField("block_vsize", T.LongType()),
        T.StructField("number_of_transactions", T.IntegerType()),
        T.StructField("total_fees", T.LongType()),
        T.StructField("median_fee", T.DoubleType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in S.FEE_PERCENTILE_COLUMNS]
)

T0 = dt.datetime(2026, 9, 17, 10, 0, 0)


def staged_rows(spark, rows):
    """rows: dicts over INTER_SCHEMA columns (missing -> NULL)."""
    data = [tuple(r.get(f.name) for f in INTER_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, INTER_SCHEMA)


def inter_rows(spark, rows):
    return features(staged_rows(spark, rows))


def test_congestion_borders(spark):
    df = spark.createDataFrame([(19.999,), (20.0,), (50.0,), (50.0001,), (None,)], "m double")
    got = [r[0] for r in df.select(congestion_status("m")).collect()]
    assert got == [S.LOW, S.MODERATE, S.MODERATE, S.HIGH, S.LOW]


def _one_group(spark, mart_fn, rows, col):
    out = mart_fn(inter_rows(spark, rows))
    return [r[col] for r in out.collect()]


def test_hour_fee_alert(spark):
    expect = {20.0: S.HOURLY_FEE_WARNING, 50.0: S.HOURLY_FEE_WARNING, 50.1: S.HOURLY_FEE_CRITICAL, None: S.HEALTHY}
    for med, want in expect.items():
        rows = [{"mempool_id": "a", "sequence_number": 1, "enqueued_time": T0, "median_fee": med}]
        # force one group: status is constant for a single row
        assert _one_group(spark, mart_hourly, rows, "hourly_fee_alert") == [want]


def test_minute_spike_whale_congestion(spark):
    for p99, want in {50.0: S.NORMAL, 50.1: S.MINUTE_SPIKE_WARNING, 100.0: S.MINUTE_SPIKE_WARNING,
                      100.1: S.MINUTE_SPIKE_CRITICAL, None: S.NORMAL}.items():
        rows = [{"mempool_id": "a", "sequence_number": 1, "enqueued_time": T0, "fee_p99": p99}]
        assert _one_group(spark, mart_minute, rows, "fee_spike_alert") == [want]
    for skew, want in {100.0: S.NORMAL, 100.1: S.MINUTE_WHALE_ALERT}.items():
        rows = [{"mempool_id": "a", "sequence_number": 1, "enqueued_time": T0, "fee_p10": 1.0, "fee_p99": skew}]
        assert _one_group(spark, mart_minute, rows, "fee_skewness_alert") == [want]
    for n, want in {150000: S.NORMAL, 150001: S.MINUTE_CONGESTION_ALERT}.items():
        rows = [{"mempool_id": "a", "sequence_number": 1, "enqueued_time": T0, "number_of_transactions": n}]
        assert _one_group(spark, mart_minute, rows, "congestion_alert") == [want]


def test_hour_skewness_alert(spark):
    for skew, want in {35.0: S.STABLE, 35.1: S.HOURLY_SKEW_ALERT}.items():
        rows = [{"mempool_id": "a", "sequence_number": 1, "enqueued_time": T0, "fee_p10": 1.0, "fee_p99": skew}]
        assert _one_group(spark, mart_hourly, rows, "hourly_skewness_alert") == [want]


def test_daily_alerts(spark):
    for p99, want in {300.0: S.STABLE, 300.1: S.DAILY_VOLATILITY_ALERT}.items():
        rows = [{"mempool_id": "a", "sequence_number": 1, "enqueued_time": T0, "fee_p99": p99}]
        assert _one_group(spark, mart_daily, rows, "daily_fee_volatility_alert") == [want]
    for n_high, want in {20: S.NORMAL, 21: S.DAILY_STRESS_ALERT}.items():
        rows = [{"mempool_id": str(i), "sequence_number": i, "enqueued_time": T0, "median_fee": 60.0}
                for i in range(n_high)]
        assert _one_group(spark, mart_daily, rows, "daily_network_stress_alert") == [want]


def test_denominators(spark):
    rows = [
        {"mempool_id": "zero", "block_size": 0, "block_vsize": 5, "total_fees": 7, "number_of_transactions": 0,
         "fee_p10": 0.0, "fee_p99": 3.0},
        {"mempool_id": "null", "block_size": None, "block_vsize": 5, "total_fees": 7},
        {"mempool_id": "neg", "block_size": -4, "block_vsize": 5, "total_fees": 7},
    ]
    got = {r["mempool_id"]: r for r in inter_rows(spark, rows).collect()}
    for k in ("zero", "null", "neg"):
        assert got[k]["block_compression_ratio"] == 0.0
        assert got[k]["miner_revenue_per_byte"] == 0.0
        assert got[k]["avg_fee_per_tx"] == 0.0
    assert got["zero"]["fee_skewness_ratio"] is None
    assert got["zero"]["network_congestion_status"] == S.LOW


def test_fee_array_positions(spark):
    arrays = [[], [1.0, 2.0, 3.0], [float(i) for i in range(7)], [float(i) for i in range(9)], None]
    df = spark.createDataFrame([(a,) for a in arrays], "fee_range array<double>")
    got = [tuple(r) for r in P.pivot_fee_range(df).collect()]
    assert got[0] == (None,) * 7
    assert got[1] == (1.0, 2.0, 3.0, None, None, None, None)
    assert got[2] == tuple(float(i) for i in range(7))
    assert got[3] == tuple(float(i) for i in range(7))
    assert got[4] == (None,) * 7


def _capture(spark, bodies):
    rows = [(i, "9/17/2026 10:00:00 AM", b.encode() if b is not None else None) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, S.CAPTURE)


def test_bodies_compat_and_routed(spark):
    good = '{"payload_type":"mempool_blocks_event","timestamp":1,"data":[{"blockSize":10,"nTx":2,"feeRange":[1,2]}]}'
    bodies = [
        "not json",
        '{"payload_type":"stats_event","timestamp":1,"data":{"a":1}}',
        '{"payload_type":"mempool_blocks_event","timestamp":1,"data":[]}',
        '{"payload_type":"block_event","timestamp":1}',
        '{"payload_type":"surprise","timestamp":1,"data":{"x":2}}',
        good,
    ]
    cap = P.decode_body(_capture(spark, bodies))
    ok, bad = P.split_corrupt(cap)
    assert bad.count() == 1
    rows = P.parse_messages(ok, mode="compat").orderBy("sequence_number").collect()
    assert len(rows) == 5
    assert [r["block_size"] for r in rows] == [None, None, None, None, 10]
    assert rows[-1]["fee_p25"] == 2.0 and rows[-1]["fee_p50"] is None
    routed = P.parse_messages(ok, mode="routed").collect()
    assert sorted(r["sequence_number"] for r in routed) == [2, 5]


def test_time_strings(spark):
    df = spark.createDataFrame(
        [("9/4/2026 1:02:03 PM",), ("09/04/2026 01:02:03 PM",), ("9/4/2026 12:00:00 AM",), ("junk",)], "s string")
    got = [r[0] for r in df.select(parse_event_time("s")).collect()]
    assert got == [dt.datetime(2026, 9, 4, 13, 2, 3), dt.datetime(2026, 9, 4, 13, 2, 3),
                   dt.datetime(2026, 9, 4, 0, 0, 0), None]


def test_surrogate_key_null_vs_empty(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a", "x"), ("a", "x")], "s string, t string")
    keys = [r[0] for r in df.select(surrogate_key(df, "s", "t")).collect()]
    assert keys[0] != keys[1]
    assert keys[2] == keys[3]


def test_dedup_tie_keeps_lowest_block_index(spark):
    parsed = spark.createDataFrame(
        [(1, T0, 1, 100), (1, T0, 0, 200), (2, T0, 0, 300)],
        "sequence_number long, enqueued_time timestamp_ntz, block_index int, block_size long")
    for c in ("block_vsize", "total_fees"):
        parsed = parsed.withColumn(c, F.lit(None).cast("long"))
    parsed = parsed.withColumn("median_fee", F.lit(None).cast("double")).withColumn("n_tx", F.lit(None).cast("int"))
    for c in S.FEE_PERCENTILE_COLUMNS:
        parsed = parsed.withColumn(c, F.lit(None).cast("double"))
    got = latest_per_key(stage(parsed)).collect()
    by_seq = {r["sequence_number"]: r["block_size"] for r in got}
    assert by_seq == {1: 200, 2: 300}
    # idempotent
    assert latest_per_key(latest_per_key(stage(parsed))).count() == 2


def test_frame_routing_and_fanout(spark):
    frame = ('{"block":{"height":1},"transactions":[{"txid":"a","fee":1,"vsize":2.0,"value":3,"rate":0.5},'
             '{"txid":"b","fee":2,"vsize":4.0,"value":5,"rate":0.5}]}')
    df = spark.createDataFrame([(1, T0, frame)], "sequence_number long, enqueued_time timestamp_ntz, frame string")
    ev = P.route_frames(df).collect()
    assert [r["payload_type"] for r in ev] == [S.BLOCK_EVENT]
    assert '"height":1' in ev[0]["data"]
    tx = P.explode_transactions(df).collect()
    assert [r["txid"] for r in tx] == ["a", "b"]
    assert all(r["payload_type"] == S.MEMPOOL_TX for r in tx)


def test_high_water_mark(spark):
    src = spark.createDataFrame(
        [(1, dt.datetime(2026, 9, 17, 0, 0, 9)), (2, dt.datetime(2026, 9, 17, 0, 0, 10)),
         (3, dt.datetime(2026, 9, 17, 0, 0, 11))], "k long, enqueued_time timestamp_ntz")
    target = src.where("k = 2")
    assert [r.k for r in incremental_slice(src, target).collect()] == [3]  # same second and earlier dropped
    empty = src.where("k < 0")
    assert incremental_slice(src, empty).count() == 3  # NULL mark -> full load
    assert incremental_slice(src, target, lookback_seconds=1).count() == 3
    plan = incremental_slice(src.sparkSession.read.parquet("/root/testdata/sf0.001/events.parquet")
                             .withColumnRenamed("ts", "enqueued_time"),
                             None, mark=dt.datetime(2024, 1, 10))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_first_nonzero_and_status_class(spark):
    df = spark.createDataFrame([(0.0, None, 5.0), (0.0, 0.0, None)], "a double, b double, c double")
    got = [r[0] for r in df.selectExpr(first_nonzero_sql("a", "b", "c", default="1.0D")).collect()]
    assert got == [5.0, 1.0]
    st = spark.createDataFrame([("NORMAL",), ("healthy",), ("Low Congestion",), ("STABLE",), (None,)], "s string")
    assert [r[0] for r in st.selectExpr(status_class_sql("s")).collect()] == ["normal", "normal", "normal", "alert", "alert"]


def test_round_to_ties_and_noise(spark):
    df = spark.createDataFrame([(145.2428045,), (145.24280449999998,), (-5e-7,), (1e13 + 0.123,), (None,), (-2.5e-7,),
                                (1000000000.1234567,)], "x double")
    got = [r[0] for r in df.select(round_to("x", 6)).collect()]
    assert got[0] == got[1] == 145.242804  # a tie goes to the even digit, with or without noise
    assert got[2] == 0.0
    assert got[3] == 1e13 + 0.123
    assert got[4] is None
    assert got[5] == 0.0
    assert got[6] == 1000000000.123457  # the same rule at every magnitude


def test_exact_average_ignores_order_and_keeps_digits(spark):
    import math
    import random

    random.seed(4)
    xs = [random.choice([1, -1]) * random.random() * 10 ** random.randint(-6, 11) for _ in range(5000)]
    rows = [("a", x) for x in xs] + [("b", None), ("c", 0.9501632702), ("d", 1e300), ("d", 3e300), ("e", float("inf")),
            ("f", 1234567890.125), ("f", 1234567890.875)]
    got = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, x double").repartition(7 if order is rows else 3)
        got.append({r[0]: r[1] for r in df.groupBy("k").agg(F.expr(exact_avg_sql("x"))).collect()})
    assert got[0] == got[1]
    assert math.isclose(got[0]["a"], math.fsum(xs) / len(xs), rel_tol=1e-14)
    assert got[0]["b"] is None and got[0]["c"] == 0.9501632702 and got[0]["d"] == 2e300
    assert got[0]["e"] == float("inf") and got[0]["f"] == 1234567890.5


def test_latest_per_key_with_a_hot_key(spark):
    n = 90_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', CAST(id AS STRING)) END AS mempool_id",
        "timestampadd(SECOND, CAST(id % 1000 AS INT), TIMESTAMP_NTZ '2026-09-17 00:00:00') AS enqueued_time",
        "CAST(id % 7 AS INT) AS block_index",
        "id AS block_size")
    out = latest_per_key(df, "mempool_id")
    assert out.count() == 1 + (n - n // 3)
    hot = out.where("mempool_id = 'hot'").first()
    # newest second among the hot rows is 999 (ids = 999 mod 1000 with id % 3 = 0), then lowest block_index
    exp = (df.where("mempool_id = 'hot'")
           .orderBy(F.col("enqueued_time").desc(), F.col("block_index").asc(), F.col("block_size").asc()).first())
    assert (hot.enqueued_time, hot.block_index, hot.block_size) == (exp.enqueued_time, exp.block_index, exp.block_size)
