"""VARIANT landing, bucketed staging, schema registry, exact streams."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.operators import schema_registry as G
from feeflow.operators.features import intermediate
from feeflow.operators.marts import mart_hourly, mart_minute
from feeflow.operators.staging import latest_per_key, stage
from feeflow.plans.refresh import _with_day
from feeflow.operators import parse as P
from feeflow.sources import bucketed as B
from feeflow.sources import fixtures as X
from feeflow.sources import sinks as K
from feeflow.sources.releases import Warehouse
from feeflow.streaming import stream as ST
from paths import SF001


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- VARIANT ---------------------------------------------------------------------------------

def test_variant_load_equals_text_load_and_reads_fewer_bytes(spark, scratch):
    text = K.landing_json(X.landed_parsed(spark, SF001))
    odd = spark.createDataFrame([("{no",), (None,), ("[1]",), ('{"n_tx": "x", "block_size": 7.5, "median_fee": 1e400}',),
                                 ('{"sequence_number": 9223372036854775808, "enqueued_time": 5}',)], "value string")
    landing = text.unionByName(odd)
    landing.write.parquet(f"{scratch}/text")
    K.write_variant_landing(landing, f"{scratch}/variant")
    records = spark.read.parquet(f"{scratch}/variant")
    assert _rows(K.typed_load_variant(records)) == _rows(K.typed_load(spark.read.parquet(f"{scratch}/text")))

    def size(folder):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))

    assert size(f"{scratch}/variant") < size(f"{scratch}/text")
    one = records.select(F.try_variant_get("record", "$.total_fees", "bigint"))
    assert "ReadSchema: struct<record:struct<0:bigint>>" in _plan(one)       # the path reaches the scan


# -- buckets -----------------------------------------------------------------------------------

@pytest.fixture()
def table(spark):
    name = f"staging_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_upsert_moves_the_batch_only(spark, scratch, table):
    staged = stage(X.landed_parsed(spark, SF001))
    first = (F.col("block_index") == 1) | (F.col("enqueued_time") >= F.lit("2026-09-21 00:00:00").cast("timestamp_ntz"))
    B.write_bucketed(staged.where(first), table, f"{scratch}/t", 8)
    plan = _plan(B.merged_with(spark.table(table), _with_day(staged, "enqueued_time")))
    target_side = plan[plan.index("FullOuter"):plan.index("Exchange")]
    assert "Bucketed: true" in target_side.split("FileScan")[1]              # scan and sort, no exchange
    assert B.upsert_bucketed(spark, table, staged.where(~first), 8) == 4
    want = latest_per_key(staged)
    assert _rows(spark.table(table).select(*want.columns)) == _rows(want)
    assert B.upsert_bucketed(spark, table, staged, 8) == 9                   # a replay changes nothing
    assert _rows(spark.table(table).select(*want.columns)) == _rows(want)
    again = B.declare(spark, f"{table}_b", f"{scratch}/t", spark.table(table).schema, 8)
    assert _rows(again.select(*want.columns)) == _rows(want)
    assert "Exchange" not in _plan(again.groupBy("mempool_id").count())
    spark.sql(f"DROP TABLE {table}_b")


def test_bucketed_ties_nulls_and_null_days(spark, scratch, table):
    columns = "mempool_id string, enqueued_time timestamp_ntz, block_index int, block_size long, median_fee double"
    t = dt.datetime(2026, 9, 17)
    old = [("a", t, 0, 5, 1.0), ("b", t, None, 5, 1.0), ("c", t, 0, None, 1.0), ("d", None, 0, 1, 2.0), ("e", t, 0, 1, float("nan"))]
    new = [("a", t, 0, 4, 9.0), ("b", t, 1, 9, 9.0), ("c", t, 0, 8, 9.0), ("d", None, 0, 1, 1.5), ("e", t, 0, 1, 3.0),
           ("f", t, 0, 1, 1.0), ("f", t, 0, 1, 1.0), ("g", None, 2, 2, 2.0)]
    B.write_bucketed(spark.createDataFrame(old, columns), table, f"{scratch}/t", 4)
    B.upsert_bucketed(spark, table, spark.createDataFrame(new, columns), 4)
    want = latest_per_key(spark.createDataFrame(old + new, columns))
    assert _rows(spark.table(table).select(*want.columns)) == _rows(want)


# -- registry ------------------------------------------------------------------------------------

def _bodies(spark, *bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "SequenceNumber long, body_str string")


def test_registry_adds_widens_and_quarantines(spark, scratch):
    store = Warehouse(spark, scratch)
    good, bad, report = G.register_landing(store, _bodies(
        spark, '{"payload_type":"a","n":1,"x":null}', '{"payload_type":"b","n":"text"}', "{broken", "[1]", None, '{"n":[1]}'))
    assert good.count() == 6 and bad.count() == 0
    assert {(r.payload_type, r.field): (r.kind, r.change) for r in report.collect()} == {
        ("a", "payload_type"): ("string", "added"), ("a", "n"): ("long", "added"), ("a", "x"): ("null", "added"),
        ("b", "payload_type"): ("string", "added"), ("b", "n"): ("string", "added"), ("", "n"): ("array", "added")}
    good, bad, report = G.register_landing(store, _bodies(
        spark, '{"payload_type":"a","n":1.5,"x":{"y":1}}', '{"payload_type":"a","n":"7"}', '{"payload_type":"a","n":null,"it\'s":true}',
        '{"payload_type":"b","n":"t"}', '{"payload_type":"b","n":{"q":1}}'))
    assert sorted(r.SequenceNumber for r in bad.collect()) == [1, 4] and good.count() == 3
    found = {(r.payload_type, r.field): (r.kind, r.change, r.since_version, r.n_conflicts) for r in report.collect()}
    assert found["a", "n"] == ("double", "widened", 2, 1) and found["a", "x"] == ("object", "widened", 2, 0)
    assert found["a", "it's"] == ("boolean", "added", 2, 0) and found["b", "n"] == ("string", "same", 1, 1)
    assert found["", "n"] == ("array", "absent", 1, 0)
    # a landing that changes nothing makes no version; older versions stay readable
    G.register_landing(store, _bodies(spark, '{"payload_type":"a","n":3}'))
    assert store.versions() == [1, 2]
    assert {r.kind for r in G.registry(store, store.release(1)).where("payload_type = 'a' AND field = 'n'").collect()} == {"long"}
    assert {r.kind for r in G.registry(store).where("payload_type = 'a' AND field = 'n'").collect()} == {"double"}


def test_registry_of_nothing(spark, scratch):
    store = Warehouse(spark, scratch)
    good, bad, report = G.register_landing(store, _bodies(spark, '{"a":1}').limit(0))
    assert good.count() == bad.count() == report.count() == 0 and store.versions() == []


def test_registry_is_one_narrow_pass(spark, scratch):
    known = spark.createDataFrame([("a", "n", "long", 1)], G.REGISTRY)
    good, _ = G.conform(_bodies(spark, '{"payload_type":"a","n":"x"}'), known)
    assert "Exchange" not in _plan(good) and "Join" not in _plan(good)


# -- exact streams ---------------------------------------------------------------------------------

@pytest.mark.parametrize("grain,batch,time_col", [("minute", mart_minute, "time_minute"), ("hour", mart_hourly, "time_hour")])
def test_append_mode_marts_are_exact_and_leave_no_state(spark, scratch, grain, batch, time_col):
    landing, out, ckpt = (os.path.join(scratch, n) for n in ("landing", "out", "ckpt"))
    cap = X.capture_from_orders(spark, SF001)
    cap.unionByName(cap).repartition(4, "SequenceNumber").write.parquet(landing)     # each message twice

    def run():
        mart = ST.exact_stream_mart(ST.stream_intermediate(ST.stream_capture(spark, landing)), grain)
        return ST.append_by_day(mart, out, ckpt, time_col)

    run()
    written = spark.read.parquet(out).count()
    # a message two days on closes every window; a late one is dropped, not merged
    spark.createDataFrame([(-1, "9/30/2026 1:00:00 AM", b"{}")], S.CAPTURE).write.mode("append").parquet(landing)
    run()
    spark.createDataFrame([(-2, "9/17/2026 1:00:00 AM", b"{}")], S.CAPTURE).write.mode("append").parquet(landing)
    q = run()
    want = batch(intermediate(stage(P.parse_messages(cap))))
    got = spark.read.parquet(out)
    assert got.count() >= written and _rows(got.select(*want.columns)) == _rows(want)   # total_blocks too
    assert ST.dropped_late_rows(q.recentProgress) == 1
    state = [op["numRowsTotal"] for op in q.lastProgress["stateOperators"]]
    assert len(state) == 3 and max(state) <= 1                                       # the last message's window
