"""Sources and sinks: capture scans, bronze, parsed table, snapshots, fallback."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from paths import SF001
from feeflow.operators.marts import mart_hourly
from feeflow.plans.model_run import intermediate_from_tables, run_models, staging_from_tables
from feeflow.sources import fixtures as X
from feeflow.sources import sinks as K


def test_read_capture_recursive_and_merge_schema(spark, scratch):
    a, b = os.path.join(scratch, "cap", "day=1", "x"), os.path.join(scratch, "cap", "day=2")
    spark.createDataFrame([(1, "a")], "SequenceNumber long, EnqueuedTimeUtc string").write.parquet(a)
    spark.createDataFrame([(2, "b", 3)], "SequenceNumber long, EnqueuedTimeUtc string, extra int").write.parquet(b)
    df = K.read_capture(spark, os.path.join(scratch, "cap"), "parquet", merge_schema=True)
    assert sorted(r.SequenceNumber for r in df.collect()) == [1, 2]
    assert "extra" in df.columns


def test_landing_inventory(spark):
    inv = K.landing_inventory(spark, SF001, "orders*.parquet").collect()
    assert len(inv) == 1 and inv[0].path.endswith("orders.parquet") and inv[0].length > 0


def test_bronze_roundtrip(spark, scratch):
    cap = X.capture_from_orders(spark, SF001)
    path = os.path.join(scratch, "bronze")
    K.write_bronze(cap, path)
    back = K.read_bronze(spark, path)
    assert back.count() == cap.count()


def test_parsed_table_partitioned_and_pruned(spark, scratch):
    parsed = X.parsed_from_orders(spark, SF001)
    path = os.path.join(scratch, "parsed")
    K.write_parsed(parsed, path)
    days = sorted(d for d in os.listdir(path) if d.startswith("event_date="))
    assert len(days) == 9
    loaded = K.load_parsed(spark, path)
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, parsed.collect()))
    one = spark.read.parquet(path).where(F.col("event_date") == F.lit(dt.date(2026, 9, 18)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_typed_load_bad_values_become_null(spark):
    landing = spark.createDataFrame(
        [('{"sequence_number": "x", "enqueued_time": "9/17/2026 1:00:00 AM", "n_tx": 5, "fee_p10": "oops"}',),
         ("not json",)], "value string")
    rows = K.typed_load(landing).collect()
    assert rows[0].sequence_number is None and rows[0].n_tx == 5 and rows[0].fee_p10 is None
    assert rows[0].enqueued_time == dt.datetime(2026, 9, 17, 1, 0, 0)
    assert all(v is None for v in rows[1])


def test_materialize_clustered(spark, scratch):
    daily = run_models(staging_from_tables(spark, SF001)).daily
    out = K.materialize(daily, os.path.join(scratch, "daily"), cluster_by=["mempool_date"], files_per_partition=3)
    assert out.count() == 9
    assert K.materialize(daily, "unused", kind="view") is daily


def test_snapshot_export_and_fallback(spark, scratch):
    hourly = mart_hourly(intermediate_from_tables(spark, SF001))
    snap_path = os.path.join(scratch, "hourly_snapshot")
    hourly.createOrReplaceTempView("fct_hours_test")
    df, source = K.load_mart(spark, "fct_hours_test", snap_path, "time_hour", n=20)
    assert source == "live" and df.count() == 20 and all(c == c.lower() for c in df.columns)
    assert K.load_mart(spark, "fct_hours_test", snap_path, "time_hour")[1] == "cached"  # within 60 s
    df2, source2 = K.load_mart(spark, "missing_table_xyz", snap_path, "time_hour", reuse_seconds=0)
    assert source2 == "snapshot" and df2.count() == 20
    # a live read that fails at run time leaves the snapshot as it was
    spark.table("fct_hours_test").withColumn("time_hour", F.raise_error(F.lit("down")).cast("timestamp_ntz")) \
        .createOrReplaceTempView("fct_hours_down")
    df3, source3 = K.load_mart(spark, "fct_hours_down", snap_path, "time_hour", n=20, reuse_seconds=0)
    assert source3 == "snapshot" and sorted(map(tuple, df3.collect())) == sorted(map(tuple, df2.collect()))
    with pytest.raises(RuntimeError):
        K.load_mart(spark, "missing_table_xyz", os.path.join(scratch, "nope"), "time_hour")


def test_model_run_checks_pass(spark):
    from feeflow.operators.quality import all_passed, mart_invariants

    m = run_models(staging_from_tables(spark, SF001))
    assert all_passed(m.tests)
    assert all_passed(mart_invariants(m.daily))
    # hourly rows summed over statuses equal the daily totals
    h = m.hourly.groupBy(F.to_date("time_hour").alias("d")).agg(F.sum("total_transactions").alias("t"))
    d = m.daily.select(F.to_date("mempool_date").alias("d"), F.col("total_daily_transactions").alias("t"))
    assert sorted(map(tuple, h.collect())) == sorted(map(tuple, d.collect()))


def test_upsert_and_table_high_water_mark(spark, scratch):
    from feeflow.operators.staging import stage, table_high_water_mark, upsert

    target = os.path.join(scratch, "staging")
    assert table_high_water_mark(spark, target) is None  # empty target -> full load
    st = stage(X.parsed_from_orders(spark, SF001))
    first = st.where(F.col("enqueued_time") < F.lit(dt.datetime(2026, 9, 20)))
    upsert(spark, target, first)
    assert table_high_water_mark(spark, target) == first.agg(F.max("enqueued_time")).first()[0]
    null_row = st.limit(1).withColumn("enqueued_time", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("mempool_id", F.lit("null-time-key"))
    upsert(spark, target, null_row)
    touched = upsert(spark, target, st.where(F.col("enqueued_time") >= F.lit(dt.datetime(2026, 9, 19))))
    assert touched == 7
    got = spark.read.parquet(target)
    assert got.where(F.col("mempool_id") == "null-time-key").count() == 1  # untouched NULL-day row survives
    assert got.count() == st.select("mempool_id").distinct().count() + 1
    assert table_high_water_mark(spark, target) == st.agg(F.max("enqueued_time")).first()[0]


def test_overwrite_replaces_the_whole_table(spark, scratch):
    parsed = X.parsed_from_orders(spark, SF001)
    path = os.path.join(scratch, "parsed")
    K.write_parsed(parsed, path)
    day = parsed.where(F.to_date("enqueued_time") == F.lit(dt.date(2026, 9, 18)))
    K.write_parsed(day, path)
    assert K.load_parsed(spark, path).count() == day.count() < parsed.count()
    table = os.path.join(scratch, "table")
    K.materialize(parsed, table, partition_by=["block_index"])
    assert K.materialize(parsed.where("block_index = 1"), table, partition_by=["block_index"]).count() == \
        parsed.where("block_index = 1").count()


def test_text_times_and_missing_columns_load(spark, scratch):
    path = os.path.join(scratch, "landed")
    spark.createDataFrame([(1, "9/17/2026 1:00:00 AM"), (2, "2026-09-17 02:00:00"), (3, "soon"), (4, None)],
                          "sequence_number long, enqueued_time string").write.parquet(path)
    rows = {r.sequence_number: r for r in K.load_parsed(spark, path).collect()}
    assert rows[1].enqueued_time == dt.datetime(2026, 9, 17, 1) and rows[2].enqueued_time == dt.datetime(2026, 9, 17, 2)
    assert rows[3].enqueued_time is None and rows[1].fee_p99 is None and len(rows[1]) == 15
    assert tuple(K.unread_times(spark.read.parquet(path)).first()) == (4, 1)


def test_table_exists_only_hides_missing_data(spark, scratch):
    assert not K.table_exists(spark, os.path.join(scratch, "none"))
    broken = os.path.join(scratch, "broken")
    os.makedirs(broken)
    assert not K.table_exists(spark, broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|file"):
        K.table_exists(spark, broken)


def test_checkpoint_folder_is_required_off_a_local_master():
    from types import SimpleNamespace

    from feeflow import session

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                              getConf=lambda: SimpleNamespace(get=lambda *a: None))
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(fake)


def test_scratch_copies_are_removed(spark, monkeypatch):
    from feeflow import session

    monkeypatch.setattr(session, "_SCRATCH", {})
    kept = session.materialize_shared(spark.range(5).toDF("x"), "gone")
    folder = session._SCRATCH[spark.sparkContext.applicationId][0]
    assert kept.count() == 5 and K.table_exists(spark, folder)
    assert session.drop_scratch(spark) == 1 and not K.table_exists(spark, folder)


def test_a_changed_input_is_read_anew(spark, scratch):
    folder = os.path.join(scratch, "events.parquet")
    spark.range(3).write.parquet(folder)
    assert X.read_table(spark, scratch, "events").count() == 3
    spark.range(7).write.mode("overwrite").parquet(folder)
    assert X.read_table(spark, scratch, "events").count() == 7


def test_an_order_beyond_an_int_keeps_its_row(spark, scratch):
    spark.createDataFrame([(1, "O", 5.0)], "o_orderkey long, o_orderstatus string, o_totalprice double") \
        .write.parquet(os.path.join(scratch, "orders.parquet"))
    spark.range(90_000).selectExpr("1L AS l_orderkey", "30.0D AS l_quantity", "2.0D AS l_extendedprice") \
        .write.parquet(os.path.join(scratch, "lineitem.parquet"))
    row = X.parsed_from_orders(spark, scratch).first()
    assert row.n_tx is None and row.block_size == 90_000 * 200
