"""End-to-end jobs on the captured-message fixture, including a replayed run."""

import datetime as dt
import os

import pytest

from paths import SF001
from feeflow import schemas as S
from feeflow.operators import parse as P
from feeflow.operators.features import intermediate
from feeflow.operators.marts import mart_daily, mart_minute
from feeflow.operators.quality import all_passed
from feeflow.operators.staging import stage
from feeflow.plans import jobs as J
from feeflow.sources import fixtures as X
from feeflow.sources.sinks import load_parsed, read_snapshot, write_parsed


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ingest_models_snapshot_end_to_end(spark, scratch):
    cap_path, parsed, quarantine, staging, marts, snaps = (
        os.path.join(scratch, n) for n in ("capture", "parsed", "quarantine", "staging", "marts", "snaps"))
    cap = X.capture_from_orders(spark, SF001)
    junk = spark.createDataFrame([(1, "9/17/2026 1:00:00 AM", b"{not json")], cap.schema)
    cap.unionByName(junk).write.parquet(cap_path)

    J.ingest(spark, cap_path, parsed, quarantine)
    J.ingest(spark, cap_path, parsed, quarantine)  # a replay changes nothing
    assert spark.read.parquet(quarantine).count() == 1

    out = J.models(spark, parsed, staging, marts)
    assert all_passed(out.tests)
    expected_inter = intermediate(stage(P.parse_messages(cap)))
    assert _rows(out.daily) == _rows(mart_daily(expected_inter))
    assert _rows(out.minute) == _rows(mart_minute(expected_inter))

    # a second run over the same parsed table: the look-back overlap is
    # merged by key, so the marts do not change
    again = J.models(spark, parsed, staging, os.path.join(scratch, "marts2"))
    assert again.touched_days >= 1
    assert _rows(again.daily) == _rows(out.daily)

    J.snapshot(spark, marts, snaps)
    snap = read_snapshot(spark, os.path.join(snaps, "fct_minutes_snapshot"))
    assert snap.count() == min(500, out.minute.count())


def test_ingest_without_a_good_row(spark, scratch):
    cap_path, parsed, quarantine = (os.path.join(scratch, n) for n in ("capture", "parsed", "bad"))
    spark.createDataFrame([(1, "9/17/2026 1:00:00 AM", b"{no")], S.CAPTURE).write.parquet(cap_path)
    assert J.ingest(spark, cap_path, parsed, quarantine).count() == 0
    assert spark.read.parquet(quarantine).count() == 1


def test_incremental_scan_prunes_days_and_equals_full(spark, scratch):
    parsed = X.parsed_from_orders(spark, SF001)
    path, staging = os.path.join(scratch, "parsed"), os.path.join(scratch, "staging")
    # the rows of one message fall into different loads
    first = parsed.where("block_index = 0 or enqueued_time < TIMESTAMP_NTZ '2026-09-19 00:00:00'")
    write_parsed(first, path)
    J.models(spark, path, staging, os.path.join(scratch, "m1"))
    write_parsed(parsed, path)
    J.models(spark, path, staging, os.path.join(scratch, "m2"), lookback_seconds=20 * 86400)
    cols = intermediate(stage(parsed)).columns
    got = intermediate(spark.read.parquet(staging).drop("event_date")).select(*cols)
    assert _rows(got) == _rows(intermediate(stage(parsed)))
    scan = load_parsed(spark, path, since=dt.datetime(2026, 9, 24, 1))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2026-09-24" in plan
    assert J.late_rows(spark, path, staging).count() == 0


def test_failing_declared_test_keeps_the_old_marts(spark, scratch, monkeypatch):
    path, staging, marts = (os.path.join(scratch, n) for n in ("parsed", "staging", "marts"))
    write_parsed(X.parsed_from_orders(spark, SF001), path)
    before = J.models(spark, path, staging, marts).daily.count()
    monkeypatch.setattr(J, "run_declared_tests", lambda df: spark.createDataFrame(
        [("not_null", "mempool_id", 3)], "test string, column_name string, failures long"))
    with pytest.raises(ValueError, match="not_null"):
        J.models(spark, path, staging, marts)
    assert spark.read.parquet(os.path.join(marts, "fct_daily")).count() == before
