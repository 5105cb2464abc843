"""Incremental refresh: releases, ledger, mergeable state, rules in the write."""

import datetime as dt
import os
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feeflow.operators.features import intermediate
from feeflow.operators.mart_state import (
    daily_from_state,
    hourly_from_state,
    mart_state,
    minute_from_state,
    period_from_state,
)
from feeflow.operators.marts import mart_daily, mart_hourly, mart_minute
from feeflow.operators.quality import RuleFailure, Watched, declared_rules, extra_rules
from feeflow.operators.serving import top_newest
from feeflow.operators.staging import latest_per_key, stage
from feeflow.plans import refresh as R
from feeflow.session import materialize_shared
from feeflow.sources import fixtures as X
from feeflow.sources.releases import Conflict, Warehouse
from paths import SF001


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def parsed(spark):
    return X.landed_parsed(spark, SF001)


@pytest.fixture(scope="module")
def inter(spark, parsed):
    return materialize_shared(intermediate(stage(parsed)), "test-intermediate")


# -- releases ------------------------------------------------------------------------------

def test_release_replaces_all_tables_at_once(spark, scratch):
    store = Warehouse(spark, scratch)
    assert store.release().version == 0 and store.versions() == []
    a, b = spark.range(5), spark.range(3).selectExpr("id AS x", "date'2026-01-01' + int(id) AS d")
    first = store.publish([store.prepare("a", a), store.prepare("b", b, "d")], store.release(), {"by": "test"})
    assert first.version == 1 and store.release().notes == {"by": "test"}
    assert _rows(store.read("a")) == _rows(a) and _rows(store.read("b")) == _rows(b)
    # only the touched day of b is replaced, a stays
    day = spark.sql("SELECT 7L AS x, date'2026-01-02' AS d")
    store.publish([store.prepare("b", day, "d", "touched")], first)
    assert sorted(r.x for r in store.read("b").collect()) == [0, 2, 7]
    assert [r.x for r in store.read("b", ["d=2026-01-02"]).collect()] == [7]
    assert sorted(r.x for r in store.read("b", release=first).collect()) == [0, 1, 2]   # still readable
    with pytest.raises(KeyError):
        store.read("c")


def test_failing_write_leaves_the_release(spark, scratch):
    store = Warehouse(spark, scratch)
    base = store.publish([store.prepare("a", spark.range(100))], store.release())
    broken = spark.range(100).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(PySparkException):
        store.publish([store.prepare("a", broken)], base)
    assert store.release().version == 1 and store.read("a").count() == 100
    # data that was written and not published is nobody's
    change = store.prepare("a", spark.range(3))
    assert store.read("a").count() == 100 and store.read_change(change).count() == 3
    store.abandon([change])
    assert not os.path.exists(f"{scratch}/data/a/{change.commit}")


def test_two_jobs_from_one_release_conflict(spark, scratch):
    store = Warehouse(spark, scratch)
    base = store.publish([store.prepare("a", spark.range(1))], store.release())
    changes = [store.prepare("a", spark.range(n)) for n in (2, 3, 4)]
    outcome = []

    def publish(c):
        try:
            store.publish([c], base)
            outcome.append("published")
        except Conflict:
            outcome.append("conflict")

    threads = [threading.Thread(target=publish, args=(c,)) for c in changes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert outcome.count("published") >= 1 and store.versions()[-1] == 2
    with pytest.raises(Conflict):
        store.publish([changes[0]], base)
    assert not [n for n in os.listdir(f"{scratch}/_releases") if "draft" in n and not n.endswith(".crc")]


def test_vacuum_keeps_what_releases_use(spark, scratch):
    store = Warehouse(spark, scratch)
    rows = spark.range(4).selectExpr("id", "date'2026-01-01' + int(id % 2) AS d")
    release = store.publish([store.prepare("t", rows, "d")], store.release())
    for n in (10, 20):
        day = spark.sql(f"SELECT {n}L AS id, date'2026-01-01' AS d")
        release = store.publish([store.prepare("t", day, "d", "touched")], release)
    orphan = store.prepare("t", rows, "d")
    assert store.vacuum(keep=1, older_than_seconds=3600) == 0      # all young: a job may be running
    assert store.vacuum(keep=1, older_than_seconds=0) == 3         # day 1 of release 1, release 2, the orphan
    assert store.versions() == [3] and sorted(r.id for r in store.read("t").collect()) == [1, 3, 20]
    assert not os.path.exists(f"{scratch}/data/t/{orphan.commit}")


def test_names_and_odd_partitions(spark, scratch):
    store = Warehouse(spark, scratch)
    df = spark.createDataFrame([(1, "x", None), (2, "y", dt.date(2026, 1, 1))], "`commit` int, `a b` string, d date")
    with pytest.raises(ValueError, match="commit"):
        store.prepare("t", df, "d")
    df = df.withColumnRenamed("commit", "n")
    store.publish([store.prepare("t", df, "d")], store.release())
    assert _rows(store.read("t")) == _rows(df) and store.read("t").columns == ["n", "a b", "d"]
    assert store.read("t", ["d=__HIVE_DEFAULT_PARTITION__"]).first().n == 1
    store.publish([store.prepare("t", df.limit(0), "d")], store.release())
    assert store.read("t").count() == 0 and store.read("t").columns == ["n", "a b", "d"]


# -- state -----------------------------------------------------------------------------------

def test_marts_of_merged_states_equal_full_marts(spark, parsed, inter):
    """State of two halves of the rows, one after the other, and of all rows."""
    half = F.col("sequence_number") % 2 == 0
    parts = [materialize_shared(mart_state(inter.where(c)), "half-state") for c in (half, ~half)]
    for state in (mart_state(inter), parts[0].unionByName(parts[1])):
        state = materialize_shared(state, "test-state")
        for got, want in ((minute_from_state(state), mart_minute(inter)), (hourly_from_state(state), mart_hourly(inter)),
                          (daily_from_state(state, inter), mart_daily(inter))):
            assert got.columns == want.columns and got.dtypes == want.dtypes
            assert _rows(got) == _rows(want)


def test_state_of_odd_rows(spark, inter):
    """Null times, numbers and payloads; repeated, huge and negative numbers."""
    rows = inter.limit(0).drop("sequence_number", "enqueued_time", "median_fee", "network_congestion_status")
    base = spark.createDataFrame(
        [(None, None, None, "Low Congestion"), (None, dt.datetime(2026, 9, 17, 1), 3.5, "Low Congestion"),
         (-5, dt.datetime(2026, 9, 17, 1), 60.25, "High Congestion"), (-5, dt.datetime(2026, 9, 17, 1), None, "Low Congestion"),
         (2**40, dt.datetime(2026, 9, 17, 1, 30), 0.1, "Low Congestion"), (32768, dt.datetime(2026, 9, 17, 1), 0.2, "Low Congestion"),
         (32769, dt.datetime(2026, 9, 17, 1), float("nan"), "Low Congestion"), (0, dt.datetime(2026, 9, 18), 0.7, "Low Congestion")],
        "sequence_number long, enqueued_time timestamp_ntz, median_fee double, network_congestion_status string")
    odd = base.unionByName(rows, allowMissingColumns=True).select(*inter.columns)
    odd = materialize_shared(odd, "odd-rows")
    state = materialize_shared(mart_state(odd), "odd-state")
    for got, want in ((minute_from_state(state), mart_minute(odd)), (hourly_from_state(state), mart_hourly(odd)),
                      (daily_from_state(state), mart_daily(odd, median="none"))):
        assert [str(r) for r in _rows(got)] == [str(r) for r in _rows(want)]
    assert mart_state(odd.limit(0)).count() == 0


def test_periods_come_from_the_state_alone(spark, inter):
    state = mart_state(inter)
    month = period_from_state(state, "month").first()
    want = inter.agg(F.count_distinct("sequence_number").alias("n"), F.sum("total_fees").alias("fees"),
                     F.max("fee_p99").alias("p99")).first()
    assert (month.total_blocks_processed, month.daily_total_miner_revenue, month.daily_max_p99_fee) == tuple(want)
    week = period_from_state(state, "week", inter, bucket="week")
    exact = {r.week: r.m for r in inter.groupBy(F.date_trunc("week", "enqueued_time").cast("timestamp_ntz").alias("week"))
             .agg(F.median("median_fee").alias("m")).collect()}
    assert {r.week: r.daily_overall_median_fee for r in week.collect()} == exact


def test_state_aggregates_rows_in_codegen(spark, inter):
    df = mart_state(inter)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    partial = [ln for ln in plan.splitlines() if "partial_count(1)" in ln and "HashAggregate" in ln]
    assert partial and all("*(" in ln for ln in partial)


# -- refresh --------------------------------------------------------------------------------------

def _land(df, landing, load):
    df.coalesce(2).write.parquet(f"{landing}/{load}")


def test_refresh_equals_full_rebuild_and_reads_touched_days_only(spark, scratch, parsed, inter):
    landing, root = f"{scratch}/landing", f"{scratch}/tables"
    t = F.col("enqueued_time")
    late = (t < F.lit("2026-09-18 12:00:00").cast("timestamp_ntz")) & (F.col("block_index") == 0)
    _land(parsed.where(~late), landing, "load=1")
    first = R.refresh(spark, landing, root)
    assert first.release.version == 1 and len(first.days) == 9 and first.files >= 1
    assert R.refresh(spark, landing, root).files == 0                       # nothing new: no release
    _land(parsed.where(late), landing, "load=2")                            # behind everything loaded
    second = R.refresh(spark, landing, root)
    assert second.days == ["event_date=2026-09-17", "event_date=2026-09-18"]
    assert all(n == 0 for _, _, n in second.results) and ("unique", "mempool_id", 0) in second.results
    store = Warehouse(spark, root)
    for name, want in (("fct_daily", mart_daily(inter)), ("fct_hours", mart_hourly(inter)), ("fct_minutes", mart_minute(inter))):
        got = R.mart(store, name)
        assert got.columns == want.columns and _rows(got) == _rows(want)
        kept = {p for p, f in first.release.parts(name).items() if store.release().parts(name)[p] == f}
        assert kept == set(first.release.parts(name)) - set(second.days)    # other days were not written
    staged = R.mart(store, "staging")
    assert _rows(staged) == _rows(latest_per_key(stage(parsed)).select(*staged.columns))
    touched = store.read("staging", second.days, first.release)
    assert {f.split("event_date=")[1][:10] for f in touched.inputFiles()} == {"2026-09-17", "2026-09-18"}


def test_changed_and_repeated_files(spark, scratch, parsed):
    landing, root = f"{scratch}/landing", f"{scratch}/tables"
    _land(parsed, landing, "load=1")
    R.refresh(spark, landing, root)
    before = _rows(R.mart(Warehouse(spark, root), "fct_hours"))
    _land(parsed.where("sequence_number % 3 = 0"), landing, "load=2")       # the same rows again
    assert R.refresh(spark, landing, root).release.version == 2
    assert _rows(R.mart(Warehouse(spark, root), "fct_hours")) == before
    path = next(os.path.join(d, f) for d, _, fs in os.walk(f"{landing}/load=2") for f in fs if f.endswith(".parquet"))
    os.utime(path, (1, 1))                                                  # another state of a loaded file
    assert R.refresh(spark, landing, root).files == 1
    assert _rows(R.mart(Warehouse(spark, root), "fct_hours")) == before


def test_rule_failure_publishes_nothing(spark, scratch, parsed):
    landing, root = f"{scratch}/landing", f"{scratch}/tables"
    good = parsed.where("sequence_number % 2 = 0")
    _land(good, landing, "load=1")
    R.refresh(spark, landing, root)
    store = Warehouse(spark, root)
    before = {t: _rows(store.read(t)) for t in store.release().tables if t != "ledger"}
    _land(parsed.where("sequence_number % 2 = 1").withColumn("fee_p10", F.col("fee_p99") + 1), landing, "load=2")
    with pytest.raises(RuleFailure, match=r"p10_le_p99\(fee_p10\)"):
        R.refresh(spark, landing, root)
    assert store.versions() == [1] and {t: _rows(store.read(t)) for t in before} == before
    used = {f.split("/")[0] for f in store.release().parts("staging").values()}
    assert set(os.listdir(f"{root}/data/staging")) == used                   # the rejected data is gone
    # the rules are a parameter: without them the load goes through
    assert R.refresh(spark, landing, root, rules=declared_rules()).release.version == 2


def test_late_failure_publishes_nothing(spark, scratch, parsed, monkeypatch):
    """Staging, state and two marts are written, the third fails."""
    landing, root = f"{scratch}/landing", f"{scratch}/tables"
    _land(parsed.where("sequence_number < 300"), landing, "load=1")
    R.refresh(spark, landing, root)
    store = Warehouse(spark, root)
    before = _rows(store.read("staging"))
    _land(parsed, landing, "load=2")
    with monkeypatch.context() as m:
        m.setattr(R, "minute_from_state", lambda state: minute_from_state(state).withColumn(
            "fee_spike_alert", F.raise_error(F.lit("disk full")).cast("string")))
        with pytest.raises(PySparkException):
            R.refresh(spark, landing, root)
    assert store.versions() == [1] and _rows(store.read("staging")) == before
    assert R.refresh(spark, landing, root).release.version == 2              # the same files, again
    assert R.mart(store, "staging").count() == parsed.select("sequence_number", "enqueued_time").distinct().count()


def test_watched_write_counts_rules_in_one_job(spark, scratch, inter):
    bad = inter.withColumn("avg_fee_per_tx", F.when(F.col("sequence_number") % 5 > 0, F.col("avg_fee_per_tx")))
    twice = bad.unionByName(bad.where("sequence_number = 7"))
    watched = Watched(twice, [*declared_rules(), *extra_rules()], "mempool_id")
    assert watched.df.columns == inter.columns
    watched.df.write.parquet(f"{scratch}/out")
    found = {(t, c): n for t, c, n in watched.results()}
    n_null, n_seven = bad.where("avg_fee_per_tx is null").count(), bad.where("sequence_number = 7").count()
    extra = twice.where("avg_fee_per_tx is null").count() - n_null
    assert found["not_null", "avg_fee_per_tx"] == n_null + extra and found["unique", "mempool_id"] == 2 * n_seven
    assert found["p10_le_p99", "fee_p10"] == 0
    with pytest.raises(RuleFailure):
        watched.gate()
    plain = Watched(latest_per_key(stage(X.landed_parsed(spark, SF001))), [], "mempool_id").df
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(mempool_id") == 1           # uniqueness costs no shuffle


def test_newest_rows_open_few_days(spark, scratch, parsed, inter):
    landing, root = f"{scratch}/landing", f"{scratch}/tables"
    _land(parsed, landing, "load=1")
    R.refresh(spark, landing, root)
    store = Warehouse(spark, root)
    minute = mart_minute(inter)
    for n in (1, 60, 500, 10_000):
        got = R.newest_rows(store, "fct_minutes", n)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in top_newest(minute, "time_minute", n).collect()]
    days = {f.split("event_date=")[1][:10] for f in R.newest_rows(store, "fct_minutes", 60).inputFiles()}
    assert days == {"2026-09-25"}


def test_empty_landing_and_empty_files(spark, scratch, parsed):
    landing, root = f"{scratch}/landing", f"{scratch}/tables"
    os.makedirs(landing)
    assert R.refresh(spark, landing, root).release.version == 0
    _land(parsed.limit(0), landing, "load=1")
    done = R.refresh(spark, landing, root)
    assert done.release.version == 1 and done.days == []
    assert R.mart(Warehouse(spark, root), "fct_daily").count() == 0
    _land(parsed, landing, "load=2")
    R.refresh(spark, landing, root)
    assert R.mart(Warehouse(spark, root), "fct_daily").count() == 9
