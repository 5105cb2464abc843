"""Physical-plan properties that matter at scale, checked on every catalog query."""

import pytest

import __spark_entry__ as E
from paths import SF001
from feeflow.operators.staging import latest_per_key
from feeflow.plans.catalog import QUERIES
from feeflow.plans.model_run import staging_from_tables

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = _plan(latest_per_key(staging_from_tables(spark, SF001)))
    # partial WindowGroupLimit below the exchange, final above it
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    partial_at = plan.index("Partial")
    assert plan.rfind("Exchange hashpartitioning(mempool_id", 0, len(plan)) < partial_at


def test_fixture_top7_is_map_side_limited(spark):
    from feeflow.sources.fixtures import lineitem_blocks

    plan = _plan(lineitem_blocks(spark, SF001))
    assert plan.count("WindowGroupLimit") >= 2 and "collect_list" not in plan


def test_marts_single_distinct_without_expand(spark):
    for name in ("q_mart_hourly", "q_mart_minute"):
        plan = _plan(E.queries()[name](spark, SF001))
        assert "Expand" not in plan and "HashAggregate" in plan, name


def test_static_broadcast_is_off(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    # elsewhere only AQE may broadcast, on measured sizes; the quantile brackets
    # are broadcast by a counted hint
    for name in ("q_mart_hourly", "q_mart_minute", "q_conditional_count", "q_incremental_upsert"):
        assert "BroadcastExchange" not in _plan(E.queries()[name](spark, SF001)), name


@pytest.mark.parametrize("name", ["q_conditional_count", "q_alert_daily", "q_daily_fee_spread",
                                  "q_daily_efficiency", "q_status_class"])
def test_readers_without_the_median_do_not_compute_it(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "kll" not in plan and "percentile" not in plan and "median" not in plan.lower().replace("median_fee", "")


def test_daily_slice_reads_only_its_days(spark):
    from feeflow.operators.marts import rows_of_days
    from feeflow.sources.fixtures import landed_parsed

    plan = _plan(rows_of_days(landed_parsed(spark, SF001), ["2026-09-18 00:00:00"]))
    assert "PushedFilters: [IsNotNull(enqueued_time)" in plan
    assert "enqueued_time" in plan and ">= 2026-09-18 00:00:00" in plan and "< 2026" in plan


def test_scans_prune_columns(spark):
    plan = _plan(E.queries()["q_tx_fanout"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_mart_aggregates_run_in_whole_stage_codegen(spark):
    df = E.queries()["q_mart_minute"](spark, SF001)
    df.collect()  # the final adaptive plan carries the codegen stage ids
    final = _plan(df).split("== Initial Plan ==")[0]
    aggs = [ln for ln in final.splitlines() if "HashAggregate(" in ln and "ObjectHashAggregate" not in ln]
    assert aggs and all("*(" in ln for ln in aggs)
