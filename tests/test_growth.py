"""Steps whose shuffles or largest tasks grow with the input."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from feeflow.operators.features import intermediate
from feeflow.operators.mart_state import mart_state, merged_state
from feeflow.operators.staging import stage
from feeflow.plans import catalog as C
from feeflow.sources import fixtures as X
from feeflow.streaming import stream as ST

PARSED = ("sequence_number long, enqueued_time timestamp_ntz, block_size long, block_vsize long, median_fee double, "
          "n_tx int, total_fees long, fee_p10 double, fee_p25 double, fee_p50 double, fee_p75 double, fee_p90 double, "
          "fee_p95 double, fee_p99 double, block_index int")


def parsed(spark, n=300):
    i = F.col("id")
    fees = [(i % 7 + k).cast("double").alias(c) for k, c in enumerate(re.findall(r"fee_p\d+", PARSED))]
    return spark.range(n).select(
        F.when(i % 11 != 0, i % 90).alias("sequence_number"),
        F.timestamp_add("SECOND", i * 40, F.lit("2026-09-17").cast("timestamp_ntz")).alias("enqueued_time"),
        (i * 10).alias("block_size"), (i * 9).alias("block_vsize"), (i % 80).cast("double").alias("median_fee"),
        (i % 50).cast("int").alias("n_tx"), (i * 3).alias("total_fees"), *fees, F.lit(0).alias("block_index"))


def test_the_state_of_the_marts_moves_rows_and_not_their_sums(spark):
    inter = intermediate(stage(parsed(spark))).localCheckpoint()
    executed = mart_state(inter)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1
    assert executed.index("Aggregate") < executed.index("Exchange hashpartitioning")


def test_distinct_numbers_are_counted_beside_the_measures(spark):
    inter = intermediate(stage(parsed(spark)))
    state = mart_state(inter)
    got = {r.h: (r.rows, r.blocks) for r in merged_state(state, "hour", "h", by_status=False).collect()}
    want = {r.h: (r.rows, r.blocks) for r in inter.groupBy(
        F.date_trunc("hour", "enqueued_time").cast("timestamp_ntz").alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("sequence_number").alias("blocks")).collect()}
    assert got == want
    executed = merged_state(state.localCheckpoint(), "day", "d")._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in executed.splitlines() if "Aggregate" in x and "bitmap_or_agg" in x]
    assert wide and not any("__sum" in x for x in wide)


def test_the_inventory_makes_its_rows_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    rows = intermediate(stage(parsed(spark)))
    columns = rows.columns

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    monkeypatch.setattr(C, "_inter", lambda *_: rows.mapInPandas(counted, rows.schema).select(*columns))
    found = {r.folder: (r.n_files, r.n_filled, r.n_rows) for r in C.q_landing_inventory(spark, "").collect()}
    assert made.value == rows.count() and sum(n for _, _, n in found.values()) == rows.count()
    assert {x[:2] for x in found.values()} == {(1, 1)}


@pytest.mark.parametrize("name", ["q_stream_minute", "q_stream_minute_exact", "q_stream_parsed"])
def test_a_streamed_capture_is_written_by_all_tasks(spark, scratch, monkeypatch, name):
    class Written(Exception):
        pass

    def stop(*_):
        raise Written

    monkeypatch.setattr(C, "_capture", lambda *_: X.messages_from_parsed(parsed(spark)))
    monkeypatch.setattr(C, "scratch_path", lambda *_: scratch)
    monkeypatch.setattr(ST, "stream_capture", stop)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        with pytest.raises(Written):
            C.QUERIES[name](spark, "")
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{scratch}/capture/*.parquet")) > 6
