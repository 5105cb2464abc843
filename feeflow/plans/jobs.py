"""End-to-end jobs: what a scheduler runs.

* ``ingest``    capture files -> quarantine of unreadable bodies + the parsed
                table (partitioned by day)
* ``models``    parsed table -> incremental slice (high-water mark of the
                staging table, with a look-back overlap) -> keyed upsert into
                staging -> intermediate (written once) -> three marts written
                as clustered tables -> declared tests
* ``snapshot``  newest 500 rows of the hourly and minute marts
* ``refresh``   landed parsed files -> ledger, staging, mart state and marts in
                one release (:mod:`feeflow.plans.refresh`)

Every step is a Spark job over whole inputs; the driver only sees the mark,
the touched-day list and the test verdict rows.

Usage: python -m feeflow.plans.jobs {ingest,models,snapshot,refresh} ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feeflow.operators import parse as P
from feeflow.operators.quality import check_extra, run_declared_tests
from feeflow.operators.staging import incremental_slice, stage, table_high_water_mark, upsert
from feeflow.plans.model_run import run_models
from feeflow.plans.refresh import refresh
from feeflow.session import scratch_path
from feeflow.sources import sinks as K


UNREADABLE = "__unreadable"


@dataclass
class ModelOutputs:
    daily: DataFrame
    hourly: DataFrame
    minute: DataFrame
    tests: DataFrame
    touched_days: int


def ingest(spark: SparkSession, capture_path: str, parsed_path: str, quarantine_path: str,
           fmt: str = "parquet", mode: str = "compat") -> DataFrame:
    """Capture -> parsed table; unreadable bodies go to the quarantine table.
    Both are replaced, so a replay changes neither.  The capture is read and
    its bodies are tested once, in a pass that deals the messages to two staged
    folders; each output reads its own."""
    cap = P.decode_body(K.read_capture(spark, capture_path, fmt))
    staged = scratch_path(spark, "ingest")
    (cap.withColumn(UNREADABLE, F.try_parse_json("body_str").isNull())
     .write.partitionBy(UNREADABLE).parquet(staged))

    def dealt(unreadable: bool) -> DataFrame:
        schema = T.StructType([*cap.schema.fields, T.StructField(UNREADABLE, T.BooleanType())])
        rows = spark.read.schema(schema).parquet(staged)
        return rows.where(F.col(UNREADABLE) == unreadable).select(*cap.columns)

    dealt(True).write.mode("overwrite").parquet(quarantine_path)
    K.write_parsed(P.parse_messages(dealt(False), mode), parsed_path)
    return K.load_parsed(spark, parsed_path)


def models(spark: SparkSession, parsed_path: str, staging_path: str, marts_root: str,
           lookback_seconds: int = 3600) -> ModelOutputs:
    """Incremental model run: only rows newer than the staging table's mark
    (minus a look-back the keyed upsert absorbs) are staged and merged; only
    their day partitions are opened.  The marts are rebuilt from the whole
    staging table, as full-refresh tables.  The declared tests and the extra
    checks run first: a failure raises, and the marts of the last good run stay.
    Rows older than the look-back that never reached staging are found by
    :func:`late_rows`, at the price of a full pass; the ``refresh`` job loads by
    file and has no late rows."""
    mark = table_high_water_mark(spark, staging_path)
    since = mark - dt.timedelta(seconds=lookback_seconds) if mark else None
    parsed = K.load_parsed(spark, parsed_path, since=since)
    new_rows = incremental_slice(parsed, None, mark=mark, lookback_seconds=lookback_seconds if mark else 0)
    touched = upsert(spark, staging_path, stage(new_rows))
    staged = spark.read.parquet(staging_path).drop("event_date")
    run = run_models(staged)
    results = run_declared_tests(run.intermediate).unionByName(check_extra(run.intermediate)).collect()
    failed = [r for r in results if r.failures]
    if failed:
        raise ValueError("declared tests failed, marts not replaced: " + ", ".join(
            f"{r.test}({r.column_name})={r.failures}" for r in failed))
    daily = K.materialize(run.daily, os.path.join(marts_root, "fct_daily"), cluster_by=["mempool_date"])
    hourly = K.materialize(run.hourly, os.path.join(marts_root, "fct_hours"),
                           cluster_by=["time_hour", "network_congestion_status"])
    minute = K.materialize(run.minute, os.path.join(marts_root, "fct_minutes"))
    tests = spark.createDataFrame(results, "test string, column_name string, failures long")
    return ModelOutputs(daily, hourly, minute, tests, touched)


def late_rows(spark: SparkSession, parsed_path: str, staging_path: str) -> DataFrame:
    """Parsed rows whose key staging does not hold: they came in behind the
    look-back (or have no time).  Land or count them; a full load takes them."""
    staged = spark.read.parquet(staging_path).select("mempool_id")
    return stage(K.load_parsed(spark, parsed_path)).join(staged, "mempool_id", "left_anti")


def snapshot(spark: SparkSession, marts_root: str, out_root: str, n: int = 500) -> None:
    for name, time_col in (("fct_hours", "time_hour"), ("fct_minutes", "time_minute")):
        K.export_snapshot(spark.read.parquet(os.path.join(marts_root, name)),
                          os.path.join(out_root, f"{name}_snapshot"), time_col, n)


def main(argv: list[str] | None = None) -> None:
    from feeflow.session import drop_scratch, get_spark

    ap = argparse.ArgumentParser(prog="feeflow.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("capture")
    a.add_argument("parsed")
    a.add_argument("quarantine")
    a.add_argument("--format", default="parquet")
    b = sub.add_parser("models")
    b.add_argument("parsed")
    b.add_argument("staging")
    b.add_argument("marts")
    b.add_argument("--lookback-seconds", type=int, default=3600)
    c = sub.add_parser("snapshot")
    c.add_argument("marts")
    c.add_argument("out")
    d = sub.add_parser("refresh")
    d.add_argument("landing")
    d.add_argument("warehouse")
    args = ap.parse_args(argv)
    spark = get_spark()
    try:
        if args.job == "ingest":
            ingest(spark, args.capture, args.parsed, args.quarantine, args.format)
        elif args.job == "models":
            out = models(spark, args.parsed, args.staging, args.marts, args.lookback_seconds)
            for r in out.tests.collect():
                print(f"{r.test:16s} {r.column_name:28s} failures={r.failures}")
        elif args.job == "refresh":
            done = refresh(spark, args.landing, args.warehouse)
            print(f"release {done.release.version}: {done.files} new files, {len(done.days)} days")
        else:
            snapshot(spark, args.marts, args.out)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()
