"""Write PLANS.md: physical plan trees of the headline operators.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.01)
The tree part of ``explain("formatted")`` is kept; node details are dropped.
"""

from __future__ import annotations

import datetime as dt
import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feeflow.operators.marts import mart_daily  # noqa: E402
from feeflow.operators.staging import incremental_slice, latest_per_key  # noqa: E402
from feeflow.plans.catalog import queries  # noqa: E402
from feeflow.plans.model_run import intermediate_from_tables, staging_from_tables  # noqa: E402
from feeflow.session import get_spark, materialize_shared, scratch_path  # noqa: E402
from feeflow.sources.fixtures import lineitem_blocks, parsed_from_orders  # noqa: E402
from feeflow.sources.sinks import load_parsed, write_parsed  # noqa: E402

NOTES = {
    "fixture: lineitem per order (sums + 7 smallest fees)":
        "Two lineitem scans, each pruned to its columns. The sums are a partial + final hash aggregate. "
        "The 7 smallest fees use `WindowGroupLimit` **Partial** below the exchange, so a hot order "
        "sends at most 7 rows per map task. Both sides are hash-partitioned by `l_orderkey`, so their "
        "join adds no exchange.",
    "latest row per key (J1)":
        "Partial `WindowGroupLimit` (1 row per key per task) below `Exchange hashpartitioning(mempool_id)`, "
        "final above it.",
    "hourly mart (G2)":
        "Single-distinct aggregate without `Expand`: partial aggregate keyed by (hour, status, sequence), "
        "exchange on that key (a busy hour spreads over reducers), then partial/final by (hour, status).",
    "daily mart on the materialized intermediate (G1)":
        "Main aggregate plus the distributed exact median. Its brackets come from salted KLL sketches (stored, "
        "one row per day); the rows meet them by a broadcast whose row count was checked, so the values are "
        "not shuffled by day; the window sees the (value, count) pairs inside a bracket only.",
    "exact quantiles (G4, per day of transactions)":
        "Same shape as the daily median, for 7 quantiles in one pass.",
    "high-water-mark slice over the stored parsed table (F1)":
        "As the `models` job runs it: the parsed table is stored partitioned by day, the mark is a "
        "literal, so the comparison reaches the Parquet scan's `PushedFilters` (row-group skipping). "
        "(In the catalog query `q_high_watermark` the time is derived from the fixture's order key, so "
        "there the filter necessarily sits above the scan.)",
}


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()
    inter = materialize_shared(intermediate_from_tables(spark, sf), "plans-intermediate")
    parsed_path = scratch_path(spark, "plans-parsed")
    write_parsed(parsed_from_orders(spark, sf), parsed_path)
    stored_slice = incremental_slice(load_parsed(spark, parsed_path), None,
                                     mark=dt.datetime(2026, 9, 21, 0, 30, 0))
    plans = {
        "fixture: lineitem per order (sums + 7 smallest fees)": lineitem_blocks(spark, sf),
        "latest row per key (J1)": latest_per_key(staging_from_tables(spark, sf)),
        "hourly mart (G2)": q["q_mart_hourly"](spark, sf),
        "daily mart on the materialized intermediate (G1)": mart_daily(inter),
        "exact quantiles (G4, per day of transactions)": q["q_fee_percentiles"](spark, sf),
        "high-water-mark slice over the stored parsed table (F1)": stored_slice,
    }
    out = ["# PLANS", "", "Physical plans (`explain(\"formatted\")`, tree only) of the headline operators, "
           f"generated by `tools/plans.py` on `{sf}` with AQE on. AQE re-plans at runtime; these "
           "are the initial plans.", ""]
    for title, df in plans.items():
        out += [f"## {title}", "", NOTES[title], "", "```", tree(df), "```", ""]
    hw = stored_slice._jdf.queryExecution().executedPlan().toString()
    pushed = [ln.strip() for ln in hw.splitlines() if "PushedFilters" in ln]
    out += ["Scan filters of the stored-table slice:", "", "```", *(p[p.index("PushedFilters"):][:200] for p in pushed), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
