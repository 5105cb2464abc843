"""Incremental refresh: new landed files -> staging -> marts, in one release.

A run

1. finds the landed files that no release has loaded: a ledger table holds the
   path, size and change time of every loaded file, so a file counts as new
   whatever event times its rows have, and a file that changed counts as new;
2. merges their rows into the staging partitions of the days they touch (latest
   per key, in the order of a full refresh);
3. writes those days' intermediate rows once, counting in that same write the
   rows that break a declared test or rule, and goes no further if there are any;
4. replaces those days in the mart state and, from it, in the three marts;
5. publishes ledger, staging, state and marts as one release.

So a reader sees a run's tables together or not at all, a run that fails at any
point leaves the last release as it was, and a run that is repeated finds its
files loaded.  Tables are partitioned by day; days that no file touches are
neither read nor written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.operators.features import intermediate
from feeflow.operators.mart_state import (
    STATE_TIME,
    daily_from_state,
    hourly_from_state,
    mart_state,
    minute_from_state,
)
from feeflow.operators.quality import Watched, declared_rules, extra_rules, mart_rules
from feeflow.operators.serving import top_newest
from feeflow.operators.staging import latest_per_key, merge_rows, stage
from feeflow.session import materialize_shared
from feeflow.sources.releases import NULL_PARTITION, Change, Release, Warehouse, partition_name
from feeflow.sources.sinks import landing_inventory, typed_columns

DAY = "event_date"
LEDGER, STAGING, STATE = "ledger", "staging", "mart_state"
MARTS = {"fct_daily": "mempool_date", "fct_hours": "time_hour", "fct_minutes": "time_minute"}
LEDGER_COLUMNS = ["path", "length", "modificationTime"]


@dataclass
class Refreshed:
    """What a run did; ``release`` is unchanged where no file was new."""

    release: Release
    files: int
    days: list[str]
    results: list[tuple[str, str, int]]


def unseen_files(spark: SparkSession, landing: str, ledger: DataFrame | None) -> DataFrame:
    """(path, length, modificationTime) of landed Parquet files that the ledger
    does not hold in that state.  Names and sizes only: no content is read."""
    files = landing_inventory(spark, landing, "*.parquet").select(*LEDGER_COLUMNS)
    return files if ledger is None else files.join(ledger, LEDGER_COLUMNS, "left_anti")


def load_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """The typed rows of these files and no others."""
    return typed_columns(spark.read.option("mergeSchema", "true").parquet(*files))


def _days(df: DataFrame) -> list[str]:
    """Partition names of the days that ``df`` holds (one row a day)."""
    return sorted(partition_name(DAY, r[0]) for r in df.select(DAY).distinct().collect())


def _with_day(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(time_col))


def refresh(spark: SparkSession, landing: str, root: str, rules: list | None = None) -> Refreshed:
    """One incremental run over the files below ``landing`` into the warehouse
    ``root``.  ``rules`` replace the declared tests and extra rules.  Raises :class:`RuleFailure` where rows break a rule, and
    :class:`Conflict` where another run was faster; the release stays."""
    store = Warehouse(spark, root)
    base = store.release()
    ledger = store.read(LEDGER, release=base) if base.version else None
    seen = unseen_files(spark, landing, ledger).collect()   # names of new files, as the reader needs them
    if not seen:
        return Refreshed(base, 0, [], [])
    changes: list[Change] = []

    def prepared(table: str, df: DataFrame, partition_by: str | None = DAY) -> Change:
        changes.append(store.prepare(table, df, partition_by, "touched"))
        return changes[-1]

    try:
        rows = load_files(spark, [f.path for f in seen])
        batch = materialize_shared(_with_day(stage(rows), "enqueued_time"), "refresh-batch")
        days = _days(batch)
        if base.parts(STAGING):
            merged = merge_rows(store.read(STAGING, days, base), batch)
        else:
            merged = latest_per_key(batch)
        staged = store.read_change(prepared(STAGING, merged))
        watched = Watched(intermediate(staged.drop(DAY)), rules or [*declared_rules(), *extra_rules()], "mempool_id")
        inter = materialize_shared(watched.df, "refresh-intermediate")
        results = watched.gate()
        state = store.read_change(prepared(STATE, _with_day(mart_state(inter), STATE_TIME))).drop(DAY)
        daily = Watched(daily_from_state(state, inter), mart_rules())
        prepared("fct_daily", _with_day(daily.df, MARTS["fct_daily"]))
        results += daily.gate()
        prepared("fct_hours", _with_day(hourly_from_state(state), MARTS["fct_hours"]))
        prepared("fct_minutes", _with_day(minute_from_state(state), MARTS["fct_minutes"]))
        prepared(LEDGER, spark.createDataFrame(seen), None)
        release = store.publish(changes, base, {"files": len(seen), "days": days})
    except BaseException:
        store.abandon(changes)
        raise
    return Refreshed(release, len(seen), days, results)


def mart(store: Warehouse, name: str, release: Release | None = None, days: list[str] | None = None) -> DataFrame:
    """A published table, without its partition column."""
    return store.read(name, days, release).drop(DAY)


def newest_rows(store: Warehouse, name: str, n: int = 500, release: Release | None = None) -> DataFrame:
    """The newest ``n`` rows of a mart, from as few day partitions as hold
    them: days are opened from the newest on, and their rows counted from the
    file footers, until ``n`` are there."""
    release = release or store.release()
    parts = release.parts(name)
    dated = sorted((p for p in parts if not p.endswith(NULL_PARTITION)), reverse=True)
    opened, held = [], 0
    for part in [*dated, *(p for p in parts if p.endswith(NULL_PARTITION))]:
        if held >= n:
            break
        opened.append(part)
        held += store.read(name, [part], release).count()
    return top_newest(mart(store, name, release, opened), MARTS[name], n)
