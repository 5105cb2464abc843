"""The model run: parsed rows -> staging -> intermediate -> three marts.

Two shuffles carry the whole run: one by ``mempool_id`` (latest row per
key) and one per mart by its time bucket.  The intermediate is reused by
the three marts; inside one query plan Spark reuses the dedup exchange,
and across separately executed marts :func:`run_models` cuts lineage with
a Parquet table written to the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feeflow.operators.features import intermediate
from feeflow.operators.marts import mart_daily, mart_hourly, mart_minute
from feeflow.operators.quality import run_declared_tests
from feeflow.operators.staging import stage
from feeflow.session import materialize_shared
from feeflow.sources.fixtures import landed_parsed


def staging_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(landed_parsed(spark, sf_dir))


def intermediate_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate(staging_from_tables(spark, sf_dir))


@dataclass
class ModelRun:
    intermediate: DataFrame
    daily: DataFrame
    hourly: DataFrame
    minute: DataFrame
    tests: DataFrame


def run_models(staged: DataFrame, materialize_intermediate: bool = True) -> ModelRun:
    """Build all models from a staging frame.

    With ``materialize_intermediate`` the intermediate is written once as a
    Parquet table in the shared checkpoint folder, so three marts and the
    tests neither recompute parse + dedup nor reach back to the raw capture
    after a lost executor, and each mart scans only its columns.
    """
    inter = intermediate(staged)
    if materialize_intermediate:
        inter = materialize_shared(inter, "intermediate")
    return ModelRun(
        intermediate=inter,
        daily=mart_daily(inter),
        hourly=mart_hourly(inter),
        minute=mart_minute(inter),
        tests=run_declared_tests(inter),
    )
