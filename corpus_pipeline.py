"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.llm import decontaminate, line_spread, order_minhash, packing, quality_rules
from feeflow.llm.catalog import tokenizer_path
from feeflow.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in one document; n_chars follows the text."""
    found = line_spread.drop_spread_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.select(*[changed.cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars"
                          else F.col(f"`{c}`") for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return order_minhash.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left, in full sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: Suffix arrays, alignment and token ids have no SQL form; tests compare the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
