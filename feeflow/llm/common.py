"""Shared pieces of the training-data operators."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.session import forget_scratch, scratch_path

_PATHS: WeakKeyDictionary = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so
    a lost executor re-reads files and later passes prune columns.  The
    shuffle files of this one write are dropped when it ends: nothing reads
    them again, and several such steps may follow in one job."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        path = scratch_path(df.sparkSession, f"llm-{name}")
        df.write.option("compression", "zstd").parquet(path)
        found = df.sparkSession.read.parquet(path)
        _PATHS[found] = path
        return found
    finally:
        conf.set(key, before)


def unstored(*frames: DataFrame) -> None:
    """Removes the folders of ``stored`` tables, once all that was made of
    them is stored itself: they cannot be read afterwards."""
    for df in frames:
        forget_scratch(df.sparkSession, _PATHS.pop(df))


def small(df: DataFrame, most_rows: int = 500_000) -> DataFrame:
    """``df`` (a stored table) marked for broadcast where its counted rows are
    within ``most_rows``; beyond that the join shuffles, and adaptive execution
    splits its skewed partitions."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def text_of(column: str = "text") -> Column:
    """The text as a string; a null is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``row``, beside the ``extra`` ones:
    an operator that passes rows on cannot clash with their column names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(name) for name, c in extra.items()])


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Fingerprint of a row's text: with the id it tells rows apart.

    Rows equal in both are interchangeable for every operator here, so no
    materialised row number is needed and a recomputed task finds the same
    keys.
    """
    return F.xxhash64(F.lit(17), text_of(text_column))
