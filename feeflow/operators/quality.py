"""Declarative data tests as Spark aggregates.

Each check returns a DataFrame of (test, column_name, failures); a test
passes when ``failures == 0``.  Not-null and accepted-values checks of all
columns share one single-pass aggregate; uniqueness needs one shuffle on
the column (partial counts first, so a hot value costs one row per task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from feeflow import schemas as S


def _rows(df: DataFrame, specs: list[tuple[str, str, F.Column]]) -> DataFrame:
    """One aggregate over ``df``; ``specs`` = (test, column, failure count expr)."""
    agg = df.agg(*[e.cast("bigint").alias(f"_{i}") for i, (_, _, e) in enumerate(specs)])
    arr = F.array(*[
        F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failures"))
        for i, (t, c, _) in enumerate(specs)
    ])
    return agg.select(F.explode(arr).alias("r")).select("r.*")


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit("unique").alias("test"), F.lit(col).alias("column_name"), "failures"
    )


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return _rows(df, [("not_null", c, F.count_if(F.col(c).isNull())) for c in cols])


def check_accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Non-NULL values outside the accepted list."""
    return _rows(df, [("accepted_values", col, F.count_if(~F.col(col).isin(values)))])


def extra_rules() -> list[tuple[str, str, F.Column]]:
    return [
        ("not_null", "enqueued_time", F.count_if(F.col("enqueued_time").isNull())),
        ("p10_le_p99", "fee_p10", F.count_if(F.col("fee_p10") > F.col("fee_p99"))),
    ]


def check_extra(df: DataFrame) -> DataFrame:
    """Checks that can actually fail on the intermediate model."""
    return _rows(df, extra_rules())


def declared_rules() -> list[tuple[str, str, F.Column]]:
    """The declared tests that one pass over the rows can count."""
    return [
        ("not_null", "mempool_id", F.count_if(F.col("mempool_id").isNull())),
        ("not_null", "network_congestion_status", F.count_if(F.col("network_congestion_status").isNull())),
        ("accepted_values", "network_congestion_status",
         F.count_if(~F.col("network_congestion_status").isin(list(S.CONGESTION_LABELS)))),
        ("not_null", "avg_fee_per_tx", F.count_if(F.col("avg_fee_per_tx").isNull())),
    ]


def run_declared_tests(int_df: DataFrame) -> DataFrame:
    """The model's five declared tests (unique, not_null x3, accepted_values)."""
    return check_unique(int_df, "mempool_id").unionByName(_rows(int_df, declared_rules()))


def mart_invariants(daily: DataFrame) -> DataFrame:
    """Golden-table invariants on the daily mart: class counts add up and
    blocks never exceed rows.  failures = days breaking each rule."""
    return _rows(daily, mart_rules())


def mart_rules() -> list[tuple[str, str, F.Column]]:
    rows = F.col("high_congestion_blocks") + F.col("moderate_congestion_blocks") + F.col("low_congestion_blocks")
    return [
        ("class_counts_positive", "low_congestion_blocks", F.count_if(rows <= 0)),
        ("blocks_le_rows", "total_blocks_processed", F.count_if(F.col("total_blocks_processed") > rows)),
    ]


def all_passed(results: DataFrame) -> bool:
    """Driver-side verdict from the small results frame (a handful of rows)."""
    return reduce(lambda a, r: a and r["failures"] == 0, results.collect(), True)


# -- rules counted while a table is written ---------------------------------------


class RuleFailure(ValueError):
    """Rows broke rules; what was written is not published."""

    def __init__(self, failures: dict[tuple[str, str], int]):
        self.failures = failures
        super().__init__("not published: " + ", ".join(f"{t}({c})={n}" for (t, c), n in sorted(failures.items())))


class Watched:
    """A frame whose next write also counts its rows and the rows that break
    each rule (``DataFrame.observe``): no second read.

    ``unique`` names a key whose repeats are counted too, over the key's own
    window partition: where the frame already lies by that key, as after
    :func:`latest_per_key`, that needs no shuffle either.  A task that is run
    again may count twice, so counts say whether a rule holds, not how often
    it was broken.
    """

    def __init__(self, df: DataFrame, rules: list[tuple[str, str, F.Column]], unique: str | None = None):
        self.observation = Observation()
        self.names = {f"rule_{i}": (t, c) for i, (t, c, _) in enumerate(rules)}
        counts = [e.alias(f"rule_{i}") for i, (_, _, e) in enumerate(rules)]
        columns = df.columns
        if unique:
            copies = F.count(F.lit(1)).over(Window.partitionBy(unique))
            df = df.withColumn("__copies", copies)
            name = f"rule_{len(rules)}"
            self.names[name] = ("unique", unique)
            counts.append(F.count_if((F.col("__copies") > 1) & F.col(unique).isNotNull()).alias(name))
        watched = df.observe(self.observation, F.count(F.lit(1)).alias("n_rows"), *counts)
        self.df = watched.select(*[F.col(f"`{c}`") for c in columns])

    def results(self) -> list[tuple[str, str, int]]:
        """(test, column, failures) of every rule, after the write."""
        found = self.observation.get
        return [(t, c, int(found[name])) for name, (t, c) in self.names.items()]

    def gate(self) -> list[tuple[str, str, int]]:
        """:meth:`results`, or :class:`RuleFailure` if a rule was broken."""
        results = self.results()
        failed = {(t, c): n for t, c, n in results if n}
        if failed:
            raise RuleFailure(failed)
        return results
