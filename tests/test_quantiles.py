"""Distributed exact quantiles equal Spark's exact ``percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from feeflow.operators.quantiles import (
    _inside,
    _sketches,
    _with_brackets,
    exact_quantiles,
    solved_brackets,
)

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
NAMES = [f"q{i}" for i in range(len(QS))]


def _data(spark, seed):
    rnd = random.Random(seed)
    rows = []
    # a hot group with a third of the rows, ties, NULLs, a one-row group, an all-NULL group
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"
        v = None if rnd.random() < 0.05 else float(rnd.choice([rnd.randint(0, 20), rnd.random() * 1000]))
        rows.append((g, v))
    rows += [("single", 7.5), ("nulls", None), ("nulls", None), (None, 3.0), (None, 5.0)]
    return spark.createDataFrame(rows, "g string, v double")


def _expected(df):
    exp = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(q) for q in QS])).alias("p"))
    return {r["g"]: r["p"] for r in exp.collect() if r["p"] is not None}


# the second set misses brackets and has to narrow crowded ones; the third
# joins by salt instead of a broadcast
@pytest.mark.parametrize("most,slack,groups", [(100_000, 0.005, 100_000), (5, -0.002, 100_000),
                                               (100_000, 0.005, 0)])
def test_exact_quantiles_match_percentile(spark, most, slack, groups):
    df = _data(spark, 7)
    got = exact_quantiles(df, ["g"], "v", QS, NAMES, most=most, slack=slack, broadcast_groups=groups).collect()
    got = {r["g"]: [r[n] for n in NAMES] for r in got}
    exp = _expected(df)
    assert set(got) == set(exp)  # all-NULL group absent, NULL key kept
    for g, vals in exp.items():
        for a, b in zip(got[g], vals):
            assert a == pytest.approx(b, rel=1e-12, abs=1e-12), (g, got[g], vals)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_values_are_not_shuffled_by_group(spark):
    """With broadcasts off for estimates, every exchange by the group alone is
    of aggregated rows; no exact percentile, and only bracket hits explode."""
    df = _data(spark, 3)
    rows = df.select("g", F.col("v").alias("_v")).where("v is not null")
    brackets = solved_brackets(rows, ["g"], [0.5])
    plan = _plan(_inside(rows, brackets, ["g"], 1, 100_000))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    plan = _plan(_sketches(rows, ["g"]))
    assert "partial_kll_sketch_agg_double" in plan and "percentile" not in plan
    plan = _plan(exact_quantiles(df, ["g"], "v", [0.5], ["m"]))
    assert "percentile(" not in plan and "collect_list(_v" not in plan
    salted = _plan(_with_brackets(rows, brackets, ["g"], 0))
    assert "_s#" in salted.split("hashpartitioning(")[1].split(")")[0] or "_s#" in salted


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_values = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]),
              st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e6, 1e6, allow_nan=False))),
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=_values, q=st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_exact_quantiles_property(spark, rows, q):
    import numpy as np

    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["x"] for r in exact_quantiles(df, ["g"], "v", [q], ["x"]).collect()}
    for g in {g for g, _ in rows}:
        vals = sorted(v for gg, v in rows if gg == g and v is not None)
        if not vals:
            assert g not in got
            continue
        assert got[g] == pytest.approx(float(np.percentile(vals, q * 100)), rel=1e-9, abs=1e-9)


def test_hot_group_reaches_the_window_as_bracket_values(spark):
    """A group holding a third of the rows reaches the final window as a few
    thousand candidate values, not as its ~100k rows."""
    n = 300_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', CAST(id % 97 AS STRING)) END AS g",
        "CAST((id * 7919) % 1000003 AS DOUBLE) / 7.0 AS v")
    rows = df.select("g", F.col("v").alias("_v"))
    brackets = solved_brackets(rows, ["g"], [0.5], most=2000)
    hot = _inside(rows, brackets.where("g = 'hot'"), ["g"], 1, 100_000).count()
    assert 0 < hot <= 2000
    got = exact_quantiles(df, ["g"], "v", [0.5], ["m"], most=2000).where("g = 'hot'").first().m
    exp = df.where("g = 'hot'").agg(F.median("v")).first()[0]
    assert got == exp


def test_nan_and_infinities(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", nan), ("b", 1.0), ("b", nan), ("b", 2.0), ("c", inf), ("c", -inf), ("c", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.lo, r.mid) for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5], ["lo", "mid"]).collect()}
    assert str(got["a"]) == str((nan, nan)) and got["b"] == (1.0, 2.0) and got["c"] == (-inf, 3.0)


def test_global_quantiles_without_keys(spark):
    df = _data(spark, 11)
    got = exact_quantiles(df, [], "v", QS, NAMES).first()
    exp = df.agg(F.percentile("v", F.array(*[F.lit(q) for q in QS]))).first()[0]
    assert [got[n] for n in NAMES] == pytest.approx(exp, rel=1e-12)
    plan = exact_quantiles(df, [], "v", [0.5], ["m"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
