"""Exact per-group quantiles without collecting a group into one task.

Spark's exact ``percentile``/``median`` aggregate keeps a value -> count map
per group and merges it in a single task, so a group holding a third of
all rows (one busy day) would have all of its distinct values in one
task's memory.  This operator gives the same interpolated result from
bounded pieces:

1. brackets: a KLL sketch per group and salt, merged per group (two levels,
   so no task merges one sketch per map task of a busy group); the sketch
   gives a value range ``[lo, hi]`` around each wanted rank;
2. one aggregate counts, per group and quantile, the rows below the bracket
   and the rows inside it.  The bracket is right if the rank lies inside;
   a missed one is widened, up to the whole range, and counted again;
3. brackets that still hold more than ``most`` rows are narrowed: the rows
   inside them are sketched anew, until they hold at most ``most`` distinct
   values;
4. a running sum over the (value, count) pairs inside each bracket, at most
   ``most`` of them, finds the values at the 0-based ranks
   ``floor(q*(n-1))`` and ``ceil(q*(n-1))``.

Rows are joined with the brackets (one row per group) by broadcast where
their counted number allows it, so the values are not shuffled by group; the
other way is a join on (group, salt), the brackets copied once per salt.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feeflow.session import materialize_shared

SKETCH_K = 4096          # rank error about 0.13 %
GRID = 1000              # ranks at which a merged sketch is read
SLACK = 0.005            # bracket half-width in rank, four times that
MOST = 100_000           # distinct values in a bracket that is solved at once
SALTS = 64
MOST_BROADCAST_GROUPS = 100_000


def _ns_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` treating NULL keys as equal; keeps one copy of each key."""
    if not keys:
        raise ValueError("an equi-join needs keys")
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])


def _salt():
    return F.spark_partition_id() % SALTS


def _sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: row count, range, and the merged sketch's values at ``GRID``
    even ranks (``_grid``)."""
    part = rows.groupBy(*keys, _salt().alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~F.isnan("_v")).alias("_real"), F.min("_v").alias("_min"),
        F.max("_v").alias("_max"), F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("_k"))
    merged = part.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.sum("_real").alias("_real"), F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        F.kll_merge_agg_double("_k", F.lit(SKETCH_K)).alias("_k"))
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    # only NaN: nothing in the sketch
    grid = F.when(F.col("_real") > 0, F.kll_sketch_get_quantile_double("_k", ranks))
    return merged.select(*keys, "_n", "_min", "_max", grid.alias("_grid"))


def _bracket(low_rank, high_rank, slack):
    """(lo, hi) from the sketched values: ranks as shares; the ends of the
    range stand in where the slack leaves it."""
    low, high = low_rank - slack, high_rank + slack
    empty = F.col("_grid").isNull()
    lo = F.when((low <= 0) | empty, F.col("_min")).otherwise(
        F.get("_grid", F.least(F.floor(low * GRID), F.lit(GRID)).cast("int")))
    hi = F.when((high >= 1) | empty, F.col("_max")).otherwise(
        F.get("_grid", F.greatest(F.ceil(high * GRID), F.lit(0)).cast("int")))
    return lo, hi


def _with_brackets(rows: DataFrame, brackets: DataFrame, keys: list[str],
                   broadcast_groups: int) -> DataFrame:
    """``rows`` with the brackets of their group as one array ``_b``."""
    per_group = brackets.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_qi", "_lo", "_hi"))).alias("_b"))  # one per quantile
    if per_group.limit(broadcast_groups + 1).count() <= broadcast_groups:
        return _ns_join(rows, F.broadcast(per_group), keys, "inner")
    salted = per_group.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return _ns_join(rows.withColumn("_s", _salt()), salted, [*keys, "_s"], "inner").drop("_s")


def _inside(rows: DataFrame, brackets: DataFrame, keys: list[str], m: int,
            broadcast_groups: int) -> DataFrame:
    """(keys, _qi, _v): the rows inside each bracket, once per bracket."""
    joined = _with_brackets(rows, brackets, keys, broadcast_groups)
    v = F.col("_v")
    hits = F.array_compact(F.array(*[F.when((v >= b["_lo"]) & (v <= b["_hi"]), b["_qi"])
                                     for i in range(m) for b in [F.get("_b", i)]]))
    return joined.select(*keys, "_v", F.explode(hits).alias("_qi")).select(*keys, "_qi", "_v")


def _counted(rows: DataFrame, brackets: DataFrame, keys: list[str], m: int,
             broadcast_groups: int) -> DataFrame:
    """``brackets`` with the rows below and inside each of them."""
    joined = _with_brackets(rows, brackets, keys, broadcast_groups)
    v = F.col("_v")
    counts = joined.groupBy(*keys).agg(*[c for i in range(m) for b in [F.get("_b", i)] for c in (
        F.count_if(v < b["_lo"]).alias(f"_below{i}"),
        F.count_if((v >= b["_lo"]) & (v <= b["_hi"])).alias(f"_inside{i}"),
        F.first(b["_qi"]).alias(f"_qi{i}"))])
    long = counts.select(*keys, F.explode(F.array(*[
        F.struct(F.col(f"_qi{i}").alias("_qi"), F.col(f"_below{i}").alias("_below"),
                 F.col(f"_inside{i}").alias("_inside")) for i in range(m)])).alias("_c")) \
        .select(*keys, "_c.*").where(F.col("_qi").isNotNull())
    return _ns_join(brackets, long, [*keys, "_qi"], "inner")


def solved_brackets(base: DataFrame, keys: list[str], qs: list[float], most: int = MOST,
                    slack: float = SLACK, broadcast_groups: int = MOST_BROADCAST_GROUPS) -> DataFrame:
    """Steps 1-3: (keys, _qi, _n, _lo, _hi, _below): brackets that hold their
    ranks and at most ``most`` distinct values."""
    m = len(qs)
    sketches = materialize_shared(_sketches(base, keys), "quantile-sketches")
    q = F.get(F.array(*[F.lit(float(x)) for x in qs]), F.col("_qi"))
    position = (F.col("_n") - 1).cast("double") * q
    share = F.greatest(F.col("_n") - 1, F.lit(1))
    lo, hi = _bracket(F.floor(position) / share, F.ceil(position) / share, F.lit(slack))
    todo = sketches.select("*", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("_qi")).select(
        *keys, "_qi", "_n", lo.alias("_lo"), hi.alias("_hi"))
    done = None
    while True:
        counted = materialize_shared(_counted(base, todo, keys, m, broadcast_groups), "quantile-brackets")
        holds = (F.floor(position) >= F.col("_below")) & (
            F.ceil(position) < F.col("_below") + F.col("_inside"))
        fits = holds & ((F.col("_inside") <= most) | (F.col("_lo") == F.col("_hi")))
        ready = counted.where(fits)
        missed = counted.where(~holds)
        crowded = counted.where(holds & ~fits)
        columns = [*keys, "_qi", "_n", "_lo", "_hi", "_below"]
        again = []
        if not missed.isEmpty():
            slack = min(1.0, max(slack, SLACK) * 8)
            lo, hi = _bracket(F.floor(position) / share, F.ceil(position) / share, F.lit(slack))
            again.append(_ns_join(missed.select(*keys, "_qi"), sketches, keys, "inner").select(
                *keys, "_qi", "_n", lo.alias("_lo"), hi.alias("_hi")))
        if not crowded.isEmpty():
            rows = _inside(base, crowded, keys, m, broadcast_groups)
            group = [*keys, "_qi"]
            values = rows.groupBy(*group, "_v").agg(F.lit(1).alias("_one")).groupBy(*group).agg(
                F.count(F.lit(1)).alias("_values"))
            crowd = _ns_join(crowded, values, group, "inner")
            ready = ready.unionByName(crowd.where(F.col("_values") <= most).select(*ready.columns))
            thick = materialize_shared(crowd.where(F.col("_values") > most), "quantile-crowded")
            if not thick.isEmpty():
                fine = _sketches(_ns_join(rows, thick.select(*group), group, "left_semi"), group) \
                    .withColumnRenamed("_n", "_rows")
                low = (F.floor(position) - F.col("_below")) / F.greatest(F.col("_rows") - 1, F.lit(1))
                high = (F.ceil(position) - F.col("_below")) / F.greatest(F.col("_rows") - 1, F.lit(1))
                lo, hi = _bracket(low, high, F.lit(SLACK))
                again.append(_ns_join(thick, fine, group, "inner").select(
                    *group, "_n", lo.alias("_lo"), hi.alias("_hi")))
        done = ready.select(*columns) if done is None else done.unionByName(ready.select(*columns))
        if not again:
            return done
        todo = materialize_shared(reduce(DataFrame.unionByName, again), "quantile-todo")


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    qs: list[float],
    names: list[str],
    most: int = MOST,
    slack: float = SLACK,
    broadcast_groups: int = MOST_BROADCAST_GROUPS,
) -> DataFrame:
    """``keys + names``: exact interpolated quantiles of ``value`` per group.

    Equal to ``percentile(value, q)`` (NULLs skipped).  Groups with no
    non-NULL value are absent; join with ``how='left'`` to keep them.
    With no keys the quantiles are global (one row).
    """
    own = keys or ["_all"]
    # not a literal: the planner would turn the equi-join into a nested loop
    source = df if keys else df.withColumn("_all", F.when(F.col(value).isNotNull(), F.lit(0)))
    base = source.select(*own, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    brackets = solved_brackets(base, own, qs, most, slack, broadcast_groups)
    pairs = _inside(base, brackets, own, len(qs), broadcast_groups).groupBy(*own, "_qi", "_v").agg(
        F.count(F.lit(1)).alias("_c"))
    ranked = _ns_join(pairs, brackets.select(*own, "_qi", "_n", "_below"), [*own, "_qi"], "inner")
    w = (Window.partitionBy(*own, "_qi").orderBy("_v")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    q = F.get(F.array(*[F.lit(float(x)) for x in qs]), F.col("_qi"))
    ranked = ranked.select(
        *own, "_qi", "_v", ((F.col("_n") - 1).cast("double") * q).alias("_pos"),
        (F.col("_below") + F.sum("_c").over(w)).alias("_end"), "_c")

    def at_rank(r):
        hit = (F.col("_end") - F.col("_c") <= r) & (r < F.col("_end"))
        return F.max(F.when(hit, F.col("_v")))

    picked = ranked.groupBy(*own, "_qi").agg(
        F.first("_pos").alias("_pos"), at_rank(F.floor("_pos")).alias("_lv"),
        at_rank(F.ceil("_pos")).alias("_hv"))
    low, high = F.floor("_pos"), F.ceil("_pos")
    found = F.when((low == high) | (F.col("_lv") == F.col("_hv")), F.col("_lv")).otherwise(
        (high - F.col("_pos")) * F.col("_lv") + (F.col("_pos") - low) * F.col("_hv"))
    out = picked.groupBy(*own).agg(*[
        F.max(F.when(F.col("_qi") == i, found)).alias(n) for i, n in enumerate(names)])
    return out if keys else out.drop("_all")
