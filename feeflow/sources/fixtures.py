"""Map the driver's tables onto this engine's inputs.

The modelled system ships no input data, so tests and benchmarks derive
block rows, captured messages and transactions from the TPC-H-like
tables (``orders``, ``lineitem``, ``events``).  Every mapping is a Spark
job over the whole tables, so its work grows with them.

Skew notes: lineitem is reduced per order with partial aggregation, and
the seven smallest fees per order come from a ``row_number() <= 7``
filter, which Catalyst turns into a map-side ``WindowGroupLimit``, so even
an order holding a third of all lines sends at most 7 rows per map task
through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feeflow import schemas as S
from feeflow.functions.expressions import epoch_seconds

# Fixed values of the fixture mapping (kept equal to the oracle SQL).
FIXTURE_START = "2026-09-17 00:00:00"
FIXTURE_DAYS = 9
FIXTURE_DAY_SECONDS = 86400
FIXTURE_SPREAD_SECONDS = 7200
FIXTURE_TIME_PRIME = 7919
FIXTURE_FEE_DIVISOR = 250
FIXTURE_MEDIAN_DIVISOR = 7000
FIXTURE_TX_FRAME_SIZE = 64


_READ_CACHE: dict = {}


def _state(spark: SparkSession, path: str) -> tuple:
    """Size and change time of a table: another state is another table."""
    from feeflow.session import file_system

    fs, hadoop = file_system(spark, path)
    return fs.getContentSummary(hadoop).getLength(), fs.getFileStatus(hadoop).getModificationTime()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table.  The (lazy) DataFrame is memoized per
    application, path and state of the files: a fresh ``spark.read`` would
    list the folder and read the footer again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path, _state(spark, path))
    if key not in _READ_CACHE:
        _READ_CACHE[key] = spark.read.parquet(path)
    return _READ_CACHE[key]


def _fee_expr() -> F.Column:
    return F.col("l_extendedprice") / (F.lit(FIXTURE_FEE_DIVISOR) * (F.lit(1) + F.col("l_orderkey") % 4))


def lineitem_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: byte total, transaction count and the 7 smallest fees."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    sums = li.groupBy("l_orderkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("li_bytes"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("li_qty"),
    )
    w = Window.partitionBy("l_orderkey").orderBy(F.col("fee").asc())
    smallest = (
        li.select("l_orderkey", _fee_expr().alias("fee"))
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= len(S.FEE_PERCENTILE_COLUMNS))
        .groupBy("l_orderkey")
        .agg(*[F.max(F.when(F.col("rn") == i + 1, F.col("fee"))).alias(f"f{i}") for i in range(7)])
    )
    return sums.join(smallest, "l_orderkey", "left")


def parsed_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block row per order (FIXTURES 5.1); status 'P' gives the all-NULL row."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    blocks = lineitem_blocks(spark, sf_dir)
    j = orders.join(blocks, orders.o_orderkey == blocks.l_orderkey, "left")
    ok = F.col("o_orderstatus") != F.lit("P")
    k = F.expr("o_orderkey div 2")
    secs = (k % FIXTURE_DAYS) * FIXTURE_DAY_SECONDS + (k * FIXTURE_TIME_PRIME) % FIXTURE_SPREAD_SECONDS
    enq = F.timestamp_add("SECOND", secs, F.lit(FIXTURE_START).cast("timestamp_ntz"))
    payload = {
        "block_size": F.col("li_bytes"),
        "block_vsize": F.expr("li_bytes * (50 + o_orderkey % 50) div 100"),
        "median_fee": F.col("o_totalprice") / FIXTURE_MEDIAN_DIVISOR,
        "n_tx": (F.col("li_qty") * 1000).try_cast("int"),  # beyond an int: NULL, the row stays
        "total_fees": F.round(F.col("o_totalprice") * 100).cast("bigint"),
    }
    payload.update({name: F.col(f"f{i}") for i, name in enumerate(S.FEE_PERCENTILE_COLUMNS)})
    return j.select(
        F.expr("o_orderkey div 4").alias("sequence_number"),
        enq.alias("enqueued_time"),
        (F.col("o_orderkey") % 2).cast("int").alias("block_index"),
        *[F.when(ok, e).cast(S.PARSED[name].dataType).alias(name) for name, e in payload.items()],
    )


_LANDED: dict = {}


def landed_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block-row fixture landed once per application as a Parquet table
    in the shared checkpoint folder - the stored parsed table the models
    read in production.  Derived by Spark from the whole driver tables; later
    queries in the session scan it instead of re-deriving it."""
    from feeflow.session import materialize_shared

    root = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, root, *[_state(spark, f"{root}/{t}.parquet") for t in ("orders", "lineitem")])
    if key not in _LANDED:
        _LANDED[key] = materialize_shared(parsed_from_orders(spark, sf_dir), "parsed")
    return _LANDED[key]


def _block_item(prefix: str = "") -> F.Column:
    return F.struct(
        F.col("block_size").alias("blockSize"),
        F.col("block_vsize").cast("double").alias("blockVSize"),
        F.col("n_tx").alias("nTx"),
        F.col("total_fees").alias("totalFees"),
        F.col("median_fee").alias("medianFee"),
        F.array_compact(F.array(*[F.col(c) for c in S.FEE_PERCENTILE_COLUMNS])).alias("feeRange"),
    )


def messages_from_parsed(parsed: DataFrame) -> DataFrame:
    """Group block rows into captured messages (FIXTURES 5.2).

    A message is one (sequence_number, enqueued_time) pair - two orders by
    construction, so each group is bounded.  Messages with at least one
    payload row become a ``mempool_blocks_event`` whose ``data`` lists those
    rows by ``block_index``; the rest become a ``stats_event`` with an
    object as ``data`` (the shape that parses to the all-NULL row).
    """
    has = F.col("median_fee").isNotNull()
    grouped = parsed.groupBy("sequence_number", "enqueued_time").agg(
        F.sort_array(
            F.collect_list(F.when(has, F.struct(F.col("block_index"), _block_item().alias("item"))))
        ).alias("items"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    ts = epoch_seconds("enqueued_time")
    blocks_body = F.to_json(
        F.struct(
            F.lit(S.MEMPOOL_BLOCKS_EVENT).alias("payload_type"),
            ts.alias("timestamp"),
            F.transform("items", lambda x: x["item"]).alias("data"),
        )
    )
    stats_body = F.to_json(
        F.struct(
            F.lit(S.STATS_EVENT).alias("payload_type"),
            ts.alias("timestamp"),
            F.struct(F.col("n_rows").alias("mempoolSize")).alias("data"),
        )
    )
    body = F.when(F.size("items") > 0, blocks_body).otherwise(stats_body)
    return grouped.select(
        F.col("sequence_number").alias("SequenceNumber"),
        F.date_format("enqueued_time", S.CAPTURE_TIME_FORMAT).alias("EnqueuedTimeUtc"),
        body.cast("binary").alias("Body"),
    )


def capture_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_parsed(landed_parsed(spark, sf_dir))


def frames_from_parsed(parsed: DataFrame) -> DataFrame:
    """Live frames (one JSON object per message) for the router.

    Keys: ``mempool-blocks`` when the message has payload rows; ``block``
    (its first item) when additionally ``sequence_number % 3 = 0``;
    ``stats`` when it has none.  Carries the capture columns alongside.
    """
    has = F.col("median_fee").isNotNull()
    grouped = parsed.groupBy("sequence_number", "enqueued_time").agg(
        F.sort_array(F.collect_list(F.when(has, F.struct(F.col("block_index"), _block_item().alias("item"))))).alias(
            "items"
        ),
        F.count(F.lit(1)).alias("n_rows"),
    )
    items = F.transform("items", lambda x: x["item"])
    nonempty = F.size("items") > 0
    frame = F.to_json(
        F.struct(
            F.when(nonempty & (F.col("sequence_number") % 3 == 0), F.get(items, 0)).alias("block"),
            F.when(nonempty, items).alias("mempool-blocks"),
            F.when(~nonempty, F.struct(F.col("n_rows").alias("mempoolSize"))).alias("stats"),
        )
    )
    return grouped.select("sequence_number", "enqueued_time", frame.alias("frame"))


def transactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mempool transaction per event (FIXTURES 5.3), with its event time."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "value")
    fee = F.round(F.col("value") * 100).cast("bigint")
    vsize = (F.lit(100) + F.col("event_id") % 400).cast("double")
    return ev.select(
        F.col("event_id"),
        F.col("ts"),
        F.md5(F.col("event_id").cast("string")).alias("txid"),
        fee.alias("fee"),
        vsize.alias("vsize"),
        fee.alias("value"),
        (fee.cast("double") / vsize).alias("rate"),
    )


def tx_frames_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames carrying a ``transactions`` array: events grouped per hour and
    per run of 64 row ids.  ``monotonically_increasing_id`` is unique per row
    and never spans input partitions, so no frame exceeds 64 transactions
    whatever the ids in the data (a repeated ``event_id`` cannot grow one)."""
    tx = transactions_from_events(spark, sf_dir).withColumn("_row", F.monotonically_increasing_id())
    grouped = tx.groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("frame_hour"),
        F.expr(f"_row div {FIXTURE_TX_FRAME_SIZE}").alias("frame_block"),
    ).agg(
        F.sort_array(F.collect_list(F.struct("event_id", "txid", "fee", "vsize", "value", "rate"))).alias("txs")
    )
    txs = F.transform("txs", lambda t: F.struct(t["txid"], t["fee"], t["vsize"], t["value"], t["rate"]))
    return grouped.select("frame_hour", "frame_block", F.to_json(F.struct(txs.alias("transactions"))).alias("frame"))
