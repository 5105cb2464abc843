"""Sharding by extendible hashing.

A directory maps hash prefixes to shards.  It starts as one bucket; only
buckets over the byte limit split on one more bit of the hash, until every
bucket fits.  A row's shard is the directory entry that its hash begins with.

The rounds look at hashes and sizes only (a stored three-column table), and
each round reads only the rows of buckets that are still too large.  Sizes are
partial sums per prefix; the directory stays a table, joined on (depth,
prefix), because it grows with the data.

The hash covers the id and the text, so rows that share one id spread.  Equal
rows share it too; the bits after it are the row's number in the table, lowest
bit first, which no two rows share: a third of all rows being one row still
splits evenly, down to single rows.  One row over the limit is a shard of its
own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from feeflow.llm.common import small, stored, text_of

MAX_BYTES = 16 << 20
HASH_BITS = 28       # from the row's content
PLACE_BITS = 34      # the row's number
BITS = HASH_BITS + PLACE_BITS
_SCAN_BITS = 33      # of monotonically_increasing_id, for the row inside its scan partition


def row_hash() -> Column:
    """28 bits of the md5 of id and text."""
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                        F.md5(text_of()))
    return F.conv(F.substring(F.md5(identity), 1, HASH_BITS // 4), 16, 10).cast("long")


def hashed_rows(documents: DataFrame) -> DataFrame:
    """Stored (doc_id, hash, bytes): 62 bits, the last 34 different for every
    row.  A row's number is its scan partition's offset (one small row a
    partition) plus its place there."""
    rows = stored(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("content"),
        F.monotonically_increasing_id().alias("at"),
        F.octet_length(text_of()).cast("long").alias("bytes")), "rows")
    part = F.shiftright("at", _SCAN_BITS).alias("part")
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "offsets")
    number = F.col("offset") + F.col("at").bitwiseAND((1 << _SCAN_BITS) - 1)
    place = F.conv(F.reverse(F.lpad(F.bin(number), PLACE_BITS, "0")), 2, 10).cast("long")
    return stored(rows.withColumn("part", part).join(small(offsets), "part").select(
        "doc_id", (F.shiftleft("content", PLACE_BITS) + place).alias("hash"), "bytes"), "hashed-rows")


def _prefix(hash_column: str, depth: int) -> Column:
    return F.shiftright(F.col(hash_column), BITS - depth)


def directory(rows: DataFrame, max_bytes: int = MAX_BYTES, step: int = 6) -> DataFrame:
    """(depth, prefix, shard_bytes, shard_rows) for ``rows(hash, bytes)``.

    ``step`` levels are summed per round; a bucket splits level by level
    inside the round, so the result is that of one bit at a time.
    """
    found, open_rows, top = None, rows, 0
    while True:
        bottom = min(top + step, BITS)
        sums = open_rows.groupBy(_prefix("hash", bottom).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        # at most 2**step cells below one bucket: their levels are summed together
        cells = sums.withColumn("top", F.shiftright("prefix", bottom - top)).repartition("top")
        fits, total_bytes, total_rows = F.lit(None), F.lit(None), F.lit(None)
        for level in range(bottom, top - (top == 0), -1):
            below = Window.partitionBy("top", F.shiftright("prefix", bottom - level))
            size, count = F.sum("bytes").over(below), F.sum("rows").over(below)
            here = (size <= max_bytes) | (count == 1) | F.lit(level == BITS)
            fits = F.when(here, F.lit(level)).otherwise(fits)
            total_bytes = F.when(here, size).otherwise(total_bytes)
            total_rows = F.when(here, count).otherwise(total_rows)
        solved = stored(cells.select(
            "prefix", fits.cast("int").alias("depth"), total_bytes.cast("long").alias("shard_bytes"),
            total_rows.cast("long").alias("shard_rows")), "buckets")
        entries = solved.where("depth is not null").select(
            "depth", F.expr(f"shiftright(prefix, {bottom} - depth)").alias("prefix"),
            "shard_bytes", "shard_rows").distinct()
        found = entries if found is None else found.unionByName(entries)
        over = solved.where("depth is null").select(F.col("prefix").alias("_up"))
        if bottom == BITS or over.isEmpty():
            return found
        open_rows = stored(open_rows.join(
            over, _prefix("hash", bottom) == F.col("_up"), "left_semi"), "open-rows")
        top = bottom


def shard(documents: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, n_bytes and the shard (depth, prefix, shard_bytes, shard_rows)
    of every row; ``shard`` names it as a string of bits.

    n_bytes is the UTF-8 size of the text (null: 0).  Every shard holds at
    most ``max_bytes``, or a single row.  An empty table gives an empty table.
    """
    rows = hashed_rows(documents)
    entries = stored(directory(rows.select("hash", "bytes"), max_bytes), "directory")
    depths = [r.depth for r in entries.select("depth").distinct().collect()]  # BITS + 1 at most
    # a row looks up its prefix at each depth in use; exactly one is an entry
    looked = rows.withColumn("depth", F.explode(F.array([F.lit(d) for d in sorted(depths)] or
                                                        [F.lit(0)])))
    prefix = F.expr(f"shiftright(hash, {BITS} - depth)")
    found = looked.withColumn("prefix", prefix).join(entries, ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.expr("lpad(bin(prefix), depth, '0')"))
    return found.select("doc_id", F.col("bytes").alias("n_bytes"), "depth", bits.alias("shard"),
                        "shard_bytes", "shard_rows")


def oracle(max_bytes: int) -> str:
    """The same directory for DuckDB, one bit at a time."""
    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                             || md5(coalesce(text, ''))), 1, {HASH_BITS // 4}))::BIGINT AS h
  FROM documents
), sizes AS (
  SELECT d.depth, h >> ({HASH_BITS} - d.depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes,
         count(*) AS shard_rows
  FROM hashed, (SELECT unnest(range(0, 25)) AS depth) d GROUP BY ALL
), walk AS (
  SELECT depth, prefix, shard_bytes, shard_rows FROM sizes WHERE depth = 0
  UNION ALL
  SELECT s.depth, s.prefix, s.shard_bytes, s.shard_rows
  FROM walk w JOIN sizes s ON s.depth = w.depth + 1 AND s.prefix >> 1 = w.prefix
  WHERE w.shard_bytes > {max_bytes} AND w.shard_rows > 1
)
SELECT h.doc_id, h.n_bytes, CAST(w.depth AS INTEGER) AS depth,
       CASE WHEN w.depth = 0 THEN '' ELSE right(lpad(bin(w.prefix), 64, '0'), CAST(w.depth AS INTEGER)) END AS shard,
       w.shard_bytes, w.shard_rows
FROM hashed h JOIN walk w ON h.h >> ({HASH_BITS} - w.depth) = w.prefix
WHERE NOT (w.shard_bytes > {max_bytes} AND w.shard_rows > 1)
"""
