"""Line dedup by distinct-site spread (DataFrame functions only).

A line that many sites carry is boilerplate.  Its spread is the number of
distinct sites with the line.  HyperLogLog sketches of the sites, one per line
hash, merge by aggregation; lines whose estimate lies near the threshold get
an exact distinct count.  A boilerplate line stays where it is seen first (the
smallest document id) and goes everywhere else, so a document copied to many
sites is not wiped out with its copies.

Copies of one text count once, at the site of their least document id: a page
mirrored everywhere is one page, and its lines are not boilerplate by that.

Only lines on two sites or more can pass, and whether a line is on two sites is
a plain ``min(site) <> max(site)``; sketches are built for those lines alone.
Sketches and counts are partial aggregates, so a line in a third of all
documents adds one small row per task.  A document joins the places of its own
dropped lines, never the lines of others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.common import packed, row_key, small, stored, text_of

MIN_SITES = 10
MARGIN = 0.25      # share of the threshold that counts as near
LOG_K = 10         # sketch of 1024 registers: about 3 % error


def _content(line: Column) -> Column:
    """A line as compared: without surrounding blanks."""
    return F.trim(F.regexp_replace(line, r"[\t\u000B\f\r]", " "))


def _lines(documents: DataFrame, site: str) -> DataFrame:
    """One row per line with content: its row, place, hash and site."""
    line = _content(F.col("_line"))
    return documents.select(
        F.col("doc_id").alias("_id"), row_key().alias("_key"),
        F.xxhash64(F.coalesce(F.col(f"`{site}`").cast("string"), F.lit(""))).alias("_site"),
        F.posexplode(F.split(text_of(), "\n")).alias("_at", "_line"),
    ).where(F.length(line) > 0).select(
        "_id", "_key", "_site", "_at",
        F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(29), line).alias("_h2"))


def _once(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of one row of each text, the one with the least id."""
    lenders = documents.select(
        F.col("doc_id"), row_key().alias("_k"), F.xxhash64(F.lit(31), text_of()).alias("_k2")
    ).groupBy("_k", "_k2").agg(F.min("doc_id").alias("_lender"))
    return lines.join(small(stored(lenders, "lenders")), F.col("_id").eqNullSafe(F.col("_lender"))
                      & (F.col("_key") == F.col("_k")), "left_semi")


def spread_lines(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                 margin: float = MARGIN, log_k: int = LOG_K) -> DataFrame:
    """(_h1, _h2, _first, n_sites): the lines on ``min_sites`` sites or more.

    ``n_sites`` is exact near the threshold and the sketch's estimate beyond;
    ``_first`` is the smallest document id with the line.  A null site counts
    as one site, the empty name.
    """
    lines = stored(_once(documents, _lines(documents, site)), "lines")
    return _spread(lines, min_sites, margin, log_k)


def _spread(lines: DataFrame, min_sites: int, margin: float, log_k: int) -> DataFrame:
    line = ["_h1", "_h2"]
    wide = stored(lines.groupBy(*line).agg(
        F.min("_site").alias("a"), F.max("_site").alias("b"), F.min("_id").alias("_first")
    ).where("a <> b").select(*line, "_first"), "wide-lines")
    estimate = stored(
        lines.join(small(wide.select(*line)), line, "left_semi").groupBy(*line).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(log_k))).alias("n_sites")),
        "line-spread")
    off = F.col("n_sites") - min_sites
    near = estimate.where(F.abs(off) <= margin * min_sites + 1)
    exact = lines.join(small(near.select(*line)), line, "left_semi") \
        .groupBy(*line).agg(F.count_distinct("_site").alias("n_sites"))
    clear = estimate.where(off > margin * min_sites + 1)
    found = exact.where(F.col("n_sites") >= min_sites).unionByName(clear)
    return stored(wide.join(found, line), "spread-lines")


def drop_spread_lines(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                      margin: float = MARGIN, log_k: int = LOG_K) -> DataFrame:
    """All columns of ``documents`` with boilerplate lines cut from ``text``,
    and n_lines, n_dropped.

    Lines are ``\\n``-separated and compared without surrounding blanks; lines
    without content are never dropped.  A text that loses nothing is unchanged
    (a null stays null); one that loses all its lines becomes empty.  Rows with
    a null doc_id never hold the first place.  Equal rows lose the same lines.
    """
    names = documents.columns
    lines = stored(_lines(documents, site), "lines")
    found = _spread(stored(_once(documents, lines), "lines-once"), min_sites, margin, log_k)
    places = lines.join(small(found.select("_h1", "_h2", "_first")), ["_h1", "_h2"]) \
        .where(~F.col("_id").eqNullSafe(F.col("_first"))) \
        .groupBy("_id", "_key").agg(F.collect_set("_at").alias("_drop"))
    keyed = packed(documents, doc_id=F.col("doc_id"), key=row_key())
    joined = keyed.join(
        places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    drop = F.coalesce(F.col("_drop"), F.array().cast("array<int>"))
    parts = F.split(text_of("row.text"), "\n")
    left = F.array_join(F.filter(parts, lambda line, at: ~F.array_contains(drop, at)), "\n")
    return joined.select(
        *[F.when(F.size(drop) > 0, left).otherwise(F.col("row.text")).alias("text") if c == "text"
          else F.col(f"row.`{c}`") for c in names],
        F.size(parts).cast("long").alias("n_lines"), F.size(drop).cast("long").alias("n_dropped"))


#: The same rows for DuckDB; lines are compared by their text.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, coalesce(source, '') AS site, place, raw,
         trim(regexp_replace(raw, '[\\t\\v\\f\\r]', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, unnest(parts) AS raw, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS parts
              FROM documents))
), spread AS (
  SELECT line, min(doc_id) AS first_id FROM lines WHERE length(line) > 0
    AND doc_id IN (SELECT min(doc_id) FROM documents GROUP BY coalesce(text, ''))
  GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}
), marked AS (
  SELECT l.doc_id, l.place, l.raw, s.line IS NOT NULL AND l.doc_id <> s.first_id AS dropped
  FROM lines l LEFT JOIN spread s ON l.line = s.line AND length(l.line) > 0
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       md5(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS text_md5
FROM marked GROUP BY doc_id
"""
