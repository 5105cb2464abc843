"""Licence scan: sparse TF-IDF cosine to templates, then directory inheritance.

Every line of every file is compared with short licence statements.  Weights
are term frequency times inverse document frequency, counted over all files.  A
line can reach the threshold against a template only if it shares words that
carry enough of the template's weight; lines without any of those words are
dropped before the cosine is computed, which loses none.

A file whose words lie mostly in licence lines, or whose name says so, is the
licence file of its directory.  Files without a licence of their own take that
of the nearest directory above them: distinct directories are joined with
their own ancestor paths, then files with their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.common import row_key, small, stored, text_of

THRESHOLD = 0.7
MOSTLY = 0.5          # share of a file's words in licence lines
NAME = r"(?i)^(licen[cs]e|copying|unlicense)(\..*)?$"

# Licence names and the statements that announce them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

VOCABULARY = sorted({w for _, t in TEMPLATES for w in re.findall(r"[^\W_]+", t.lower())})


def words_of(column: Column) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _idf(n_files: int, n_with: int) -> float:
    return math.log((1 + n_files) / (1 + n_with)) + 1


def _template_weights(idf: dict[str, float]) -> list[tuple[int, str, str, float]]:
    """(template, licence, word, weight / norm) of all templates."""
    rows = []
    for number, (licence, text) in enumerate(TEMPLATES):
        count = Counter(re.findall(r"[^\W_]+", text.lower()))
        weight = {w: n * idf[w] for w, n in count.items()}
        norm = math.sqrt(sum(x * x for x in weight.values()))
        rows += [(number, licence, w, x / norm) for w, x in sorted(weight.items())]
    return rows


def _needed(rows: list[tuple[int, str, str, float]], threshold: float) -> list[str]:
    """Words of which a line at the threshold has at least one: the cosine is
    at most the norm of the shared part of the template."""
    needed: set[str] = set()
    for number in {r[0] for r in rows}:
        left = 1.0
        for _, _, word, x in sorted((r for r in rows if r[0] == number), key=lambda r: -r[3]):
            if left < threshold ** 2 * (1 - 1e-9):
                break
            needed.add(word)
            left -= x * x
    return sorted(needed)


def own_licences(files: DataFrame, threshold: float = THRESHOLD, mostly: float = MOSTLY) -> DataFrame:
    """(path, text_key, licence, similarity, is_mostly) of the files with a
    line at the threshold; the most similar line and template decide."""
    spark = files.sparkSession
    rows = files.select("path", row_key().alias("text_key"), text_of().alias("text"))
    n_files = files.count()
    vocabulary = F.array(*[F.lit(w) for w in VOCABULARY])
    seen = {r["word"]: r["n"] for r in rows.select(
        F.explode(F.array_intersect(words_of(F.col("text")), vocabulary)).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per template word
    weights = _template_weights({w: _idf(n_files, seen.get(w, 0)) for w in VOCABULARY})
    needed = F.array(*[F.lit(w) for w in _needed(weights, threshold)])
    lines = rows.select("path", "text_key", F.size(words_of(F.col("text"))).alias("n_all"),
                        F.posexplode(F.split("text", "\n")).alias("place", "line")) \
        .select("path", "text_key", "n_all", "place", words_of(F.col("line")).alias("words")) \
        .where(F.arrays_overlap("words", needed))
    lines = stored(lines, "licence-lines")
    line = ["path", "text_key", "place"]
    terms = lines.distinct().select(*line, "n_all", F.size("words").alias("n_line"), F.explode("words").alias("word")) \
        .groupBy(*line, "n_all", "n_line", "word").agg(F.count(F.lit(1)).alias("tf"))
    wanted = stored(terms.select("word").distinct(), "licence-words")
    spread = rows.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")) \
        .join(small(wanted), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n_with"))
    idf = F.log(F.lit(float(1 + n_files)) / (1 + F.col("n_with"))) + 1
    weighted = terms.join(small(stored(spread, "licence-df")), "word").withColumn("w", F.col("tf") * idf)
    norms = weighted.groupBy(*line, "n_all", "n_line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    templates = spark.createDataFrame(weights, "template int, licence string, word string, t double")
    dots = weighted.join(F.broadcast(templates), "word").groupBy(*line, "template", "licence").agg(
        F.sum(F.col("w") * F.col("t")).alias("dot"))
    close = dots.join(norms, line).withColumn("similarity", F.col("dot") / F.col("norm")) \
        .where(F.col("similarity") >= threshold)
    best = close.groupBy(*line, "n_all", "n_line").agg(
        F.max_by("licence", F.struct("similarity", "licence")).alias("licence"),
        F.max("similarity").alias("similarity"))
    return best.groupBy("path", "text_key", "n_all").agg(
        F.max_by("licence", F.struct("similarity", "licence")).alias("licence"),
        F.max("similarity").alias("similarity"), F.sum("n_line").alias("inside")
    ).select("path", "text_key", "licence", "similarity",
             (F.col("inside") >= mostly * F.col("n_all")).alias("is_mostly"))


def _directory(path: str = "path") -> Column:
    return F.regexp_replace(F.coalesce(F.col(path), F.lit("")), r"/?[^/]*$", "")


def inherited_licences(files: DataFrame, own: DataFrame) -> DataFrame:
    """(directory, licence): that of the nearest licence file at or above."""
    named = F.regexp_extract(F.coalesce(F.col("path"), F.lit("")), r"[^/]*$", 0).rlike(NAME)
    holders = own.where(F.col("is_mostly") | named).groupBy(_directory().alias("above")).agg(
        F.max_by("licence", F.struct("similarity", "licence")).alias("licence"))
    directories = files.select(_directory().alias("directory")).distinct()
    depth = F.size(F.split("directory", "/"))
    chain = directories.select("directory", F.explode(F.sequence(F.lit(0), depth)).alias("depth")).select(
        "directory", "depth", F.array_join(F.slice(F.split("directory", "/"), F.lit(1), F.col("depth")), "/")
        .alias("above"))
    return chain.join(holders, "above").groupBy("directory").agg(
        F.max_by("licence", "depth").alias("licence"))


def scan(files: DataFrame, threshold: float = THRESHOLD, mostly: float = MOSTLY) -> DataFrame:
    """All columns of ``files(path, text, ...)`` but text, with licence (null:
    none), origin (own, inherited or none) and similarity (null unless own).

    Null texts are empty, a null path lies at the root; equal rows get equal
    results; an empty table gives an empty table.
    """
    own = stored(own_licences(files, threshold, mostly), "own-licences")
    above = small(stored(inherited_licences(files, own), "inherited-licences"))
    mine = own.select(F.col("path").alias("_path"), F.col("text_key").alias("_key"),
                      F.col("licence").alias("_own"), F.col("similarity").alias("_similarity"))
    keyed = files.withColumns({"__key": row_key(), "__dir": _directory()}) \
        .select(F.struct(*[F.col(f"`{c}`") for c in files.columns if c != "text"]).alias("row"),
                F.col("path"), F.col("__key"), F.col("__dir"))
    joined = keyed.join(mine, F.col("path").eqNullSafe(F.col("_path")) & (F.col("__key") == F.col("_key")),
                        "left").join(above.withColumnRenamed("licence", "_above"),
                                     F.col("__dir") == F.col("directory"), "left")
    origin = F.when(F.col("_own").isNotNull(), "own").when(F.col("_above").isNotNull(), "inherited") \
        .otherwise("none")
    return joined.select("row.*", F.coalesce("_own", "_above").alias("licence"),
                         origin.alias("origin"), F.col("_similarity").alias("similarity"))


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files: source/lang/doc_id."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")]
    return documents.select("doc_id", F.concat_ws("/", *part).alias("path"), "text")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SQL_TEMPLATES = ", ".join(
    f"({i}, {_sql_text(n)}, {_sql_text(w)}, {c})" for i, (n, t) in enumerate(TEMPLATES)
    for w, c in sorted(Counter(re.findall(r"[^\W_]+", t.lower())).items()))

#: The same result for DuckDB, without the pruning.
ORACLE = f"""
WITH template_words(template, licence, word, tf) AS (VALUES {_SQL_TEMPLATES}),
files AS (
  SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') AS directory,
         coalesce(text, '') AS text FROM documents
), counted AS (
  SELECT word, count(*) AS n_with FROM (
    SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM files)
  GROUP BY word
), total AS (SELECT count(*) AS n FROM files
), template_raw AS (
  SELECT template, licence, t.word, tf * (ln((1 + n) / CAST(1 + coalesce(n_with, 0) AS DOUBLE)) + 1) AS w
  FROM template_words t LEFT JOIN counted c ON t.word = c.word, total
), template_weights AS (
  SELECT template, licence, word, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS t FROM template_raw
), lines AS (
  SELECT doc_id, directory, n_all, place, regexp_extract_all(lower(line), '[\\p{{L}}\\p{{N}}]+') AS words
  FROM (SELECT doc_id, directory, n_all, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, directory, len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS n_all,
                     string_split(text, chr(10)) AS parts FROM files))
), terms AS (
  SELECT doc_id, directory, n_all, place, n_line, word, count(*) AS tf
  FROM (SELECT doc_id, directory, n_all, place, len(words) AS n_line, unnest(words) AS word FROM lines)
  GROUP BY ALL
), weighted AS (
  SELECT t.*, tf * (ln((1 + n) / CAST(1 + n_with AS DOUBLE)) + 1) AS w
  FROM terms t JOIN counted c ON t.word = c.word, total
), norms AS (
  SELECT doc_id, directory, n_all, place, n_line, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY ALL
), best AS (
  SELECT n.doc_id, n.directory, n.n_all, n.place, n.n_line, d.licence, d.dot / n.norm AS similarity
  FROM norms n JOIN (SELECT doc_id, place, template, licence, sum(w * t) AS dot
                     FROM weighted JOIN template_weights USING (word) GROUP BY ALL) d
    ON n.doc_id = d.doc_id AND n.place = d.place
  WHERE d.dot / n.norm >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY n.doc_id, n.place ORDER BY d.dot / n.norm DESC, d.licence DESC) = 1
), own AS (
  SELECT doc_id, directory, arg_max(licence, similarity) AS licence, max(similarity) AS similarity,
         sum(n_line) >= {MOSTLY} * n_all AS is_mostly
  FROM best GROUP BY doc_id, directory, n_all
), holders AS (
  SELECT directory AS above, arg_max(licence, similarity) AS licence FROM own WHERE is_mostly GROUP BY directory
)
SELECT f.doc_id, coalesce(o.licence, h.licence) AS licence,
       CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN h.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       round(o.similarity, 6) AS similarity
FROM files f LEFT JOIN own o ON f.doc_id = o.doc_id LEFT JOIN holders h ON f.directory = h.above
"""
