"""Quality rules with suffix-array repetition.

Words are ``[^\\x20\\x09-\\x0D]+``.  The base counts are plain; the method
sorts the word suffixes of each text (a suffix array by prefix doubling),
reads the longest-common-prefix intervals - each interval with a common prefix
longer than its neighbours' is a maximal repeated substring - unions their
spans, and limits the covered fraction of the text and the longest repeat.

A text is one row, so its suffix array is local to a task.  A task sorts a
block of texts at once: the text number is the leading sort key, and only
suffixes that still tie take part in the next doubling, so ordinary prose is
done after two or three short rounds.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feeflow.llm.bytehash import Rolling, row_slices, text_buffer
from feeflow.llm.common import packed, text_of

WINDOW = 5              # words of the base rule's windows
MIN_WORDS = 10
MAX_WINDOW_PERCENT = 20
MIN_REPEAT = 8          # words: shorter repeats are not counted as copied text
MAX_COVERED = 0.3       # fraction of the words under repeats of MIN_REPEAT
MAX_REPEAT = 100        # words in the longest repeat

BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHARACTER_START = np.ones(256, dtype=bool)
_CHARACTER_START[0x80:0xC0] = False


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of all rows, in order; no word crosses rows."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    before[row_starts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[row_starts[1:] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def suffix_order(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of all rows' words (grouped by row) and its LCP array.

    ``lcp[i]`` is the number of leading words that suffixes ``order[i-1]`` and
    ``order[i]`` share inside one row.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbol = _ranks(words).astype(np.int64) + 1
    row_end = np.searchsorted(rows, rows, side="right")
    # one row's suffixes stand together; ranks are positions of group heads
    order = np.lexsort((symbol, rows))
    head = np.ones(n, dtype=bool)
    head[1:] = (symbol[order][1:] != symbol[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    size = 1
    while True:
        tied = ~head
        tied[:-1] |= ~head[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            break
        suffix = order[places]
        ahead = suffix + size
        second = np.where(ahead < row_end[suffix], rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[suffix]
        sort = np.lexsort((second, first))
        suffix, first, second = suffix[sort], first[sort], second[sort]
        order[places] = suffix
        new = np.ones(len(places), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        head[places] = new
        rank[suffix] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        size *= 2
    lcp = _common_prefixes(symbol, rows, order, row_end)
    return order, lcp


def _common_prefixes(symbol: np.ndarray, rows: np.ndarray, order: np.ndarray,
                     row_end: np.ndarray) -> np.ndarray:
    """Longest common prefix of neighbours in the suffix array.

    Names of 2**j words, compared from the largest power down, give the exact
    length with one vector pass per power.
    """
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    pairs = np.flatnonzero(rows[order][1:] == rows[order][:-1]) + 1
    left, right = order[pairs - 1], order[pairs]
    same = symbol[left] == symbol[right]
    pairs, left, right = pairs[same], left[same], right[same]
    names, levels = symbol, []
    while len(pairs):
        width = 1 << len(levels)
        levels.append(names)
        fits = np.maximum(left, right) + 2 * width <= row_end[left]
        ahead = np.minimum(np.arange(n) + width, n - 1)
        whole = np.arange(n) + 2 * width <= row_end
        grown = np.where(whole, _ranks(names * np.int64(n + 1) + names[ahead]) + 1, 0)
        again = fits & (grown[left] == grown[right])
        if not again.any():
            break
        names = grown
    length, a, b = np.zeros(len(pairs), np.int64), left.copy(), right.copy()
    for level in range(len(levels) - 1, -1, -1):
        width = 1 << level
        fits = np.maximum(a, b) + width <= row_end[left]
        equal = fits & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        step = np.where(equal, width, 0)
        length, a, b = length + step, a + step, b + step
    # a power may match twice at the top level
    while True:
        width = 1 << max(len(levels) - 1, 0)
        fits = (np.maximum(a, b) + width <= row_end[left]) if len(levels) else np.zeros(0, bool)
        if not len(pairs) or not fits.any():
            break
        equal = fits & (levels[-1][np.minimum(a, n - 1)] == levels[-1][np.minimum(b, n - 1)])
        if not equal.any():
            break
        step = np.where(equal, width, 0)
        length, a, b = length + step, a + step, b + step
    lcp[pairs] = length
    return lcp


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of each suffix's longest repeat of ``least`` words.

    A suffix lies in the two LCP intervals that end and begin beside it; the
    longer common prefix is the longest repeated substring starting there, and
    the union over all suffixes is the union over all maximal repeats.
    """
    longest = lcp.copy()
    longest[:-1] = np.maximum(longest[:-1], lcp[1:])
    found = longest >= least
    return order[found], longest[found]


def _union_size(start: np.ndarray, length: np.ndarray, rows: np.ndarray,
                n_rows: int) -> np.ndarray:
    """Words of each row under the union of the spans."""
    change = np.zeros(len(rows) + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(rows[covered], minlength=n_rows)


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    n_rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    start = np.concatenate([offsets[:-1], breaks + 1])
    row = np.searchsorted(offsets, start, side="right") - 1
    row[:n_rows] = np.arange(n_rows)
    # a line that starts just after a row's last byte belongs to the row before
    row[n_rows:] = np.searchsorted(offsets, breaks, side="right") - 1
    sort = np.lexsort((start, row))
    start, row = start[sort], row[sort]
    end = np.empty_like(start)
    end[:-1] = np.where(row[1:] == row[:-1], start[1:] - 1, offsets[row[:-1] + 1])
    end[-1:] = offsets[row[-1:] + 1]
    letters = np.concatenate([[0], np.cumsum(~_SPACE[data])])
    real = letters[end] > letters[start]
    start, end, row = start[real], end[real], row[real]
    name = rolling.ranges(start, end)
    sort = np.lexsort((name, end - start, row))
    name, size, row = name[sort], (end - start)[sort], row[sort]
    again = (name[1:] == name[:-1]) & (size[1:] == size[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row[1:][again], minlength=n_rows)


def measure(data: np.ndarray, offsets: np.ndarray, least: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """All counts of a block of texts, one entry per row."""
    n_rows = len(offsets) - 1
    rolling = Rolling(data)
    starts, ends = word_bounds(data, offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    word = rolling.ranges(starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order, lcp = suffix_order(word, rows)
    counted = np.concatenate([[0], np.cumsum(~_SPACE[data] & _CHARACTER_START[data])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    windows, lengths = maximal_repeats(order, lcp, WINDOW)
    spans, long = maximal_repeats(order, lcp, least)
    longest = np.zeros(n_rows, dtype=np.int64)
    np.maximum.at(longest, rows[spans], long)
    return {
        "n_words": np.bincount(rows, minlength=n_rows),
        "word_chars": counted[offsets[1:]] - counted[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _duplicate_lines(data, offsets, rolling),
        "n_repeat_words": _union_size(windows, lengths, rows, n_rows),
        "n_covered_words": _union_size(spans, long, rows, n_rows),
        "longest_repeat": longest,
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_covered_words", "longest_repeat")


def _counted(least: int, carried: list[str], source: str | None):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(source) if source else batch.column("row").field("text")
            data, offsets = text_buffer(texts)
            for a, b in row_slices(offsets, BLOCK):
                found = measure(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in carried]
                    + [pa.array(found[c].astype(np.int64)) for c in COUNTS],
                    names=[*carried, *COUNTS])
    return counted


def quality_rules(documents: DataFrame, carried: tuple[str, ...] = ("doc_id",),
                  min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
                  max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Counts and verdict of every row of ``documents``.

    Returns the ``carried`` columns, the counts of ``COUNTS``, base_failed and
    kept.  base_failed: fewer than ten words, or more than a fifth of the
    words in five-word windows found twice in the text.  kept: not
    base_failed, words under repeats of ``min_repeat`` words at most
    ``max_covered`` of the text, no repeat longer than ``max_repeat`` words.
    A null or empty text has no words and fails the base.  Rows are judged alone: order, ties and
    repeated rows do not matter; an empty table gives an empty table.
    """
    names = [c for c in documents.columns if c in carried]
    rows = documents.select(*[F.col(f"`{c}`") for c in names])
    source = "_text"
    while source in names:
        source += "_"
    return _judged(rows.schema, documents.select(*rows.columns, text_of().alias(source)), source,
                   min_repeat, max_covered, max_repeat)


def _judged(kept: T.StructType, rows: DataFrame, source: str | None, min_repeat: int,
            max_covered: float, max_repeat: int) -> DataFrame:
    """The ``kept`` columns of ``rows`` with the counts and verdicts of their
    texts: the column ``source``, or the field text of ``row``."""
    schema = T.StructType(kept.fields + [T.StructField(c, T.LongType()) for c in COUNTS])
    counts = rows.mapInArrow(_counted(min_repeat, kept.names, source), schema)
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_WINDOW_PERCENT * F.col("n_words"))
    good = ((F.col("n_covered_words") <= max_covered * F.col("n_words"))
            & (F.col("longest_repeat") <= max_repeat))
    return counts.withColumn("base_failed", base).withColumn("kept", ~base & good)


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the rules keep, unchanged."""
    rows = packed(documents)
    return _judged(rows.schema, rows, None, MIN_REPEAT, MAX_COVERED, MAX_REPEAT).where("kept").select("row.*")
