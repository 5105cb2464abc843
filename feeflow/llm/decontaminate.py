"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as words (lower case, letters and digits).
An item of n words may differ by e = n // 5 edits: whatever passage lies within
e edits of it contains at least one of the item's e + 1 pieces unchanged.  So
each item is split into e + 1 pieces, exact hits of pieces are looked up, and
the words around each hit are verified with Myers' bit-parallel distance.  Items under
five words have no edits to spare and one piece: they are found word for word.
Scripts that are written without blanks (Chinese, Japanese, Thai and the like)
are compared character by character: each character is a word.

The documents are scanned once per block of items; a block (its pieces and
words) is broadcast and bounded in items and words, so a larger benchmark means
more scans, never a larger broadcast.  A document is matched where it is read:
nothing is shuffled, no pairs are formed but those with a piece hit, and a
passage in a third of all documents costs each of them one hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.bytehash import Rolling, mix, row_slices, text_buffer
from feeflow.llm.common import packed, text_of

SIMILARITY_PARTS = 5      # one edit allowed per five words: similarity 0.8
# Scripts without blanks between words; all of them begin at U+0E00, so most
# texts are passed by a single range.
FAR = r"[\x{0E00}-\x{10FFFF}]"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 2_000_000
BLOCK = 1 << 20
_TABLE_BITS = 22


def words_of(column: Column) -> Column:
    """Words separated by one blank: lower case, letters and digits only; a
    character of an unspaced script is a word."""
    lower = F.lower(column)
    apart = F.when(lower.rlike(FAR), F.regexp_replace(lower, UNSPACED, " $0 ")).otherwise(lower)
    return F.trim(F.regexp_replace(apart, r"[^\p{L}\p{N}]+", " "))


def pieces_of(n_words: int, parts: int = SIMILARITY_PARTS) -> list[tuple[int, int]]:
    """(first word, words) of the budget-plus-one pieces of an item."""
    count = n_words // parts + 1
    edges = [n_words * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def myers(masks: dict[int, int], n: int, text: list[int], most: int) -> tuple[int, int]:
    """(least distance, words read at it) of an ``n``-word pattern to any
    stretch of ``text``; ``masks`` has the pattern's places by word.  A
    distance over ``most`` is reported as ``most + 1``."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = most + 1, -1
    for i, word in enumerate(text):
        equal = masks.get(word, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best:
            best, end = score, i + 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
    return best, end


class Block:
    """Items prepared for look-up: piece names by length, masks by item."""

    def __init__(self, items: list[tuple[int, str]], parts: int):
        joined = [words for _, words in items]
        data = np.frombuffer(" ".join(joined).encode(), dtype=np.uint8)
        rolling = Rolling(data)
        self.ids, self.sizes, self.masks = [], [], []
        found: dict[int, list[tuple[int, int, int]]] = {}
        at = 0
        for number, ((item, _), words) in enumerate(zip(items, joined, strict=True)):
            raw = words.encode()
            cuts = [-1, *(m.start() for m in re.finditer(b" ", raw)), len(raw)]
            starts = np.array(cuts[:-1]) + 1 + at
            ends = np.array(cuts[1:]) + at
            names = mix(rolling.ranges(starts, ends)).tolist()
            masks: dict[int, int] = {}
            for i, name in enumerate(names):
                masks[name] = masks.get(name, 0) | (1 << i)
            self.ids.append(item)
            self.sizes.append(len(names))
            self.masks.append(masks)
            for first, size in pieces_of(len(names), parts):
                name = int(mix(rolling.ranges(starts[first: first + 1], ends[first + size - 1: first + size]))[0])
                found.setdefault(size, []).append((name, number, first))
            at += len(raw) + 1
        self.lookup = {}
        for size, rows in found.items():
            rows.sort()
            names = np.array([r[0] for r in rows], dtype=np.uint64)
            table = np.zeros(1 << _TABLE_BITS, dtype=bool)
            table[(names >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.lookup[size] = (names, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]),
                                 table)


def match_block(block: Block, data: np.ndarray, offsets: np.ndarray,
                parts: int) -> list[tuple[int, int, int, int, int]]:
    """(row, item number, distance, first word, words) of the best passage of
    each item in each row of normalised texts."""
    rolling = Rolling(data)
    blank = data == 0x20
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets[:-1][np.diff(offsets) > 0]] = True
    edge[1:] |= blank
    starts = np.flatnonzero(edge[:-1] & ~blank)
    if not len(starts):
        return []
    last = np.zeros(len(data) + 1, dtype=bool)
    last[offsets[1:][np.diff(offsets) > 0]] = True
    last[:-1] |= blank
    ends = np.flatnonzero(last)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    first_word = np.searchsorted(rows, np.arange(len(offsets)))
    spots: dict[tuple[int, int], list[int]] = {}
    for size, (names, numbers, firsts, table) in block.lookup.items():
        if len(starts) < size:
            continue
        n = len(starts) - size + 1
        name = mix(rolling.ranges(starts[:n], ends[size - 1:]))
        maybe = np.flatnonzero(table[(name >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
                               & (rows[:n] == rows[size - 1:]))
        left = np.searchsorted(names, name[maybe])
        right = np.searchsorted(names, name[maybe], side="right")
        for word, a, b in zip(maybe[right > left].tolist(), left[right > left].tolist(),
                              right[right > left].tolist(), strict=True):
            for j in range(a, b):
                spots.setdefault((int(rows[word]), int(numbers[j])), []).append(word - int(firsts[j]))
    out = []
    name = mix(rolling.ranges(starts, ends)) if spots else None
    for (row, number), diagonals in sorted(spots.items()):
        n = block.sizes[number]
        most = n // parts
        low, high = int(first_word[row]), int(first_word[row + 1])
        best = (most + 1, 0, 0)
        stretch = None
        for d in [*sorted(set(diagonals)), None]:
            if stretch is not None and (d is None or d - most > stretch[1]):
                a, b = max(low, stretch[0]), min(high, stretch[1])
                distance, end = myers(block.masks[number], n, name[a:b].tolist(), most)
                if distance < best[0]:
                    best = (distance, a, end)
                stretch = None
            if d is not None:
                stretch = (d - most if stretch is None else stretch[0], d + n + most)
        if best[0] <= most:
            end = best[1] + best[2] - low
            out.append((row, number, best[0], max(0, end - n), min(n, end)))
    return out


MATCHES = "item_id long, n_item_words long, distance long, first_word long, n_words long"


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded items and words, as the driver reads them."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            words_of(text_of()).alias("words")).where("words <> ''")
    block, n_words = [], 0
    for r in rows.toLocalIterator():
        count = r["words"].count(" ") + 1
        if block and (len(block) >= BLOCK_ITEMS or n_words + count > BLOCK_WORDS):
            yield block
            block, n_words = [], 0
        block.append((r["item_id"], r["words"]))
        n_words += count
    if block:
        yield block


def _matched(shared, parts: int, carried: list[str], clean: bool):
    """Matches of each row or, with ``clean``, the rows without a match."""
    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shared.value, parts)
        for batch in batches:
            data, offsets = text_buffer(batch.column("words"))
            for a, b in row_slices(offsets, BLOCK):
                found = match_block(block, data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a],
                                    parts)
                if clean:
                    index = np.setdiff1d(np.arange(a, b), [a + f[0] for f in found])
                else:
                    index = np.array([a + f[0] for f in found], dtype=np.int64)
                taken = [batch.column(c).take(pa.array(index, pa.int64())) for c in carried]
                extra = [] if clean else [
                    pa.array([block.ids[f[1]] for f in found], pa.int64()),
                    pa.array([block.sizes[f[1]] for f in found], pa.int64()),
                    *[pa.array([f[i] for f in found], pa.int64()) for i in (2, 3, 4)]]
                names = [] if clean else ["item_id", "n_item_words", "distance", "first_word", "n_words"]
                yield pa.RecordBatch.from_arrays([*taken, *extra], names=[*carried, *names])
    return matched


def matches(documents: DataFrame, benchmark: DataFrame,
            parts: int = SIMILARITY_PARTS) -> DataFrame:
    """One row per document row and item found in it within one edit per
    ``parts`` words: doc_id, item_id, n_item_words, distance (least, in words),
    and the passage's place (first_word, n_words; its start is that of an
    equally long passage with the same end).

    Null and empty texts, and items without a letter or digit, match nothing;
    items under five words match word for word; of equal distances the first in
    the text is given; long texts are read whole; repeated items and rows each
    have their own matches; an empty table on either side gives no rows.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", words_of(text_of()).alias("words"))
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {MATCHES}"
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)
        found = rows.mapInArrow(_matched(shared, parts, ["doc_id"], clean=False), schema)
        out = out.unionByName(found)
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame,
                      parts: int = SIMILARITY_PARTS) -> DataFrame:
    """The rows of ``documents`` in which no item is found, unchanged."""
    spark, rows = documents.sparkSession, packed(documents, words=words_of(text_of()))
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_matched(shared, parts, rows.columns, clean=True), rows.schema)
    return rows.select("row.*")
