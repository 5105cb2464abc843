"""Repeated passages by distributed prefix doubling.

A position *repeats* when the ``threshold`` bytes that start there also start
at any other position of any document.  Every byte under a repeating string
is removed.

Prefix doubling names (ranks) the strings at all positions for growing
lengths: the rank of length 2L at p is the rank of the pair (rank_L(p),
rank_L(p + L)), positions are brought together by their pairs, and those that
are alone, or past the threshold, drop out.  Three things keep it linear at
corpus size:

* Ranks are 64-bit content names, so a task computes the rank at any offset
  of its own text; the shuffle only has to tell which pairs occur twice.
* Positions travel in runs.  Each position is held by an *anchor*: the least
  ``SEED``-byte name within its ``threshold`` bytes (leftmost on a tie), a
  choice that depends on those bytes alone, so equal strings have equal
  anchors at equal distances.  Consecutive positions share an anchor, about
  one anchor per 70 positions.
* Rounds:  (1) runs are grouped by the rank of their anchor's seed; runs
  alone there are unique and drop.  (2) the offset grows to the whole run:
  runs are grouped by the pair (seed rank, rank of all bytes under the run);
  a pair seen twice is past the threshold at all its positions and is
  settled.  (3, 4) only where one seed has several different surroundings
  do parts of runs travel: cells of eight positions, then single positions,
  each with the pair (rank at p, rank at p + threshold/2) of the bytes its
  windows share; positions whose pair is alone drop, cells that agree on all
  bytes are settled, and at single positions the pair is the whole string.
  One copy of each surrounding, with its count, is enough.

Groups are only ever counted (partial aggregates before the shuffle); no
group is collected, so a passage shared by a third of all documents costs one
small row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.bytehash import Rolling, mix, row_slices, text_buffer
from feeflow.llm.common import row_key, small, stored, text_of

THRESHOLD = 200
SEED = 64
SEGMENT = 1 << 20
_POSITION_BITS = np.uint64(21)

RUNS = "doc_id long, text_key long, seed long, span long, low long, n int, at int"


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    size, least = 1, values
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        rest = width - size
        least = np.minimum(least[:-rest], least[rest:])
    return least


def segment_runs(data: np.ndarray, valid: np.ndarray, threshold: int, seed: int):
    """(low, n, at, seed rank, span rank) of the runs of valid positions.

    ``data`` has at least ``threshold - 1`` bytes after the last valid
    position.  ``at`` is the anchor's place counted from ``low``.
    """
    rolling = Rolling(data)
    names = mix(rolling.windows(seed))
    mask = (np.uint64(1) << _POSITION_BITS) - np.uint64(1)
    keys = (names & ~mask) | np.arange(len(names), dtype=np.uint64)
    anchors = (_sliding_least(keys, threshold - seed + 1) & mask).astype(np.int64)
    anchors = np.where(valid[: len(anchors)], anchors[: len(valid)], -1)
    edges = np.flatnonzero(np.diff(anchors, prepend=-2))
    ends = np.append(edges[1:], len(anchors))
    held = anchors[edges] >= 0
    low, end, anchor = edges[held], ends[held], anchors[edges[held]]
    span = rolling.ranges(low, end - 1 + threshold)
    span = mix(span + (end - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + (anchor - low).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return low, end - low, anchor - low, names[anchor], span


def _valid_positions(offsets: np.ndarray, threshold: int) -> np.ndarray:
    """True where ``threshold`` bytes follow inside the same row."""
    change = np.zeros(int(offsets[-1]) + 1, dtype=np.int32)
    long_enough = np.diff(offsets) >= threshold
    np.add.at(change, offsets[:-1][long_enough], 1)
    np.add.at(change, offsets[1:][long_enough] - threshold + 1, -1)
    return np.cumsum(change[:-1]) > 0


def batch_runs(column: pa.Array, threshold: int = THRESHOLD, seed: int = SEED):
    """Yield (row, low in the row, n, at, seed rank, span rank) arrays.

    Rows go through in blocks of about ``SEGMENT`` bytes; a longer row is cut
    into overlapping segments, so memory stays at a few arrays of a segment.
    """
    data, offsets = text_buffer(column)
    for a, b in row_slices(offsets, SEGMENT):
        block, bounds = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
        for start in range(0, len(block), SEGMENT):
            part = block[start: start + SEGMENT + threshold - 1]
            if len(part) < threshold:
                continue
            here = _valid_positions(np.clip(bounds - start, 0, len(part)), threshold)[:SEGMENT]
            low, n, at, seeds, spans = segment_runs(part, here, threshold, seed)
            row = np.searchsorted(bounds, low + start, side="right") - 1
            yield row + a, low + start - bounds[row], n, at, seeds, spans


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _scan(threshold: int, seed: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for row, low, n, at, seeds, spans in batch_runs(batch.column("text"), threshold, seed):
                index = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(index), keys.take(index), _signed(seeds), _signed(spans),
                     pa.array(low), pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32))],
                    names=["doc_id", "text_key", "seed", "span", "low", "n", "at"])
    return runs


CELLS = ("doc_id long, text_key long, seed long, cell int, low long, n int, at int, "
         "copies long, first long, second long, span long")


def _cells(threshold: int, width: int):
    """Positions of the given runs in cells of ``width``, with rank pairs.

    A cell holds the positions of one run at anchor distances [c * width,
    (c + 1) * width).  The pair ranks the bytes that all windows of the whole
    cell share (first and last half-threshold of them); ``span`` names all
    bytes under the cell's own positions.
    """
    half = (threshold - width + 2) // 2

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            lists = batch.column("runs")
            bounds = lists.offsets.to_numpy().astype(np.int64)
            fields = lists.values
            seeds, low, n, at, copies = (
                fields.field(k).to_numpy(zero_copy_only=False).astype(np.int64)
                for k in ("seed", "low", "n", "at", "copies"))
            for a, b in row_slices(offsets, SEGMENT):
                runs = np.arange(bounds[a], bounds[b])
                if not len(runs):
                    continue
                rolling = Rolling(data[offsets[a]: offsets[b]])
                row_of = np.repeat(np.arange(a, b), np.diff(bounds[a: b + 1]))
                least = (at[runs] - n[runs] + 1) // width
                count = at[runs] // width - least + 1
                of = np.repeat(np.arange(len(runs)), count)
                step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                run, row, cell = runs[of], row_of[of], least[of] + step
                anchor = low[run] + at[run]
                begin = np.maximum(low[run], anchor - (cell + 1) * width + 1)
                last = np.minimum(low[run] + n[run] - 1, anchor - cell * width)
                base = offsets[row] - offsets[a]
                core = base + anchor - cell * width
                core_end = base + anchor - (cell + 1) * width + 1 + threshold
                first = mix(rolling.ranges(core, core + half))
                second = mix(rolling.ranges(core_end - half, core_end))
                span = mix(rolling.ranges(base + begin, base + last + threshold)
                           + (last - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                           + (anchor - begin).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                index = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(index), batch.column("text_key").take(index),
                     pa.array(seeds[run]), pa.array(cell.astype(np.int32)), pa.array(begin),
                     pa.array((last - begin + 1).astype(np.int32)),
                     pa.array((anchor - begin).astype(np.int32)), pa.array(copies[run]),
                     _signed(first), _signed(second), _signed(span)],
                    names=["doc_id", "text_key", "seed", "cell", "low", "n", "at", "copies",
                           "first", "second", "span"])
    return cells


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            row_key().alias("text_key"), text_of().alias("text"))


def _same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    return left.join(right, left.doc_id.eqNullSafe(right._id)
                     & (left.text_key == right._key), how).drop("_id", "_key")


def repeating_runs(documents: DataFrame, threshold: int = THRESHOLD,
                   seed: int = SEED) -> DataFrame:
    """(doc_id, text_key, low, n): runs of ``n`` repeating positions from byte
    ``low``, for rows of ``documents(doc_id, text)``.

    A null text is empty; texts shorter than ``threshold`` have no rows; equal
    rows repeat each other.  ``text_key`` tells rows of one doc_id apart.
    """
    if threshold < 2 * seed:
        seed = max(1, threshold // 2)
    rows = _rows(documents)
    runs = rows.mapInArrow(_scan(threshold, seed), RUNS)
    # round 1: anchors whose seed occurs once hold no repeating position
    # (stored by itself, so that the join below deals the runs anew and a seed
    # with a third of them can be split, or is not shuffled at all)
    seeds = stored(runs.groupBy("seed").agg(
        F.count(F.lit(1)).alias("total"), F.min("span").alias("a"), F.max("span").alias("b")
    ).where("total > 1").select(F.col("seed").alias("_seed"), (F.col("a") != F.col("b")).alias("several")),
        "seeds")
    held = stored(runs.join(small(seeds, 1_000_000), F.col("seed") == F.col("_seed")).drop("_seed"), "runs")
    settled = held.where("not several").select("doc_id", "text_key", "low", "n")
    # round 2: several surroundings; those seen twice are past the threshold
    kinds = stored(
        held.where("several").groupBy("seed", "span").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "text_key", "low", "n", "at")).alias("one")),
        "surroundings")
    twice = small(kinds.where("copies > 1").select(
        F.col("seed").alias("_seed"), F.col("span").alias("_span")))
    whole = held.where("several").join(
        twice, (F.col("seed") == F.col("_seed")) & (F.col("span") == F.col("_span")), "left_semi")
    found = [settled, whole.select("doc_id", "text_key", "low", "n")]
    # rounds 3 and 4: cells of positions, then single positions
    open_runs = kinds.select("one.doc_id", "one.text_key", F.struct(
        "seed", "one.low", "one.n", "one.at", "copies").alias("run"))
    for width in (8, 1):
        per_row = open_runs.groupBy("doc_id", "text_key").agg(F.collect_set("run").alias("runs"))
        cells = _same_row(rows, per_row, "inner").dropDuplicates(["doc_id", "text_key"]) \
            .mapInArrow(_cells(threshold, width), CELLS)
        cells = stored(cells, f"cells-{width}")
        key = ["seed", "cell", "first", "second"]
        classes = stored(cells.groupBy(*key).agg(
            F.sum("copies").alias("total"), F.min("span").alias("a"), F.max("span").alias("b")
        ).where("total > 1").select(*key, (F.col("a") == F.col("b")).alias("whole")), f"repeated-{width}")
        kept = stored(cells.join(classes, key), f"classes-{width}")
        found.append(kept.where("whole and copies = 1").select("doc_id", "text_key", "low", "n"))
        open_runs = kept.where("not whole").select("doc_id", "text_key", F.struct(
            "seed", "low", "n", "at", "copies").alias("run"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part.select(*out.columns))
    return out.select("doc_id", "text_key", F.col("low").cast("long").alias("low"),
                      F.col("n").cast("long").alias("n"))


KEPT = ("doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, "
        "kept binary")


def _cut(threshold: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            lists = batch.column("runs")
            if lists.null_count:
                lists = pa.compute.fill_null(lists, pa.scalar([], lists.type))
            bounds = lists.offsets.to_numpy().astype(np.int64)
            low = lists.values.field("low").to_numpy(zero_copy_only=False)
            n = lists.values.field("n").to_numpy(zero_copy_only=False)
            for a, b in row_slices(offsets, SEGMENT):
                kept, spans, removed = [], [], []
                for row in range(a, b):
                    text = data[offsets[row]: offsets[row + 1]]
                    mine = slice(bounds[row], bounds[row + 1])
                    change = np.zeros(len(text) + 1, dtype=np.int32)
                    np.add.at(change, low[mine], 1)
                    np.add.at(change, low[mine] + n[mine] + threshold - 1, -1)
                    covered = np.cumsum(change[:-1], dtype=np.int32) > 0
                    edges = np.flatnonzero(np.diff(covered, prepend=False, append=False))
                    spans.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
                    kept.append(text[~covered].tobytes())
                    removed.append(int(covered.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(offsets[a: b + 1])),
                     pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
    return cut


def remove_repeats(documents: DataFrame, threshold: int = THRESHOLD,
                   seed: int = SEED) -> DataFrame:
    """Cut every repeated string of ``threshold`` bytes out of each text.

    Returns one row per row of ``documents``: doc_id, n_bytes, n_removed,
    spans (maximal removed byte runs, end exclusive) and kept (the bytes left,
    concatenated; a cut may fall inside a character, hence binary).  Null
    texts count as empty, a null doc_id stays null, an empty table gives an
    empty table; other columns are ignored.
    """
    runs = repeating_runs(documents, threshold, seed)
    per_row = runs.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("low", "n")).alias("runs"))
    return _same_row(_rows(documents), per_row, "left").select(
        "doc_id", "text", "runs").mapInArrow(_cut(threshold), KEPT)
