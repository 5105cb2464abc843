"""Sequence packing by non-negative least squares over length combinations.

Each document's ids (and an end id) are cut into full windows, one remainder
of whole ``UNIT``s and a crumb shorter than a unit.  The histogram of the
remainders' lengths has at most ``window / unit`` classes however large the
corpus.  All combinations of up to ``DEPTH`` lengths that fill a window exactly
are enumerated; non-negative least squares finds how often to use each so that
the histogram is met; the counts are rounded down to what is there.  Remainders
left over, and the crumbs, are packed greedily: laid end to end and cut at the
window (pieces may be cut freely).  Only the last stretch of that stream can
fall short; it is split into powers of two, which need no padding.

Spark side: ids are made once and stored; the driver sees only the class
histogram and solves it; which sequence a piece goes to is arithmetic on its
rank in its class, and a rank is its file's offset (sums per file and class,
one small row each) plus its place in the file, counted while encoding.  Ids
are never shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feeflow.llm.bytehash import row_slices, text_buffer
from feeflow.llm.common import stored, text_of
from feeflow.llm.tokens import block_encoder

WINDOW = 1024
UNIT = 16
DEPTH = 3
END_ID = 0
BLOCK = 1 << 20
MAX_BROADCAST_OFFSETS = 200_000  # rows of 28 bytes; beyond it the join shuffles


# -- the plan: small arrays on the driver --------------------------------------

def combinations(parts: int, depth: int) -> np.ndarray:
    """All multisets of up to ``depth`` lengths 1..parts with sum ``parts``;
    one row per combination, column c the number of lengths c + 1."""
    found: list[list[int]] = []

    def extend(chosen: list[int], left: int, least: int) -> None:
        if left == 0:
            found.append(chosen)
        elif len(chosen) < depth:
            for length in range(least, left + 1):
                extend([*chosen, length], left - length, length)

    extend([], parts, 1)
    rows = np.zeros((len(found), parts))
    for i, chosen in enumerate(found):
        np.add.at(rows[i], np.array(chosen) - 1, 1)
    return rows


def nonnegative_least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """argmin ||matrix x - target|| with x >= 0, by the active-set method."""
    n = matrix.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    gram, slope = matrix.T @ matrix, matrix.T @ target
    tolerance = 1e-9 * max(1.0, float(np.abs(slope).max(initial=0)))
    for _ in range(3 * n):
        gradient = slope - gram @ x
        gradient[active] = -np.inf
        j = int(np.argmax(gradient))
        if gradient[j] <= tolerance:
            break
        active[j] = True
        while True:
            chosen = np.flatnonzero(active)
            best = np.linalg.lstsq(matrix[:, chosen], target, rcond=None)[0]
            if (best > 0).all():
                x[:] = 0
                x[chosen] = best
                break
            worse = best <= 0
            step = np.min(x[chosen][worse] / np.maximum(x[chosen][worse] - best[worse], 1e-300))
            x[chosen] += step * (best - x[chosen])
            active[chosen[worse & (x[chosen] <= 1e-9)]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def solve_repeats(histogram: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(combinations in use, whole repeat counts) that the histogram allows."""
    shapes = combinations(len(histogram), depth)
    scale = max(float(histogram.max(initial=0)), 1.0)
    wanted = nonnegative_least_squares(shapes.T.copy(), histogram / scale) * scale
    left, repeats = histogram.astype(np.int64).copy(), np.zeros(len(shapes), dtype=np.int64)
    for i in np.argsort(-wanted, kind="stable"):
        used = shapes[i] > 0
        count = min(int(np.floor(wanted[i] + 1e-6)), int((left[used] // shapes[i][used].astype(np.int64)).min()))
        if count > 0:
            repeats[i] = count
            left -= count * shapes[i].astype(np.int64)
    keep = repeats > 0
    return shapes[keep].astype(np.int64), repeats[keep]


class Plan:
    """Where the k-th piece of each class goes, from the class totals."""

    def __init__(self, full: int, histogram: np.ndarray, crumbs: int, window: int, unit: int,
                 depth: int):
        self.window, self.unit, self.full = window, unit, full
        shapes, repeats = solve_repeats(histogram, depth)
        first = full + np.concatenate([[0], np.cumsum(repeats)]).astype(np.int64)
        self.ranges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        used = np.zeros(len(histogram), dtype=np.int64)
        for c in range(len(histogram)):
            ends, sequences, offsets, total = [], [], [], 0
            for i, shape in enumerate(shapes):
                before = int((shape[:c] * np.arange(1, c + 1)).sum()) * unit
                for k in range(int(shape[c])):  # the k-th piece of this length in each copy
                    total += int(repeats[i])
                    ends.append(total)
                    sequences.append(int(first[i]))
                    offsets.append(before + k * (c + 1) * unit)
            used[c] = total
            self.ranges.append((np.array(ends, np.int64), np.array(sequences, np.int64),
                                np.array(offsets, np.int64)))
        self.used = used
        rest = (histogram - used) * np.arange(1, len(histogram) + 1) * unit
        self.stream_of_class = np.concatenate([[0], np.cumsum(rest)]).astype(np.int64)
        self.crumbs_from = int(self.stream_of_class[-1])
        self.stream_first = int(first[-1])
        length = self.crumbs_from + crumbs
        self.whole = length // window * window
        bits = [1 << b for b in range(window.bit_length() - 1, -1, -1) if (length - self.whole) >> b & 1]
        self.cuts = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64) + self.whole

    def remainder(self, c: int, k: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, length) of the k-th remainder of c + 1 units."""
        size = (c + 1) * self.unit
        if k < self.used[c]:
            ends, sequences, offsets = self.ranges[c]
            i = int(np.searchsorted(ends, k, side="right"))
            return [(int(sequences[i]) + k - (int(ends[i - 1]) if i else 0), int(offsets[i]), size)]
        return self.stream(int(self.stream_of_class[c]) + (k - int(self.used[c])) * size, size)

    def stream(self, at: int, size: int) -> list[tuple[int, int, int]]:
        """Pieces of a stretch of the greedy stream, cut where a sequence ends."""
        out = []
        while size > 0:
            if at < self.whole:
                number, offset, room = at // self.window, at % self.window, self.window - at % self.window
            else:
                i = int(np.searchsorted(self.cuts, at, side="right")) - 1
                number, offset = self.whole // self.window + i, at - int(self.cuts[i])
                room = int(self.cuts[i + 1]) - at
            length = min(size, room)
            out.append((self.stream_first + number, offset, length))
            at, size = at + length, size - length
        return out


# -- the tasks -----------------------------------------------------------------

ENCODED = ("doc_id long, part int, doc_tokens long, full_before long, class int, "
           "class_rank long, crumbs_before long, ids binary")


def _encoded(path: str, end_id: int, window: int, unit: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = block_encoder(path), TaskContext.get().partitionId()
        full, crumbs, ranks = 0, 0, np.zeros(window // unit + 1, dtype=np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in row_slices(offsets, BLOCK):
                values, n = tokens.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], end_id)
                ends = np.concatenate([[0], 4 * np.cumsum(n)]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(values)])
                whole, kind = n // window, n % window // unit
                rank = np.empty(len(n), dtype=np.int64)
                for i, c in enumerate(kind.tolist()):
                    rank[i] = ranks[c]
                    ranks[c] += 1
                loose = n % unit
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     pa.array(np.full(b - a, part, dtype=np.int32)), pa.array(n),
                     pa.array(full + np.cumsum(whole) - whole), pa.array(kind.astype(np.int32)),
                     pa.array(rank), pa.array(crumbs + np.cumsum(loose) - loose),
                     ids],
                    names=["doc_id", "part", "doc_tokens", "full_before", "class", "class_rank",
                           "crumbs_before", "ids"])
                full, crumbs = full + int(whole.sum()), crumbs + int(loose.sum())
    return encoded


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, `offset` long, ids binary")


def _placed(plan: Plan, with_ids: bool):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names
                       if name != "ids"}
            out: list[tuple] = []
            for i in range(len(batch)):
                raw = batch.column("ids")[i].as_buffer()
                n, kind = columns["doc_tokens"][i], columns["class"][i]
                whole, loose = n // plan.window, n % plan.unit
                first = columns["full_from"][i] + columns["full_before"][i]
                spots = [(first + w, 0, plan.window) for w in range(whole)]
                if kind:
                    spots += plan.remainder(kind - 1, columns["class_from"][i] + columns["class_rank"][i])
                if loose:
                    spots += plan.stream(plan.crumbs_from + columns["crumbs_from"][i]
                                         + columns["crumbs_before"][i], loose)
                start, view = 0, memoryview(raw)
                for sequence, offset, length in spots:
                    piece = view[4 * start: 4 * (start + length)]
                    out.append((columns["doc_id"][i], start, length, zlib.crc32(piece), n, sequence,
                                offset, piece.tobytes() if with_ids else None))
                    start += length
                if len(out) >= 20_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)
    return placed


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.binary() if name == "ids" else pa.int64())
         for name, column in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def pack(documents: DataFrame, tokenizer_path: str, window: int = WINDOW, unit: int = UNIT,
         depth: int = DEPTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pack the ids of all rows into sequences of at most ``window``.

    Returns one row per piece: doc_id, start (the document's ids before it),
    length, ids_crc32 (of its ids as little-endian unsigned 32-bit integers),
    doc_tokens, sequence_id, offset, ids (null without ``with_ids``).  Every id
    lies in exactly one piece; offsets are gapless from 0; every sequence is
    full or a power of two long.  A null text is empty and still has its end
    id; an empty table has no pieces; repeated rows are packed each.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    encoded = stored(rows.mapInArrow(_encoded(tokenizer_path, end_id, window, unit), ENCODED),
                     "packing-ids")
    counts = stored(encoded.groupBy("part", "class").agg(
        F.count(F.lit(1)).alias("pieces"),
        F.sum(F.floor(F.col("doc_tokens") / window)).cast("long").alias("full"),
        F.sum(F.col("doc_tokens") % unit).cast("long").alias("crumbs")), "packing-counts")
    totals = {r["class"]: r for r in counts.groupBy("class").agg(
        F.sum("pieces").alias("pieces"), F.sum("full").alias("full"),
        F.sum("crumbs").alias("crumbs")).collect()}  # one row per class: window / unit at most
    histogram = np.zeros(window // unit, dtype=np.int64)
    for kind, r in totals.items():
        if kind:
            histogram[kind - 1] = r["pieces"]
    plan = Plan(sum(r["full"] for r in totals.values()), histogram,
                sum(r["crumbs"] for r in totals.values()), window, unit, depth)
    of_class = counts.select("part", "class", F.coalesce(F.sum("pieces").over(
        Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("class_from"))
    of_part = counts.groupBy("part").agg(F.sum("full").alias("full"), F.sum("crumbs").alias("crumbs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_part = of_part.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_from")
                                       for c in ("full", "crumbs")])
    offsets = stored(of_class.join(of_part, "part"), "packing-offsets")
    if offsets.count() <= MAX_BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    placed = encoded.join(offsets, ["part", "class"])
    return placed.mapInArrow(_placed(plan, with_ids), PIECES)
