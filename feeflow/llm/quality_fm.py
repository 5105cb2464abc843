"""Quality classifier: a factorisation machine.

Features of a text: its hashed words (presence, scaled to unit length), its
structure (sizes, shares of capitals, digits, symbols and marks, repeated words
and lines) and its length column.  Every pair of features interacts through
``RANK`` factors; with the identity  sum_{i<j} <v_i, v_j> x_i x_j  =  1/2
sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)  a text is scored in time linear
in its features.

The machine is fitted on at most ``MAX_TRAINING_ROWS`` labelled texts that are
not held out, chosen by a hash of the id; their features (never their texts)
come to the driver.  The fitted arrays have a fixed size and are broadcast;
all texts are scored where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.bytehash import Rolling, mix, row_slices, text_buffer
from feeflow.llm.common import text_of
from feeflow.llm.quality_rules import _duplicate_lines, word_bounds

MAX_TRAINING_ROWS = 8_000
WORD_BITS = 14
RANK = 8
EPOCHS = 6
RATE = 0.1
PENALTY = 1e-4
BLOCK = 1 << 20
STATISTICS = ("log_words", "log_chars", "word_length", "capitals", "digits", "symbols", "bars",
              "marks", "line_length", "repeated_next", "distinct_words", "repeated_lines")


def _marked(text: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(text)] = True
    return table


_CAPITALS = _marked(bytes(range(65, 91)))
_DIGITS = _marked(b"0123456789")
_SYMBOLS = _marked(b"#*$%&<>@^~=+{}[]\\/_")
_BARS = _marked(b"|")
_MARKS = _marked(b"!?.,;:'\"()-")
_BREAKS = _marked(b"\n")


def features(data: np.ndarray, offsets: np.ndarray,
             n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row bounds, word buckets, statistics) of a block of texts; the buckets
    of a row are distinct."""
    n_rows = len(offsets) - 1
    starts, ends = word_bounds(data, offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    rolling = Rolling(data)
    word = mix(rolling.ranges(starts, ends) + (ends - starts).astype(np.uint64))
    size = 1 << WORD_BITS
    pairs = np.unique(rows * size + (word & np.uint64(size - 1)).astype(np.int64))
    bounds = np.searchsorted(pairs, np.arange(n_rows + 1) * size)
    n_words = np.bincount(rows, minlength=n_rows).astype(float)
    n_bytes = np.diff(offsets).astype(float)

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(n_bytes, 1)

    again = (word[1:] == word[:-1]) & (rows[1:] == rows[:-1])
    per_word = np.maximum(n_words, 1)
    lengths = np.bincount(rows, weights=(ends - starts), minlength=n_rows)
    lines = share(_BREAKS) * n_bytes + 1
    statistics = np.stack([
        np.log1p(n_words), np.log1p(n_chars), lengths / per_word, share(_CAPITALS), share(_DIGITS),
        share(_SYMBOLS), share(_BARS), share(_MARKS), np.log1p(n_words / lines),
        np.bincount(rows[1:][again], minlength=n_rows) / per_word, np.diff(bounds) / per_word,
        _duplicate_lines(data, offsets, rolling) / lines], axis=1)
    return bounds, pairs % size, statistics


@dataclass
class Machine:
    """A fitted machine: bias, weights and factors of all features (words
    first, then statistics), and the statistics' scaling."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scaled(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip((statistics - self.mean) / self.scale, -4, 4)

    def parts(self, bounds: np.ndarray, words: np.ndarray, dense: np.ndarray):
        """Score before the logistic, with the sums its gradient needs."""
        counts = np.diff(bounds)
        rows = np.repeat(np.arange(len(counts)), counts)
        x = 1 / np.sqrt(np.maximum(counts, 1))
        wide = self.weight[words]
        deep = self.factor[words]
        n = len(counts)
        first = len(self.weight) - dense.shape[1]
        linear = np.bincount(rows, weights=wide, minlength=n) * x + dense @ self.weight[first:]
        sums = np.stack([np.bincount(rows, weights=deep[:, f], minlength=n)
                         for f in range(deep.shape[1])], axis=1) * x[:, None] + dense @ self.factor[first:]
        squares = np.bincount(rows, weights=(deep ** 2).sum(axis=1), minlength=n) * x ** 2 \
            + dense ** 2 @ (self.factor[first:] ** 2).sum(axis=1)
        raw = self.bias + linear + 0.5 * ((sums ** 2).sum(axis=1) - squares)
        return raw, sums, rows, x, deep

    def score(self, bounds: np.ndarray, words: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        raw = self.parts(bounds, words, self.scaled(statistics))[0]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(bounds: np.ndarray, words: np.ndarray, statistics: np.ndarray, labels: np.ndarray,
        rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss by mini-batches with per-coordinate (Adagrad) steps."""
    random = np.random.default_rng(seed)
    size, n = (1 << WORD_BITS) + statistics.shape[1], len(labels)
    mean = statistics.mean(axis=0) if n else np.zeros(statistics.shape[1])
    spread = statistics.std(axis=0) if n else np.ones(statistics.shape[1])
    machine = Machine(0.0, np.zeros(size), random.normal(0, 0.05, (size, rank)), mean,
                      np.where(spread > 1e-9, spread, 1.0))
    if not n:
        return machine
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    machine.bias = float(np.log(share / (1 - share)))
    seen_weight, seen_factor, seen_bias = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    dense_all, first = machine.scaled(statistics), size - statistics.shape[1]
    counts = np.diff(bounds)
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(n), max(1, n // 128)):
            own = np.concatenate([[0], np.cumsum(counts[batch])])
            at = np.repeat(bounds[batch] - own[:-1], counts[batch]) + np.arange(own[-1])
            used, dense = words[at], dense_all[batch]
            raw, sums, rows, x, deep = machine.parts(own, used, dense)
            step = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
            grad_weight = np.bincount(used, weights=(step * x)[rows], minlength=size)
            grad_weight[first:] += dense.T @ step
            pull = (step * x)[rows][:, None] * (sums[rows] - deep * x[rows][:, None])
            grad_factor = np.stack([np.bincount(used, weights=pull[:, f], minlength=size)
                                    for f in range(rank)], axis=1)
            factor = machine.factor[first:]
            grad_factor[first:] += (dense * step[:, None]).T @ sums \
                - ((dense ** 2) * step[:, None]).sum(axis=0)[:, None] * factor
            touched = grad_weight != 0
            grad_weight[touched] += PENALTY * machine.weight[touched]
            grad_factor[touched] += PENALTY * machine.factor[touched]
            seen_weight += grad_weight ** 2
            seen_factor += grad_factor ** 2
            machine.weight -= RATE * grad_weight / np.sqrt(seen_weight)
            machine.factor -= RATE * grad_factor / np.sqrt(seen_factor)
            slope = float(step.sum())
            seen_bias += slope ** 2
            machine.bias -= RATE * slope / np.sqrt(seen_bias)
    return machine


def held_out(id_column: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _lengths(batch: pa.RecordBatch) -> np.ndarray:
    return np.maximum(batch.column("n_chars").fill_null(0).to_numpy(zero_copy_only=False), 0).astype(float)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for a, b in row_slices(offsets, BLOCK):
            bounds, words, statistics = features(
                data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], _lengths(batch)[a:b])
            width = statistics.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(a, b - a),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(words.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * width, width, dtype=np.int32)),
                                          pa.array(statistics.reshape(-1)))],
                names=["label", "words", "statistics"])


def _scored(shared):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in row_slices(offsets, BLOCK):
                found = features(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a],
                                 _lengths(batch)[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                     pa.array(machine.score(*found))], names=["doc_id", "held_out", "score"])
    return scored


def _inputs(documents: DataFrame) -> list[Column]:
    length = F.col("n_chars").cast("long") if "n_chars" in documents.columns else F.lit(None)
    return [F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
            F.coalesce(length, F.length(text_of()).cast("long")).alias("n_chars")]


def train(documents: DataFrame, labels: DataFrame, label: str = "quality",
          max_rows: int = MAX_TRAINING_ROWS) -> Machine:
    """Fit on at most ``max_rows`` labelled rows that are not held out.

    The sample is the rows with the least hash of the id, the same at every
    run.  A repeated label counts by its largest value, null labels and ids not
    at all; of documents with one id, the one whose text has the least hash is
    used.  Without rows the machine scores every text 0.5.
    """
    sample = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("double").alias("label")) \
        .orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(max_rows)
    rows = documents.select(*_inputs(documents)).join(F.broadcast(sample), F.col("doc_id") == F.col("id")) \
        .groupBy("id").agg(F.min_by(F.struct("label", "text", "n_chars"), F.struct(F.xxhash64("text"), "text")).alias("r")) \
        .select("r.*").orderBy(F.xxhash64(F.lit(3), "text"), "text")
    table = rows.select("label", "text", "n_chars").mapInArrow(
        _described, "label double, words array<int>, statistics array<double>").toArrow()
    y = table.column("label").to_numpy()
    words = table.column("words").combine_chunks()
    statistics = table.column("statistics").combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(words).to_numpy())]) \
        if len(y) else np.zeros(1, np.int64)
    return fit(bounds.astype(np.int64), words.flatten().to_numpy().astype(np.int64),
               statistics.flatten().to_numpy().reshape(len(y), len(STATISTICS)), y)


def score(documents: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; null and empty
    texts are scored by their (zero) features."""
    shared = documents.sparkSession.sparkContext.broadcast(machine)
    rows = documents.select(*_inputs(documents), held_out().alias("held_out"))
    return rows.mapInArrow(_scored(shared), "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
