"""Language identification of words by a linear-chain conditional random field.

A text is a chain of words (runs of letters); each word's label is a language.
A word's features are its affixes (the first and last two to four bytes), its
byte trigrams and its entry in a lexicon of words typical of a language; a
learned matrix of transitions joins neighbours.  Forward-backward gives every
word its posterior, so code-switched text gets a language per word
(``language_spans``); a document's language is the one with the largest
posterior mass (``detect``).

Learning: at most ``MAX_TRAINING_ROWS`` labelled rows (those with the least
hash) of ids that are not held out.  They have one label each, which would teach
that languages never change; so their texts are cut into segments and these
are spliced at random into chains, which is what code-switched text looks like.
The rows lie in ``PARTS`` groups: each task moves the shared parameters over
its own chains with Adagrad steps along the exact gradient, the driver averages
the parameters that moved (fixed-size arrays), for ``ROUNDS`` rounds.

Scoring reads each text where it lies; nothing is shuffled.  Long chains are cut
into pieces whose transfer matrices are multiplied first, so the number of
sequential steps grows with the root of the longest text.

Results for odd input: a null text, or one without a letter, is ``und`` with
score 0, as is every text if there is no labelled row; so are empty texts.
Equal masses go to the alphabetically first language.  Repeated rows are learned
from once, scored each.  Null languages are not learned from, null ids are not
held out; an empty table gives no rows; other columns are not read.  Long texts
count whole, in memory in proportion to the longest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.llm.bytehash import Rolling, mix, row_slices, text_buffer
from feeflow.llm.common import stored, text_of
from feeflow.llm.piece_ids import led_by_blank

MAX_TRAINING_ROWS = 2_000
PARTS = 8
ROUNDS = 3
EPOCHS = 2               # of each part in each round
RATE = 0.3
PENALTY = 1e-5
CHAIN = 64               # words of a training chain
SEGMENT = 20             # mean words of a spliced segment
BATCH_CHAINS = 64
FEATURE_BITS = 16
MAX_LEXICON = 50_000
LEXICON_COUNT = 5        # a lexicon word is in so many sampled texts at least
LEXICON_SHARE = 0.8      # and so many of them have its language
BLOCK = 1 << 19
LEAST = -30.0            # log potentials below the best one are not told apart further down

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_AFFIX = (2, 3, 4)
_SCATTER = np.uint64(0x9E3779B97F4A7C15)


# -- features ------------------------------------------------------------------------------

@dataclass
class Words:
    """The words of a block of texts: their rows, features and names."""

    row: np.ndarray       # text of each word
    length: np.ndarray    # bytes of each word
    affix: np.ndarray     # [2 * len(_AFFIX), words] buckets
    gram: np.ndarray      # buckets of all words' trigrams, one per byte
    name: np.ndarray      # 64-bit names

    def __len__(self) -> int:
        return len(self.row)

    def take(self, order: np.ndarray) -> "Words":
        first = np.cumsum(self.length) - self.length
        length = self.length[order]
        before = np.cumsum(length) - length
        grams = np.repeat(first[order] - before, length) + np.arange(int(length.sum()))
        return Words(self.row[order], length, self.affix[:, order], self.gram[grams], self.name[order])


def _bucket(kind: int, value: np.ndarray) -> np.ndarray:
    mixed = (value.astype(np.uint64) * np.uint64(16) + np.uint64(kind)) * _SCATTER
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    data, offsets = led_by_blank(data, offsets)
    inside = _LETTER[data]
    lower = _LOWER[data]
    # capitals of the Latin-1 block: 0xC3 0x80..0x9E but the multiplication sign
    latin = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    lower[latin] += 0x20
    text = np.full(len(data) + 8, 0x20, dtype=np.uint8)   # four blanks at either end
    text[4:-4] = np.where(inside, lower, np.uint8(0x20))
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    length = ends - starts
    affix = []
    for place, step in ((starts + 4, 1), (ends + 3, -1)):
        value = np.zeros(len(starts), dtype=np.uint64)
        for i in range(max(_AFFIX)):
            byte = np.where(i < length, text[place + step * i], np.uint8(0x20))
            value |= byte.astype(np.uint64) << np.uint64(8 * i)
            if i + 1 in _AFFIX:
                affix.append(_bucket(i + (8 if step < 0 else 0), value))
    at = np.flatnonzero(inside) + 4
    wide = text.astype(np.uint32)
    gram = _bucket(7, (wide[at - 1] << 16) | (wide[at] << 8) | wide[at + 1])
    name = mix(Rolling(text).ranges(starts + 4, ends + 4) + length.astype(np.uint64))
    return Words(np.searchsorted(offsets, starts, side="right") - 1, length, np.stack(affix), gram, name)


# -- the model -------------------------------------------------------------------------------

@dataclass
class Field:
    """A fitted random field."""

    languages: list[str]
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))   # names, ascending
    entry: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))      # their languages
    weight: np.ndarray | None = None        # [languages, buckets]
    listed: np.ndarray | None = None        # [lexicon language (last: none), language]
    transition: np.ndarray | None = None    # [from, to]

    def __post_init__(self):
        k = len(self.languages)
        if self.weight is None:
            self.weight = np.zeros((k, 1 << FEATURE_BITS), dtype=np.float32)
            self.listed = np.zeros((k + 1, k))
            self.transition = np.zeros((k, k))

    def entries(self, words: Words) -> np.ndarray:
        """Lexicon language of each word; the number of languages if it has none."""
        none = len(self.languages)
        if not len(self.lexicon):
            return np.full(len(words), none)
        place = np.minimum(np.searchsorted(self.lexicon, words.name), len(self.lexicon) - 1)
        return np.where(self.lexicon[place] == words.name, self.entry[place], none)

    def scores(self, words: Words) -> np.ndarray:
        """Log potential of every word and language."""
        out = self.listed[self.entries(words)]
        if not len(words):
            return out
        first = np.cumsum(words.length) - words.length
        scale = 1 / np.sqrt(words.length)
        for k, weight in enumerate(self.weight):
            out[:, k] += np.add.reduceat(weight[words.gram], first) * scale
            for affix in words.affix:
                out[:, k] += weight[affix]
        return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def forward_backward(scores: np.ndarray, transition: np.ndarray,
                     bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior, forward, emission * backward) of every word; rows of the
    last two are known up to a factor.  ``bounds`` cut the words into chains."""
    n, k = scores.shape
    bounds = np.unique(bounds)
    if n == 0:
        return scores, scores, scores
    emission = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), LEAST))
    step = np.exp(np.maximum(transition - transition.max(), LEAST))
    lengths = np.diff(bounds)
    width = max(CHAIN, math.isqrt(int(lengths.max())))
    pieces = -(-lengths // width)
    ordinal = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(bounds[:-1], pieces) + ordinal * width
    size = np.minimum(width, np.repeat(bounds[1:], pieces) - first)
    columns = np.arange(width)
    there = columns < size[:, None]
    local = np.ones((len(first), width, k))
    local[there] = emission
    head = ordinal == 0

    def moved(x: np.ndarray, t: int) -> np.ndarray:
        """One word on: transition (none before a chain's first word), emission."""
        y = x @ step
        if t == 0:
            y[head] = x[head]
        y *= local[:, t] if x.ndim == 2 else local[:, t, None, :]
        y[~there[:, t]] = x[~there[:, t]]
        return y

    before, after = np.ones((len(first), k)), np.ones((len(first), k))
    if pieces.max() > 1:
        transfer = np.broadcast_to(np.eye(k), (len(first), k, k)).copy()
        for t in range(width):
            transfer = moved(transfer, t)
            transfer /= transfer.max(axis=(1, 2), keepdims=True)
        for j in range(1, int(pieces.max())):
            here = np.flatnonzero(ordinal == j)
            before[here] = _scaled(np.einsum("qi,qij->qj", before[here - 1], transfer[here - 1]))
        last = np.cumsum(pieces) - 1
        for j in range(1, int(pieces.max())):   # from each chain's end
            here = (last - j)[pieces > j]
            after[here] = _scaled(np.einsum("qij,qj->qi", transfer[here + 1], after[here + 1]))
    forward, backward = np.empty_like(local), np.empty_like(local)
    x = before
    for t in range(width):
        x = _scaled(moved(x, t))
        forward[:, t] = x
    x = after
    for t in range(width - 1, -1, -1):
        backward[:, t] = x
        y = _scaled((x * local[:, t]) @ step.T)
        x = np.where(there[:, t, None], y, x)
    forward, backward = forward[there], backward[there]
    return _scaled(forward * backward), forward, emission * backward


def gradient(model: Field, words: Words, labels: np.ndarray, bounds: np.ndarray):
    """Gradient of the chains' log-likelihood: (weight, listed, transition)."""
    k = len(model.languages)
    posterior, forward, onward = forward_backward(model.scores(words), model.transition, bounds)
    pull = -posterior
    pull[np.arange(len(labels)), labels] += 1
    entries, scale = model.entries(words), 1 / np.sqrt(words.length)
    used = np.concatenate([words.affix.reshape(-1), words.gram])
    weight, listed = np.empty_like(model.weight), np.empty_like(model.listed)
    for c in range(k):
        own = pull[:, c]
        weight[c] = np.bincount(used, minlength=weight.shape[1], weights=np.concatenate(
            [np.tile(own, len(words.affix)), np.repeat(own * scale, words.length)]))
        listed[:, c] = np.bincount(entries, weights=own, minlength=k + 1)
    inner = np.ones(len(labels), dtype=bool)
    inner[bounds[:-1][np.diff(bounds) > 0]] = False
    here = np.flatnonzero(inner)
    step = np.exp(np.maximum(model.transition - model.transition.max(), LEAST))
    left, right = forward[here - 1], onward[here]
    total = np.einsum("ni,ij,nj->n", left, step, right)
    transition = np.zeros((k, k))
    np.add.at(transition, (labels[here - 1], labels[here]), 1)
    return weight, listed, transition - step * ((left / total[:, None]).T @ right)


# -- learning ----------------------------------------------------------------------------------

def spliced(words: Words, labels: np.ndarray, rnd: np.random.Generator) -> tuple[Words, np.ndarray]:
    """The words of labelled texts as segments in random order."""
    n = len(words)
    cuts = rnd.random(n) < 1 / SEGMENT
    cuts[np.flatnonzero(np.diff(words.row, prepend=-1))] = True
    first = np.flatnonzero(cuts)
    size = np.diff(np.append(first, n))
    order = rnd.permutation(len(first))
    first, size = first[order], size[order]
    before = np.cumsum(size) - size
    at = np.repeat(first - before, size) + np.arange(n)
    return words.take(at), labels[words.row[at]]


def improve(model: Field, blocks: list[tuple[Words, np.ndarray]], epochs: int, rate: float,
            seed: int) -> None:
    """Adagrad steps of ``model`` along the gradient over mini-batches of chains."""
    rnd = np.random.default_rng(seed)
    parts = model.weight, model.listed, model.transition
    seen = [np.full(p.shape, 1e-2) for p in parts]
    for _ in range(epochs):
        for words, labels in blocks:
            chained, label = spliced(words, labels, rnd)
            for a in range(0, len(chained), CHAIN * BATCH_CHAINS):
                batch = np.arange(a, min(a + CHAIN * BATCH_CHAINS, len(chained)))
                bounds = np.append(np.arange(0, len(batch), CHAIN), len(batch))
                slopes = gradient(model, chained.take(batch), label[batch], bounds)
                for part, total, slope in zip(parts, seen, slopes, strict=True):
                    slope = slope / len(batch) - PENALTY * part
                    total += slope ** 2
                    part += (rate * slope / np.sqrt(total)).astype(part.dtype)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(documents: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Stored (key, part, lang, text): the ``max_rows`` labelled texts with the
    least hash, whole."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.xxhash64(F.col("doc_id").cast("string"), "text", "lang").alias("key"), "lang", text_of().alias("text"))
    least = rows.select("key").distinct().orderBy("key").limit(max_rows).agg(F.max("key")).first()[0]
    chosen = rows.where(F.col("key") <= F.lit(least)) if least is not None else rows.limit(0)
    return stored(chosen.dropDuplicates(["key"]).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(PARTS)).cast("int")), "crf-sample")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for a, b in row_slices(offsets, BLOCK):
            words = words_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
            pairs = np.unique(np.stack([words.row.astype(np.uint64), words.name]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(a, b - a).take(pa.array(pairs[0].astype(np.int64))),
                 pa.array(pairs[1].view(np.int64))], names=["lang", "name"])


def _lexicon(sample: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words typical of one language, ascending, and that language."""
    counts = sample.select("lang", "text").mapInArrow(_named, "lang string, name long").groupBy(
        "name", "lang").agg(F.count(F.lit(1)).alias("n"))
    total, most = F.sum("n"), F.max(F.struct("n", "lang"))
    found = counts.groupBy("name").agg(total.alias("n"), most.alias("most")).where(
        (F.col("n") >= LEXICON_COUNT) & (F.col("most.n") >= F.col("n") * LEXICON_SHARE)).orderBy(
        F.col("n").desc(), "name").limit(MAX_LEXICON).select("name", F.col("most.lang").alias("lang")).toArrow()
    name = found["name"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(name)
    number = {lang: i for i, lang in enumerate(languages)}
    entry = np.array([number[x] for x in found["lang"].to_pylist()], dtype=np.int64)
    return name[order], entry[order]


MOVED = "weight binary, listed binary, transition binary"


def _improved(shared, epochs: int, rate: float, seed: int):
    def improved(group: pa.Table) -> pa.Table:
        model: Field = shared.value
        model = Field(model.languages, model.lexicon, model.entry, model.weight.copy(), model.listed.copy(),
                      model.transition.copy())
        group = group.sort_by("key")
        number = {lang: i for i, lang in enumerate(model.languages)}
        labels = np.array([number[x] for x in group["lang"].to_pylist()])
        data, offsets = text_buffer(group["text"])
        blocks = []
        for a, b in row_slices(offsets, BLOCK):
            words = words_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
            if len(words):
                blocks.append((words, labels[a:b]))
        improve(model, blocks, epochs, rate, seed)
        return pa.table({name: pa.array([getattr(model, name).tobytes()], pa.binary())
                         for name in ("weight", "listed", "transition")})
    return improved


def train(documents: DataFrame, max_rows: int = MAX_TRAINING_ROWS, rounds: int = ROUNDS) -> Field:
    """Fit on a sample of the labelled rows that are not held out."""
    spark = documents.sparkSession
    sample = training_rows(documents, max_rows)
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())   # of max_rows rows
    if not languages:
        return Field([])
    model = Field(languages, *_lexicon(sample, languages))
    for i in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        moved = sample.groupBy("part").applyInArrow(_improved(shared, EPOCHS, RATE, i), MOVED).collect()
        for name in ("weight", "listed", "transition"):
            old = getattr(model, name)
            new = np.stack([np.frombuffer(r[name], dtype=old.dtype).reshape(old.shape) for r in moved])
            touched = (np.abs(new - old) > 1e-6).sum(axis=0)   # what a part has not seen does not vote
            setattr(model, name, old + ((new - old).sum(axis=0) / np.maximum(touched, 1)).astype(old.dtype))
        shared.unpersist()
    return model


# -- labelling -----------------------------------------------------------------------------------

def posteriors(model: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of a block of texts and their posteriors."""
    words = words_of(data, offsets)
    bounds = np.searchsorted(words.row, np.arange(len(offsets)))
    return words, forward_backward(model.scores(words), model.transition, bounds)[0]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffer(batch.column("text"))
    for a, b in row_slices(offsets, BLOCK):
        yield a, b, data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]


def _detected(shared):
    def detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = shared.value
        names = pa.array([*model.languages, "und"])
        for batch in batches:
            for a, b, data, offsets in _blocks(batch):
                words, each = posteriors(model, data, offsets)
                n = np.bincount(words.row, minlength=b - a)
                mass = np.stack([np.bincount(words.row, weights=each[:, k], minlength=b - a)
                                 for k in range(len(model.languages))], axis=1)
                lettered = batch.column("lettered").slice(a, b - a).to_numpy(zero_copy_only=False) & (n > 0)
                best = np.where(lettered, mass.argmax(axis=1), len(model.languages))
                score = np.where(lettered, mass.max(axis=1) / np.maximum(n, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                     names.take(pa.array(best)), pa.array(np.clip(score, 0, 1))],
                    names=["doc_id", "held_out", "lang_pred", "score"])
    return detected


def _spanned(shared):
    def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = shared.value
        names = pa.array(model.languages)
        for batch in batches:
            for a, b, data, offsets in _blocks(batch):
                words, each = posteriors(model, data, offsets)
                best = each.argmax(axis=1)
                new = np.append(True, (best[1:] != best[:-1]) | (words.row[1:] != words.row[:-1]))[:len(words)]
                first = np.flatnonzero(new)
                size = np.diff(np.append(first, len(words)))
                in_row = first - np.searchsorted(words.row, words.row[first])
                sure = np.add.reduceat(each.max(axis=1), first) / size if len(first) else np.zeros(0)
                spans = pa.StructArray.from_arrays(
                    [pa.array(in_row), pa.array(size), names.take(pa.array(best[first])), pa.array(sure)],
                    names=["first_word", "n_words", "lang", "posterior"])
                bounds = np.searchsorted(words.row[first], np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(bounds), spans)],
                    names=["doc_id", "spans"])
    return spanned


def detect(documents: DataFrame, model: Field) -> DataFrame:
    """doc_id, held_out, lang_pred and score (mean posterior) of every row."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
        held_out().alias("held_out"), text_of().rlike(r"\p{L}").alias("lettered"))
    if not model.languages:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_detected(shared), "doc_id long, held_out boolean, lang_pred string, score double")


SPANS = "doc_id long, spans array<struct<first_word: long, n_words: long, lang: string, posterior: double>>"


def language_spans(documents: DataFrame, model: Field) -> DataFrame:
    """doc_id and its runs of words of one language, in order; a text without
    letters has none."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    if not model.languages:
        empty = F.from_json(F.lit("[]"), SPANS.split(" ", 3)[3])
        return rows.select("doc_id", empty.alias("spans"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_spanned(shared), SPANS)


def identify(documents: DataFrame) -> DataFrame:
    """Fit on the table's own labelled rows and label all rows."""
    return detect(documents, train(documents))
