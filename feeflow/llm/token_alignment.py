"""Cross-tokenizer alignment.

Each text is encoded by a byte-level BPE (side A, of blank + text) and by a
SentencePiece model (side B, which adds the blank itself).  Both sides' tokens
then cover the same bytes, and the two segmentations are aligned batch by
batch with ``pandas.merge_asof``: every token start of one side finds the token
of the other side that covers it, and the union of both directions is the set
of overlapping pairs.  The key is the token's place in the batch, where
documents follow each other, so it holds the document; as both sides begin a
document at its first byte, no token can find one of another document.
Overlapping pairs with equal ends are the links; their ends cut both sides into
groups.

Spark does the rest: link counts per (A id, B id) are summed inside a batch,
then over the corpus, and each document takes the counts of its own links.  The
most frequent pairs, ``MOST_BROADCAST_PAIRS`` at most, are looked up in a
broadcast; links of all other pairs, if there are any, get theirs from a join.

Results for odd input: a null or empty text, or one whose bytes a side does not
give back (U+2581, text that a tokenizer normalises), has no tokens: zeros and
an empty ``groups_sha256``.  Repeated rows and null ids are rows of their own;
other columns are not read.  A long text is encoded and aligned whole, in
memory in proportion to it.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.bytehash import row_slices, text_buffer
from feeflow.llm.common import stored, text_of
from feeflow.llm.piece_ids import PieceIds, cut, led_by_blank, piece_names
from feeflow.llm.tokens import Encoder

BLOCK = 1 << 19                    # bytes of text aligned at once, one text at least
MOST_BROADCAST_PAIRS = 2_000_000   # 13 bytes each
B_BITS = 16                        # a pair is one number: A id, then B id in so many bits


class PlainEncoder(Encoder):
    """Byte-level ids; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []

    def token_bytes(self) -> list[bytes]:
        byte = {c: b for b, c in self.alphabet.items()}
        size = self.tokenizer.get_vocab_size()
        found = [b""] * size
        for text, i in self.tokenizer.get_vocab().items():
            found[i] = bytes(byte[c] for c in text) if all(c in byte for c in text) else text.encode()
        return found


class PieceEncoder:
    """SentencePiece ids of pieces of a text that begins with a blank.

    A piece that begins with a blank is given without it, as the model adds
    one; any other piece stands after a line break, which no piece of the
    vocabulary holds, and is encoded behind one."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any("\n" in t or "▁" in t.lstrip("▁") for t in texts)
        self.lead = self.model.encode("\n")

    def ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode("utf-8", "replace") for p in pieces]
        found = self.model.encode([t[1:] if t[:1] == " " else "\n" + t for t in texts], num_threads=1)
        skip = len(self.lead)
        found = [ids if t[:1] == " " else ids[skip:] for ids, t in zip(found, texts, strict=True)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(count.sum())), count

    def token_bytes(self) -> list[bytes]:
        model = self.model
        found = []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                found.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                found.append(b"")
            else:
                found.append(text.replace("▁", " ").encode())
        return found


class Side:
    """One tokenizer: ids of texts and the bytes of each id."""

    def __init__(self, tokens: PlainEncoder | PieceEncoder):
        self.cuts = tokens.cuts
        self.pieces = PieceIds(tokens.ids)
        texts = tokens.token_bytes()
        if len(texts) > 1 << B_BITS:
            raise ValueError(f"a tokenizer of {len(texts)} ids: pairs hold {B_BITS} bits a side")
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def encode(self, raw: bytes, names, starts, ends):
        return self.pieces.lookup(raw, names, starts, ends)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, joined."""
        length = self.length[ids]
        before = np.cumsum(length) - length
        return self.bytes[np.repeat(self.first[ids] - before, length) + np.arange(int(length.sum()))]


_SIDES: dict[tuple[str, str], tuple[Side, Side]] = {}


def sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    """Both tokenizers, once per worker process."""
    if (a_path, b_path) not in _SIDES:
        _SIDES.clear()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _SIDES[a_path, b_path] = Side(PlainEncoder(a_path)), Side(PieceEncoder(b_path))
    return _SIDES[a_path, b_path]


def tokenised(data: np.ndarray, offsets: np.ndarray, both: tuple[Side, Side]):
    """Ids of both sides of a block of texts, and ids per text; a text that a
    side does not give back byte for byte has none."""
    n = len(offsets) - 1
    full = np.diff(offsets) > 0
    data, offsets = led_by_blank(data, offsets)
    if all(s.cuts for s in both):
        starts, ends = cut(data, offsets)
    else:
        starts, ends = offsets[:-1], offsets[1:]
    row = np.searchsorted(offsets, starts, side="right") - 1
    keep = full[row]
    starts, ends, row = starts[keep], ends[keep], row[keep]
    raw, names = data.tobytes(), piece_names(data, starts, ends)
    found = []
    for side in both:
        ids, per_piece = side.encode(raw, names, starts, ends)
        found.append((ids, np.bincount(row, weights=per_piece, minlength=n).astype(np.int64)))
    wanted = data[np.repeat(full, np.diff(offsets))]
    whole = full.copy()
    for side, (ids, count) in zip(both, found, strict=True):
        spelled = side.spelled(ids)
        if len(spelled) == len(wanted) and np.array_equal(spelled, wanted):
            continue
        at = np.concatenate([[0], np.cumsum(side.length[ids])])
        bounds = at[np.concatenate([[0], np.cumsum(count)])]
        for i in np.flatnonzero(full):
            whole[i] &= np.array_equal(spelled[bounds[i]:bounds[i + 1]], data[offsets[i]:offsets[i + 1]])
    if not whole.all():
        found = [(ids[np.repeat(whole, count)], np.where(whole, count, 0)) for ids, count in found]
    return found


def align(length_a: np.ndarray, length_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping token pairs (a, b) of two segmentations of the same bytes,
    in order, and which of them end together."""
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    a = pd.DataFrame({"start": end_a - length_a, "a": np.arange(len(end_a))})
    b = pd.DataFrame({"start": end_b - length_b, "b": np.arange(len(end_b))})
    of_a = pd.merge_asof(a, b, on="start")    # a's start and the b that covers it
    of_b = pd.merge_asof(b, a, on="start")
    i, j, cover = (x.to_numpy(np.int64) for x in (of_a["a"], of_a["b"], of_b["a"]))
    # starts that both sides share give the same pair in both directions
    only = (end_a - length_a)[cover] != of_b["start"].to_numpy()
    i = np.concatenate([i, cover[only]])
    j = np.concatenate([j, of_b["b"].to_numpy()[only]])
    order = np.argsort(i + j, kind="stable")   # i + j grows along the text
    i, j = i[order], j[order]
    return i, j, end_a[i] == end_b[j]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal text of 0..size-1 in a table of bytes, one free byte after it,
    and the lengths."""
    texts = [str(i).encode() for i in range(size)]
    width = len(texts[-1]) + 1
    table = np.frombuffer(b"".join(t.ljust(width) for t in texts), dtype=np.uint8).reshape(size, width)
    return table, np.array([len(t) for t in texts])


_DECIMAL: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_COMMA, _BAR, _SEMICOLON = b",|;"


def written(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray,
            last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of ``a1,a2|b1;a3|b2,b3;`` over all groups, the end of each
    group's text in it).  ``last_a`` and ``last_b`` are the groups' last tokens."""
    size = int(max(ids_a.max(initial=0), ids_b.max(initial=0))) + 1
    size = 1 << max(size - 1, 1).bit_length()
    if size not in _DECIMAL:
        _DECIMAL[size] = _digits(size)
    table, digits = _DECIMAL[size]
    n = len(ids_a) + len(ids_b)
    # a group's A tokens, then its B tokens: each side moves on by what the other has put before
    group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
    group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
    before_b = np.concatenate([[0], last_b + 1])
    at_a = np.arange(len(ids_a)) + before_b[group_a]
    at_b = np.arange(len(ids_b)) + last_a[group_b] + 1
    ids, mark = np.empty(n, np.int64), np.full(n, _COMMA, np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    mark[at_a[last_a]], mark[at_b[last_b]] = _BAR, _SEMICOLON
    length = digits[ids]
    cells = table[ids]
    cells[np.arange(n), length] = mark
    flat = cells[np.arange(table.shape[1]) <= length[:, None]]
    ends = np.cumsum(length + 1)
    return flat, ends[at_b[last_b]] if n else np.zeros(0, np.int64)


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, "
           "groups_sha256 string, row long, pairs array<int>")


def _aligned(a_path: str, b_path: str):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(a_path, b_path)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in row_slices(offsets, BLOCK):
                n = last - first
                (ids_a, count_a), (ids_b, count_b) = tokenised(
                    data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first], both)
                a, b, together = align(both[0].length[ids_a], both[1].length[ids_b])
                last_a, last_b = a[together], b[together]
                doc_a = np.repeat(np.arange(n), count_a)
                groups = np.bincount(doc_a[last_a], minlength=n)
                overlaps = np.bincount(doc_a[a], minlength=n)
                text, ends = written(ids_a, ids_b, last_a, last_b)
                group_bounds = np.concatenate([[0], np.cumsum(groups)])
                byte_bounds = np.concatenate([[0], ends])[group_bounds]
                view = memoryview(np.ascontiguousarray(text))
                shas = [hashlib.sha256(view[x: y - 1]).hexdigest() if y > x else ""
                        for x, y in zip(byte_bounds[:-1].tolist(), byte_bounds[1:].tolist(), strict=True)]
                pairs = (ids_a[last_a].astype(np.int64) << B_BITS | ids_b[last_b]).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(count_a), pa.array(count_b),
                     pa.array(groups.astype(np.int64)), pa.array(groups.astype(np.int64)),
                     pa.array(overlaps.astype(np.int64)), pa.array(shas, pa.string()),
                     batch.column("row").slice(first, n),
                     pa.ListArray.from_arrays(pa.array(group_bounds.astype(np.int32)), pa.array(pairs))],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256",
                           "row", "pairs"])
    return aligned


def aligned_documents(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One stored row per document: token, group, link and overlap numbers, the
    digest of its groups, and the linked id pairs in order (``pairs``)."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                            F.monotonically_increasing_id().alias("row"))
    return stored(rows.mapInArrow(_aligned(a_path, b_path), ALIGNED), "aligned")


LINKS_AT_ONCE = 1 << 19


def _pair_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, pairs, row bounds) of some rows at a time."""
    column = batch.column("pairs")
    bounds = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    for a, b in row_slices(bounds, LINKS_AT_ONCE):
        yield a, b, values[bounds[a]: bounds[b]], bounds[a: b + 1] - bounds[a]


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links per pair, summed over some rows before they leave."""
    for batch in batches:
        for _, _, values, _ in _pair_blocks(batch):
            pair, n = np.unique(values, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n, best): how often an id pair is linked in the
    corpus, and whether no other pair of its B id is linked more often."""
    counts = aligned.select("pairs").mapInArrow(_tallied, "pair int, n long").groupBy("pair").agg(
        F.sum("n").alias("n"))
    wide = F.col("pair").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    counts = stored(counts.select("pair", F.shiftright(wide, B_BITS).cast("int").alias("a_id"),
                                  wide.bitwiseAND(F.lit((1 << B_BITS) - 1)).cast("int").alias("b_id"), "n"),
                    "link-counts")
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return stored(counts.join(most, "b_id").select(
        "pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best")), "link-best")


def _least_broadcast_count(counts: DataFrame, most: int) -> tuple[int, bool]:
    """The least power of two so that at most ``most`` pairs have that count or
    more, and whether that is all pairs."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).agg(
        F.count(F.lit(1)).alias("pairs")).collect()   # at most 64 rows
    total, least = 0, 63
    by_level = {r.level: r.pairs for r in sizes}
    for level in range(62, -1, -1):
        total += by_level.get(level, 0)
        if total > most:
            break
        least = level
    return 1 << least, sum(by_level.values()) <= most


SCORED = ", ".join([*ALIGNED.split(", ")[:-1], "n_best long", "count_sum long", "rest array<int>"])


def _looked_up(shared):
    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            names = [c for c in batch.schema.names if c != "pairs"]
            for a, b, values, bounds in _pair_blocks(batch):
                place = np.minimum(np.searchsorted(pair, values), max(len(pair) - 1, 0))
                known = pair[place] == values if len(pair) else np.zeros(len(values), dtype=bool)

                def per_row(of_link: np.ndarray, bounds=bounds) -> np.ndarray:
                    total = np.concatenate([[0], np.cumsum(of_link, dtype=np.int64)])
                    return total[bounds[1:]] - total[bounds[:-1]]

                count, is_best = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
                count[known], is_best[known] = n[place[known]], best[place[known]]
                left = np.concatenate([[0], np.cumsum(per_row(~known))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(a, b - a) for c in names], pa.array(per_row(is_best)),
                     pa.array(per_row(count)), pa.ListArray.from_arrays(pa.array(left), pa.array(values[~known]))],
                    names=[*names, "n_best", "count_sum", "rest"])
    return looked_up


def with_link_scores(aligned: DataFrame, counts: DataFrame,
                     most_broadcast: int = MOST_BROADCAST_PAIRS) -> DataFrame:
    """Aligned documents with ``n_best`` and ``count_sum`` in place of the pairs."""
    least, all_of_them = _least_broadcast_count(counts, most_broadcast)
    frequent = counts.where(F.col("n") >= least).select("pair", "n", "best").toArrow()
    pair = frequent["pair"].to_numpy()
    order = np.argsort(pair)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (pair[order], frequent["n"].to_numpy()[order], frequent["best"].to_numpy()[order]))
    found = aligned.mapInArrow(_looked_up(shared), SCORED)
    if all_of_them:
        return found.drop("row", "rest")
    found = stored(found, "link-scores")
    rest = found.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(
        F.count(F.lit(1)).alias("links"))
    rare = counts.where(F.col("n") < least).select("pair", "n", "best")
    added = rest.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    joined = found.join(added, "row", "left")
    return joined.select(*[
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias(c) if c == "n_best" else
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias(c) if c == "count_sum" else F.col(c)
        for c in found.columns if c not in ("row", "rest")])


def alignment(documents: DataFrame, a_path: str, b_path: str,
              most_broadcast: int = MOST_BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, n_best
    and count_sum of every row (the module's docstring says what they are)."""
    aligned = aligned_documents(documents, a_path, b_path)
    return with_link_scores(aligned, link_counts(aligned), most_broadcast)
