"""Ranked lexical search by Block-Max MaxScore over document shards.

Index: a task turns every ``SHARD_BYTES`` of texts into one shard: per term a
posting list in document order, cut into blocks of ``BLOCK_POSTINGS``.  A block
is stored byte-packed (gaps and frequencies, as wide as its largest value), and
its head tells its first and last document and the largest score share inside,
so most blocks are judged without unpacking them.  All terms of all rows are
indexed; nothing is shuffled.

Search: the lists of the query terms meet the items that ask for them, and each
(shard, block of items) is searched in one task.  With the k-th best score so
far as threshold, the terms are split by their lists' global bounds: lists
whose bounds together stay below it are non-essential and give no candidates.
Documents of the essential lists are scored a window at a time; a candidate's
bound adds the block maxima of the non-essential lists, and only blocks of
candidates whose bound still reaches the threshold are unpacked.  Each shard
gives the k best of an item (its heap); Spark merges the heaps.

Scores follow the contract's integer formula (``weight``, ``share``).  Ties go
to the smaller doc_id, null ids last.  A null or empty text has no terms; a row
is a document of its own, also if it repeats; an item without terms, or whose
terms are in no document, has no result.  Repeated (item_id, text) rows are one
item; a null item_id is an item_id.  Other columns are not read.  A long text
is one document of one shard, in memory in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feeflow.llm.bytehash import Rolling, mix, row_slices, text_buffer
from feeflow.llm.common import small, stored, text_of

K = 10
SHARD_BYTES = 8 << 20
HASH_BYTES = 1 << 20
BLOCK_POSTINGS = 128
WINDOW = 1024            # documents scored at once
ITEMS_A_TASK = 256
LISTS_A_BATCH = 20_000

# Fixed values of the scoring formula.
SHARE_ONE, SHARE_TF, SHARE_M = 1_000_000_000, 1000, 8
LENGTH_BASE, LENGTH_SLOPE = 25, 75
WEIGHT_SCALE = 1000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

HEAD = np.dtype([("first", "<i4"), ("last", "<i4"), ("most", "<i4"), ("gap", "u1"), ("freq", "u1")])
INDEX = "shard long, term string, n int, top int, heads binary, data binary, docs array<long>, m array<long>"


def term_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the terms of all rows; no term crosses rows."""
    inside = _IN_TERM[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    before[row_starts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[row_starts[1:] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SHARE_ONE * tf // (SHARE_TF * tf + SHARE_M * m)


# -- collection statistics --------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        n_docs = n_terms = 0
        for a, b in row_slices(offsets, HASH_BYTES):
            own = offsets[a: b + 1] - offsets[a]
            starts, _ = term_bounds(data[offsets[a]: offsets[b]], own)
            n_docs += len(np.unique(np.searchsorted(own, starts, side="right")))
            n_terms += len(starts)
        yield pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms])], names=["n_docs", "n_terms"])


def collection_size(documents: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats) of the whole table."""
    row = documents.select(text_of().alias("text")).mapInArrow(_counted, "n_docs long, n_terms long").agg(
        F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    return row.n or 0, row.l or 0


# -- index ------------------------------------------------------------------------------------

def _width(most: np.ndarray) -> np.ndarray:
    """Bytes that hold values up to ``most``: 0, 1, 2 or 4."""
    return np.select([most == 0, most < 1 << 8, most < 1 << 16], [0, 1, 2], 4).astype(np.uint8)


def _put(out: np.ndarray, at: np.ndarray, width: np.ndarray, values: np.ndarray) -> None:
    for byte in range(4):
        held = width > byte
        out[at[held] + byte] = (values[held] >> (8 * byte)) & 0xFF


def _binary(bounds: np.ndarray, data: np.ndarray) -> pa.Array:
    """Slices of ``data`` between ``bounds`` as binaries."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def posting_lists(docs: np.ndarray, tf: np.ndarray, list_starts: np.ndarray,
                  m: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """(heads, data, postings, largest share) per list; ``docs`` and ``tf`` hold
    the lists' postings one after the other."""
    total, n = len(docs), np.diff(np.append(list_starts, len(docs)))
    in_list = np.arange(total) - np.repeat(list_starts, n)
    block_starts = np.flatnonzero(in_list % BLOCK_POSTINGS == 0)
    size = np.diff(np.append(block_starts, total))
    of_block = np.repeat(np.arange(len(block_starts)), size)
    gaps = np.diff(docs, prepend=0)
    gaps[block_starts] = 0
    heads = np.empty(len(block_starts), dtype=HEAD)
    heads["first"], heads["last"] = docs[block_starts], docs[block_starts + size - 1]
    heads["most"] = np.maximum.reduceat(share(tf, m[docs]), block_starts)
    heads["gap"] = _width(np.maximum.reduceat(gaps, block_starts))
    heads["freq"] = _width(np.maximum.reduceat(tf - 1, block_starts))
    gap_w, freq_w = heads["gap"].astype(np.int64), heads["freq"].astype(np.int64)
    ends = np.cumsum(size * (gap_w + freq_w))
    begin = ends - size * (gap_w + freq_w)
    place = np.arange(total) - block_starts[of_block]
    out = np.zeros(int(ends[-1]), dtype=np.uint8)
    _put(out, begin[of_block] + place * gap_w[of_block], gap_w[of_block], gaps)
    _put(out, (begin + size * gap_w)[of_block] + place * freq_w[of_block], freq_w[of_block], tf - 1)
    list_blocks = np.searchsorted(block_starts, list_starts)
    head_bounds = np.append(list_blocks, len(heads)) * HEAD.itemsize
    data_bounds = np.append(begin[list_blocks], len(out))
    top = np.maximum.reduceat(heads["most"], list_blocks)
    return _binary(head_bounds, heads.view(np.uint8)), _binary(data_bounds, out), n, top


def _shard(shard: int, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, n_docs: int,
           n_terms: int) -> Iterator[pa.RecordBatch]:
    """One shard's rows: its documents, then its lists."""
    data = _LOWER[data]
    starts, ends = term_bounds(data, offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    lengths = np.bincount(rows, minlength=len(ids)).astype(np.int64)
    m = LENGTH_BASE + LENGTH_SLOPE * lengths * n_docs // n_terms
    names = np.empty(len(starts), dtype=np.uint64)
    for a, b in row_slices(offsets, HASH_BYTES):
        first, last = np.searchsorted(starts, [offsets[a], offsets[b]])
        s, e = starts[first:last] - offsets[a], ends[first:last] - offsets[a]
        names[first:last] = mix(Rolling(data[offsets[a]: offsets[b]]).ranges(s, e) + (e - s).astype(np.uint64))

    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("n", pa.int32()), ("top", pa.int32()),
                        ("heads", pa.binary()), ("data", pa.binary()), ("docs", pa.list_(pa.int64())),
                        ("m", pa.list_(pa.int64()))])
    bounds = pa.array([0, len(ids)], pa.int32())
    yield pa.RecordBatch.from_arrays(
        [pa.array([shard]), pa.nulls(1, pa.string()), pa.array([len(ids)], pa.int32()), pa.nulls(1, pa.int32()),
         pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.ListArray.from_arrays(bounds, ids),
         pa.ListArray.from_arrays(bounds, pa.array(m))], schema=schema)

    order = np.argsort(names, kind="stable")   # a term's occurrences in document order
    names, at_row = names[order], rows[order]
    new_term = np.append(True, names[1:] != names[:-1])
    posting = np.flatnonzero(new_term | np.append(True, at_row[1:] != at_row[:-1]))
    tf = np.diff(np.append(posting, len(names)))
    list_starts = np.flatnonzero(new_term[posting])
    seen = order[posting[list_starts]]
    for a in range(0, len(list_starts), LISTS_A_BATCH):
        b = min(a + LISTS_A_BATCH, len(list_starts))
        low, high = list_starts[a], list_starts[b] if b < len(list_starts) else len(posting)
        heads, packed, n, top = posting_lists(
            at_row[posting[low:high]], tf[low:high], list_starts[a:b] - low, m)
        first, length = starts[seen[a:b]], (ends - starts)[seen[a:b]]
        bounds = np.concatenate([[0], np.cumsum(length)])
        letters = data[np.repeat(first - bounds[:-1], length) + np.arange(bounds[-1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(b - a, shard)), _binary(bounds, letters).cast(pa.string()),
             pa.array(n.astype(np.int32)), pa.array(top.astype(np.int32)), heads, packed,
             pa.nulls(b - a, pa.list_(pa.int64())), pa.nulls(b - a, pa.list_(pa.int64()))], schema=schema)


def _indexed(n_docs: int, n_terms: int, shard_bytes: int):
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        ids, texts, bounds, size = [], [], [], 0

        def shard():
            joined = np.concatenate(bounds)
            return _shard((task << 32) + made, pa.concat_arrays(ids), np.concatenate(texts),
                          np.concatenate([[0], np.cumsum(joined)]), n_docs, n_terms)

        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in row_slices(offsets, shard_bytes):
                own = offsets[b] - offsets[a]
                if size and size + own > shard_bytes:
                    yield from shard()
                    made, ids, texts, bounds, size = made + 1, [], [], [], 0
                ids.append(batch.column("doc_id").slice(a, b - a))
                texts.append(data[offsets[a]: offsets[b]])
                bounds.append(np.diff(offsets[a: b + 1]))
                size += own
        if size:
            yield from shard()
    return indexed


def build_index(documents: DataFrame, size: tuple[int, int] | None = None,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The stored index of all rows: one row per (shard, term), and one per
    shard (null term) with its documents and their length factors ``m``."""
    n_docs, n_terms = size or collection_size(documents)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    if not n_terms:
        rows, n_terms = rows.limit(0), 1
    return stored(rows.mapInArrow(_indexed(n_docs, n_terms, shard_bytes), INDEX), "lexical-index")


# -- search -------------------------------------------------------------------------------------

class PostingList:
    """A list whose blocks are unpacked when asked for, once."""

    def __init__(self, n: int, top: int, heads: bytes, data: bytes, m: np.ndarray):
        self.n, self.top, self.data, self.m = n, top, data, m
        head = np.frombuffer(heads, dtype=HEAD)
        self.first, self.last, self.most = (head[c].astype(np.int64) for c in ("first", "last", "most"))
        self.gap, self.freq = head["gap"].tolist(), head["freq"].tolist()
        size = np.full(len(head), BLOCK_POSTINGS)
        size[-1] = n - BLOCK_POSTINGS * (len(head) - 1)
        self.begin = np.concatenate([[0], np.cumsum(
            size * (head["gap"].astype(np.int64) + head["freq"]))]).tolist()
        self.size = size.tolist()
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, shares) of block ``i``."""
        if i not in self.known:
            n, gap, freq, at = self.size[i], self.gap[i], self.freq[i], self.begin[i]
            docs = np.full(n, self.first[i])
            if gap:
                docs += np.cumsum(np.frombuffer(self.data, f"<u{gap}", n, at), dtype=np.int64)
            tf = np.ones(n, dtype=np.int64)
            if freq:
                tf += np.frombuffer(self.data, f"<u{freq}", n, at + n * gap)
            self.known[i] = docs, share(tf, self.m[docs])
        return self.known[i]

    def between(self, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Postings of the documents ``low`` to ``high`` - 1."""
        a, b = np.searchsorted(self.last, low), np.searchsorted(self.first, high)
        found = []
        for i in range(a, b):
            docs, shares = self.block(i)
            if docs[0] < low or docs[-1] >= high:
                x, y = np.searchsorted(docs, [low, high])
                docs, shares = docs[x:y], shares[x:y]
            found.append((docs, shares))
        return found

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that may hold each document, -1 where none does."""
        i = np.searchsorted(self.last, docs)
        inside = i < len(self.last)
        inside[inside] = self.first[i[inside]] <= docs[inside]
        return np.where(inside, i, -1)

    def shares(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Shares of the documents (0 where they are not in the list); only
        their blocks are unpacked."""
        out = np.zeros(len(docs), dtype=np.int64)
        for i in np.unique(blocks[blocks >= 0]).tolist():
            mine = np.flatnonzero(blocks == i)
            held, shares = self.block(i)
            place = np.minimum(np.searchsorted(held, docs[mine]), len(held) - 1)
            out[mine] = np.where(held[place] == docs[mine], shares[place], 0)
        return out


def top_documents(lists: list[tuple[int, PostingList]], n_docs: int, ids: np.ndarray, k: int = K,
                  window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``k`` best by (score, ids); ``lists`` holds a
    weight with each list, ``ids`` the tie order of the documents."""
    lists = sorted(((w, x) for w, x in lists if w > 0), key=lambda p: p[0] * p[1].top)
    reach = np.cumsum([w * x.top for w, x in lists])
    best, scores, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for low in range(0, n_docs, window):
        # lists that even together stay below the threshold give no candidates
        essential = int(np.searchsorted(reach, threshold, side="left"))
        if essential == len(lists):
            break
        high = min(low + window, n_docs)
        total = np.zeros(high - low, dtype=np.int64)
        for w, postings in lists[essential:]:
            for docs, shares in postings.between(low, high):
                total[docs - low] += w * shares
        docs = np.flatnonzero(total)
        if not len(docs):
            continue
        score = total[docs]
        docs = docs + low
        rest = lists[essential - 1:: -1] if essential else []
        if rest:
            reachable = score + reach[essential - 1]
            docs, score = docs[reachable >= threshold], score[reachable >= threshold]
            blocks = np.stack([x.block_of(docs) for _, x in rest])
            most = np.stack([np.where(b >= 0, w * x.most[b], 0) for b, (w, x) in zip(blocks, rest, strict=True)])
            left = most.sum(axis=0)
            for i, (w, postings) in enumerate(rest):
                hold = score + left >= threshold
                if not hold.all():
                    docs, score, left = docs[hold], score[hold], left[hold]
                    blocks, most = blocks[:, hold], most[:, hold]
                score = score + w * postings.shares(docs, blocks[i])
                left = left - most[i]
        hold = score >= threshold
        best, scores = np.concatenate([best, docs[hold]]), np.concatenate([scores, score[hold]])
        if len(best) > k:
            keep = np.lexsort((ids[best], -scores))[:k]
            best, scores = best[keep], scores[keep]
        if len(best) == k:
            threshold = max(int(scores.min()), 1)
    return best, scores


def _searched(k: int):
    def searched(group: pa.Table) -> pa.Table:
        docs = group.filter(pa.compute.is_null(group["term"]))
        lists = group.filter(pa.compute.is_valid(group["term"]))
        ids = docs["docs"].combine_chunks().flatten() if docs.num_rows else pa.array([], pa.int64())
        m = docs["m"].combine_chunks().flatten().to_numpy() if docs.num_rows else np.zeros(0, np.int64)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.empty(len(ids), dtype=np.int64)
        order[np.lexsort((ids.fill_null(0).to_numpy(), null))] = np.arange(len(ids))
        wanted: dict[str, list[tuple[int, PostingList]]] = {}
        for n, top, heads, data, weight, items in zip(
                *(lists[c].to_pylist() for c in ("n", "top", "heads", "data", "weight", "items")), strict=True):
            postings = PostingList(n, top, heads, data, m)
            for item in items:
                wanted.setdefault(item["item"], []).append((weight * item["times"], postings))
        items, found, scores = [], [], []
        for item, mine in wanted.items():
            best, score = top_documents(mine, len(ids), order, k)
            items += [item] * len(best)
            found.append(best)
            scores.append(score)
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        return pa.table({"item": pa.array(items, pa.string()), "doc_id": ids.take(pa.array(at)),
                         "score": pa.array(np.concatenate(scores) if scores else at)})
    return searched


def terms_of(text: Column) -> Column:
    """All terms of a text, with repeats."""
    return F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit(f"({TERM})"))


def search(index: DataFrame, items: DataFrame, n_docs: int, k: int = K,
           items_a_task: int = ITEMS_A_TASK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents per item."""
    asked = stored(items.select(
        "item_id", F.sha2(F.concat_ws("|", F.coalesce(F.col("item_id").cast("string"), F.lit("null")), text_of()),
                          256).alias("item"), text_of().alias("text")).dropDuplicates(["item"]), "search-items")
    n_blocks = max(1, -(-asked.count() // items_a_task))
    words = asked.select("item", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("block"),
                         F.explode(terms_of(F.col("text"))).alias("term")).groupBy("block", "item", "term").agg(
        F.count(F.lit(1)).alias("times"))
    words = stored(words.groupBy("block", "term").agg(
        F.collect_list(F.struct("item", "times")).alias("items")), "search-terms")
    # the lists of the asked terms, once; a term's lists say in how many documents it is
    lists = stored(index.where(F.col("term").isNotNull()).join(
        small(words.select("term").distinct()), "term", "left_semi"), "search-lists")
    weight = F.floor(F.lit(float(WEIGHT_SCALE)) * F.log(
        F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = lists.groupBy("term").agg(F.sum("n").alias("df")).select("term", weight.alias("weight"))
    weighted = stored(words.join(weights, "term"), "search-weights")
    parts = lists.join(small(weighted), "term").select(
        "shard", "block", "term", "n", "top", "heads", "data", "docs", "m", "weight", "items")
    shards = index.where(F.col("term").isNull()).select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), "term", "n", "top", "heads",
        "data", "docs", "m", F.lit(None).cast("long").alias("weight"),
        F.lit(None).cast(weighted.schema["items"].dataType).alias("items"))
    heaps = parts.unionByName(shards).groupBy("shard", "block").applyInArrow(
        _searched(k), "item string, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    merged = heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Index all documents and search them for every item."""
    size = collection_size(documents)
    return search(build_index(documents, size), items, size[0], k)


ORACLE = f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{TERM}')) AS term
  FROM documents
),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
collection AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
factors AS (
  SELECT doc_id, {LENGTH_BASE} + ({LENGTH_SLOPE} * n * n_docs) // n_terms AS m FROM lengths, collection
),
weights AS (
  SELECT term, CAST(floor({WEIGHT_SCALE} * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE)
                                              / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, collection GROUP BY term
),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{TERM}')) AS term
  FROM benchmark
),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * (({SHARE_ONE} * tf) // ({SHARE_TF} * tf + {SHARE_M} * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN factors USING (doc_id)
  GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= {K}
"""
