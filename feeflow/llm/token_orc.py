"""Token ids in ORC files.

Documents are range-partitioned and sorted by id, tokenised there, and written
as ORC: the ids column uses ORC's integer run-length encoding, every stripe
has row indexes, and the document id has a Bloom filter per row group, so
stripes are read in parallel and a look-up by id reads only the row groups that
may hold it.  Each row also carries its file's rank (``shard``) and its place
in it (``row``), which give the global order back without another sort of ids.

The texts are shuffled, not the ids (sampling for the range boundaries would
tokenise twice).  Equal doc_ids spread by the text's hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feeflow.llm.bytehash import row_slices, text_buffer
from feeflow.llm.common import row_key, stored, text_of
from feeflow.llm.tokens import block_encoder
from feeflow.session import scratch_path

END_ID = 2
BLOCK = 1 << 20
OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.compress": "SNAPPY",
}


def _encoded(path: str, end_id: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard, row = block_encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in row_slices(offsets, BLOCK):
                values, count = tokens.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], end_id)
                ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     pa.array(np.full(b - a, shard, dtype=np.int32)),
                     pa.array(np.arange(row, row + b - a)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                    names=["doc_id", "shard", "row", "ids"])
                row += b - a
    return encoded


def write_tokens(documents: DataFrame, tokenizer_path: str, path: str,
                 end_id: int = END_ID) -> None:
    """Write the ids of every row's whole text, with ``end_id`` after each, to
    ORC files under ``path`` in ascending doc_id order (nulls first; rows of
    one id by their text's hash).  A null text is empty."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                            row_key().alias("key"))
    ordered = rows.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    ordered.select("doc_id", "text").mapInArrow(
        _encoded(tokenizer_path, end_id), "doc_id long, shard int, row long, ids array<int>"
    ).write.mode("overwrite").options(**OPTIONS).orc(path)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        bounds = lists.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
        crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("shard"), batch.column("row"),
             pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())],
            names=["doc_id", "shard", "row", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    ``start`` counts the ids of all documents before it: the totals of earlier
    files (one row per file) plus the running sum inside its own file.
    """
    files = stored(spark.read.orc(path).select("doc_id", "shard", "row", "ids").mapInArrow(
        _summed, "doc_id long, shard int, row long, n_tokens long, ids_crc32 long"), "token-index")
    inside = Window.partitionBy("shard").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = files.withColumn("local", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    return local.join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id and ids; with ``doc_ids`` only the row groups whose statistics
    and Bloom filters may hold them are read."""
    files = spark.read.orc(path)
    if doc_ids is not None:
        files = files.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    return files.select("doc_id", "ids")


def token_files(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID,
                path: str | None = None) -> DataFrame:
    """Write the files (to the shared checkpoint folder unless ``path`` is
    given) and return ``read_index`` of them."""
    spark = documents.sparkSession
    path = path or scratch_path(spark, "llm-token-orc")
    write_tokens(documents, tokenizer_path, path, end_id)
    return read_index(spark, path)
