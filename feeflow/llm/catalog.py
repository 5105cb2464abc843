"""The registered queries of the training-data operators.

Each query applies its operator to the whole table and derives the columns
that the check compares from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.llm import (decontaminate, language_crf, lexical_search, licenses, line_spread, order_minhash, packing,
                         quality_fm, quality_rules, sharding, suffix_dedup, token_alignment, token_orc)
from feeflow.llm.common import table, text_of


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of both sizes in use: files of 16 MB, and parts of 64 KB."""
    documents = table(spark, sf_dir, "documents")
    found = [sharding.shard(documents, size).withColumn("max_bytes", F.lit(size)) for size in SHARD_SIZES]
    return found[0].unionByName(found[1])


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licenses.document_files(table(spark, sf_dir, "documents"))
    return licenses.scan(files).select("doc_id", "licence", "origin",
                                       F.round("similarity", 6).alias("similarity"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its group (the least doc_id in it) and the
    group's size."""
    found = order_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    groups = found.groupBy("root").agg(F.min("doc_id").alias("class_id"),
                                       F.count(F.lit(1)).alias("class_size"))
    return found.join(groups, "root").select("doc_id", "class_id", "class_size", "n_words")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.drop_spread_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.md5(text_of()).alias("text_md5"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op7_pigeonhole_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op8_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(),
                        with_ids=False).drop("ids")


def op9_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    machine = quality_fm.train(documents, table(spark, sf_dir, "labels"))
    return quality_fm.score(documents, machine)


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.identify(table(spark, sf_dir, "documents"))


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())


SHARD_SIZES = (sharding.MAX_BYTES, 64 << 10)

QUERIES = {
    "op1_extendible_shards": op1_extendible_shards,
    "op2_license_scan": op2_license_scan,
    "op3_order_minhash": op3_order_minhash,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_spread": op5_line_spread,
    "op6_quality_rules": op6_quality_rules,
    "op7_pigeonhole_edit": op7_pigeonhole_edit,
    "op8_nnls_packing": op8_nnls_packing,
    "op9_factorisation_machine": op9_factorisation_machine,
    "op10_token_orc": op10_token_orc,
    "op11_crf_language_id": op11_crf_language_id,
    "op12_block_max_search": op12_block_max_search,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op1_extendible_shards": " UNION ALL ".join(
        f"SELECT *, CAST({size} AS INTEGER) AS max_bytes FROM ({sharding.oracle(size)}) s" for size in SHARD_SIZES),
    "op2_license_scan": licenses.ORACLE,
    "op5_line_spread": line_spread.ORACLE,
    "op12_block_max_search": lexical_search.ORACLE,
}
