"""The operators' queries over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import align, bpe, chat, covertree, langid, licenses, manifest, packing, pii, shards, simhash, sketch, suffix
from ordermill.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removal_report(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(conversations, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_document_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), 24)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, a, b = table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model"
    return align.aligned_documents(docs, public_tokenizers.path(a), public_tokenizers.path(b))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def leaf(text):
        return manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    claimed = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return manifest.manifest(docs, leaf(F.col("text")), leaf(claimed))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_array": op2_suffix_array,
    "op3_chat_format": op3_chat_format,
    "op4_document_sketch": op4_document_sketch,
    "op5_simhash": op5_simhash,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_cover_tree": op8_cover_tree,
    "op9_kd_tree_shards": op9_kd_tree_shards,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_personal_data": op13_personal_data,
}

ORACLE: dict[str, str] = {
    "op6_license_scan": licenses.oracle_sql(),
    "op12_merkle_manifest": manifest.oracle_sql(),
}
