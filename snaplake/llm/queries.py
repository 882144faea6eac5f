"""The operators over the given tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import license_scan as licenses
from snaplake.llm import mixing, url_filter
from snaplake.llm.alignment import align_tokenizers
from snaplake.llm.bpe import bpe_round_trip
from snaplake.llm.embedding_dedup import embedding_dedup
from snaplake.llm.oracle import SQL
from snaplake.llm.packing import pack
from snaplake.llm.pu_classifier import quality_classifier
from snaplake.llm.quality_rules import quality_rules
from snaplake.llm.simhash import simhash_dedup
from snaplake.llm.token_store import crc32_of_ids, store_tokens
from snaplake.llm.warc import archive
from snaplake.llm.whitening import whiten
from snaplake.sources.io import read_testdata

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_testdata(spark, sf_dir, "documents")).drop("host_failed")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(read_testdata(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(read_testdata(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read_testdata(spark, sf_dir, "embeddings"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(read_testdata(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_testdata(spark, sf_dir, "documents")).drop("spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read_testdata(spark, sf_dir, "documents"), TOKENIZER)
    return packed.select("doc_id", "start", "length", crc32_of_ids("length", "ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store_tokens(read_testdata(spark, sf_dir, "documents"), TOKENIZER)
    return stored.select("doc_id", "start", "n_tokens", crc32_of_ids("n_tokens", "ids").alias("ids_crc32"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_testdata(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(read_testdata(spark, sf_dir, "documents"), read_testdata(spark, sf_dir, "labels"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_round_trip(read_testdata(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_testdata(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align_tokenizers(read_testdata(spark, sf_dir, "documents"), TOKENIZER, PIECES)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_simhash_dedup, op3_warc, op4_embedding_dedup, op5_url_filter, op6_license_scan, op7_packing,
    op8_token_store, op9_mixing, op10_quality_classifier, op11_bpe, op12_whitening, op13_alignment)}

ORACLE_SQL: dict[str, str] = SQL
