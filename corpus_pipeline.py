"""The corpus pipeline: documents in, packed token sequences out.

Every stage takes what its predecessor kept, as written and read again, and
calls one operator of ``snaplake.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaplake.llm.common import col, unused
from snaplake.llm.mixing import mixed_documents
from snaplake.llm.packing import pack
from snaplake.llm.pu_classifier import quality_classifier
from snaplake.llm.quality_rules import quality_rules
from snaplake.llm.queries import TOKENIZER
from snaplake.llm.simhash import group_leaders
from snaplake.session import scratch_path
from snaplake.sources.io import read_testdata


def clean_hosts_and_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, their host's verdict included."""
    return quality_rules(docs, carry=docs.columns).filter("kept").select("held.*")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    found = quality_classifier(docs, read_testdata(spark, sf_dir, "labels"), carry=docs.columns)
    return found.filter("predicted = 1").select("held.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of each near-duplicate group with the group's smallest id, of several texts the one with the smallest hash.

    Rows that repeat an id with the same text are one document, other texts of
    that id are documents of their own; a NULL id is in no group and stays.
    """
    key, tie, place = "doc_id", unused(docs, "tie"), unused(docs, "place")
    found = group_leaders(docs).select(F.col("doc_id").alias(key), F.col("tie").alias(tie))
    kept = docs.withColumn(tie, F.xxhash64(col("text").cast("string"))).join(found, [key, tie], "left_semi")
    repeats = Window.partitionBy(key, tie).orderBy(F.xxhash64(*[col(c) for c in docs.columns]))
    named = kept.withColumn(place, F.row_number().over(repeats)).filter(F.col(place) == 1).select(docs.columns)
    return named.unionByName(docs.filter(col(key).isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: (doc_id, start, length, doc_tokens, ids, sequence_id, offset)."""
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", clean_hosts_and_documents),
    ("quality classifier", good_documents),
    ("simhash near-dedup", one_of_each_group),
    ("mixing", mix_sources),
    ("packing", packed_sequences),
]

#: Fingerprints, a trained model and a packing plan have no SQL form; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_testdata(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
