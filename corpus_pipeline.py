"""A corpus pipeline over ``documents``: quality rules, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, whatever other columns they have; all but the last
return the columns they were given. ``run`` writes each stage's rows to the shared folder and reads them back.
Null texts have no words and are rejected by the first stage; later stages still read them as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import mixing, packing, quality, secret_scan, simhash
from leadlens.llm.queries import MIX, TOKENIZER
from leadlens.session import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest ``doc_id``."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the weights of their sources: each once at least, those of small sources up to twice; in the order of the mix."""
    return mixing.mix_rows(docs, MIX)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", one_of_each_group),
    ("secret_scan", without_secrets),
    ("temperature_mixing", mixed),
    ("bin_slack_packing", packed),
]

#: Near-duplicate groups, lexing and packing are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
