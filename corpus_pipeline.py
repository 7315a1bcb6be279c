"""Corpus pipeline: quality rules, near-duplicates, secrets, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir).
All but the last return the columns of ``documents``.  ``run`` applies them to
``documents``, writing each result to the shared folder for the next.

Every stage works on all rows it gets: documents that the quality rules reject
go; one document of each near-duplicate group stays, the one with the smallest
``doc_id``; secrets are replaced in the text; the last stage packs the ids.

Defined results: a document with a null, empty or very short text fails the base
rules and goes; rows with a null ``doc_id`` are judged like others and stay behind
those with ids in their group; of repeated rows and equal ids one row stays (told
apart by a number given once); very long texts are read whole in every stage; extra
columns of any name are carried to the last stage; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletflow.llm.binary_packing import pack_binary, tokenised
from walletflow.llm.common import read_table, stored
from walletflow.llm.fertility_rules import keep_good
from walletflow.llm.queries import vocabulary
from walletflow.llm.secret_scan import redact_secrets
from walletflow.llm.simhash_dedup import near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, vocabulary("piece_bpe_32k.model"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group.  Rows are told apart by a number given once and stored, so
    repeated and null ids do not matter."""
    numbered = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "dedup-rows")
    found = near_duplicates(numbered.select(
        F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), "at").alias("doc_id"), F.col("row.text").alias("text")
    ))
    # the smallest (null last, id, number) of the group is one row
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.at").alias("at"))
    return numbered.join(kept, "at", "left_semi").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = tokenised(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    return pack_binary(tokens)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Tokenising and fingerprints are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
