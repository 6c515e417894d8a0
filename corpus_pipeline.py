"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents.  All but the last return the columns of the documents.  Nulls and empty texts: a null text counts
as empty for toxicity and packing, has no line, no shingle and no personal data; an empty table passes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakefold.llm import common, lines, minhash, packing, personal_data, queries, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
REJECTED_FROM = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches 0.5; learns from all labelled documents that are here."""
    common.small_batches(spark)
    machine = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    name = common.unused_name(docs, "toxicity")
    return toxicity.scored(docs, machine, name).where(F.col(name) < REJECTED_FROM).drop(name)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every line that an earlier line matches; documents with no line of their own left go."""
    return lines.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates (five words, similarity 0.8)."""
    common.small_batches(spark)
    name = common.unused_name(docs, "gone_id")
    gone = minhash.groups(docs).where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(name), "left_anti")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    common.small_batches(spark)
    return personal_data.redact(docs, personal_data.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1,024 tokens."""
    common.small_batches(spark)
    return packing.pack_documents(docs, queries.tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("minhash", without_near_copies),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

ORACLE_SQL = None  # kernel machine, boosted trees and tokenizer; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
