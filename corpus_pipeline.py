"""The corpus pipeline: toxic documents go, of exact and near copies one stays, secrets are taken out, and the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. What a stage stores on its way is deleted when its
result is written, and that when the next stage's is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratamill.llm import exact_dedup, jaccard, packing, secret_scan, toxicity
from stratamill.llm.registry import table
from stratamill.llm.shared import release, stored_result


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_documents(docs)


def pack_rest(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets), ("best-fit packing", pack_rest),
]

#: Trained scores, components of similarities and a tokenizer are not expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that stay."""
    given = docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored_result(lambda: stage(spark, docs, sf_dir), spark, f"stage-{name.replace(' ', '-')}")  # noqa: B023
        if before is not given:
            release(before)
    return docs
