"""The training-corpus pipeline: stages that each call one operator of tessera.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, mixing, near_dedup, quality, toxicity
from tessera.llm.common import read, remove, shared_folder


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the factorization machine scores at one half or more.

    It learns from a sample of all labels; what it does with rows it hasn't seen is measured by op7_toxicity.
    """
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def remove_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose nearest labelled ones vote for low quality.

    Labels are used as in remove_toxic; op3_quality holds rows out.
    """
    return quality.drop_poor(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity 0.8.

    At that similarity SimHash fingerprints differ in up to a third of their bits, where pivots
    discard nothing, so candidates come from an exact prefix filter (see the README).
    """
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents to the target weights of sources, languages and topics."""
    return mixing.draw(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encode_decode(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("quality", remove_poor),
    ("near_dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The fitted and vectorised stages have no SQL; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written to the shared folder and read again.

    A stage's output goes when the next one's is written; the last one's stays for the caller.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
