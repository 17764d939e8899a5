"""Bounded samples of labelled documents for the classifiers that are fitted on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, allowed: Column | None = None,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """y int and t string of at most bound labelled documents, those of the smallest key hashes.

    allowed: a condition on the key, for holding rows out. Null labels and keys are left out;
    of several labels of a document the largest counts. The chosen keys are bound rows at
    most, so they are broadcast and the texts aren't shuffled.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.where(allowed) if allowed is not None else known
    known = known.groupBy(F.col(key).cast("long").alias("k")).agg((F.max(label) > 0).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("k"), "k").limit(bound)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.join(F.broadcast(chosen), "k").select("k", "y", "t")
