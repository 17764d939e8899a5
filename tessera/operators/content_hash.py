"""Order-independent content hashes of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ContentHash:
    rows: int
    total: str
    mixed: int


def row_text(df: DataFrame) -> Column:
    """All columns by name, each with its length or as null, so that nulls and borders can't be confused.

    Decimals and whole numbers lose trailing zeros, so scale doesn't count; doubles are
    rounded to 9 significant places of the written form.
    """
    parts = []
    for name, kind in sorted(df.dtypes):
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            c = F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
        elif kind in ("float", "double"):
            c = F.when(c.isNotNull(), F.format_string("%.9e", c.cast("double")))
        elif kind.startswith(("array", "map", "struct")):
            c = F.to_json(c)
        c = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")))
    return F.concat_ws("|", *parts)


def content_hash(df: DataFrame) -> ContentHash:
    """Row count, and the sum and xor of 64-bit row hashes; equal for the same rows in any order."""
    h = F.xxhash64(row_text(df))
    r = df.select(h.alias("h")).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("s"), F.bit_xor("h").alias("x")).first()
    return ContentHash(r["n"], r["s"], r["x"] or 0)
