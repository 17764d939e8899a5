"""Deterministic deduplication and latest-row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key: the first by the order, then by all other columns, so ties have one outcome.

    Written as a minimum of an ordering struct would shuffle whole rows; row_number with a
    filter lets Spark limit each group before the shuffle (WindowGroupLimit).
    """
    rest = [F.col(f"`{c}`").asc_nulls_last() for c, kind in df.dtypes if c not in keys and not kind.startswith("map")]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__place", F.row_number().over(window)).where("__place = 1").drop("__place")


def trip_order() -> list[Column]:
    """Higher total, higher tip, lower payment code, fewer passengers; nulls last throughout."""
    c = F.col
    return [c("total_amount").desc_nulls_last(), c("tip_amount").desc_nulls_last(), c("payment_type_code").asc_nulls_last(), c("passenger_count").asc_nulls_last()]


def newest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The last-version-wins view: of each key the row with the largest version.

    max_by over a struct is a partial aggregate, so old versions go before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest if c != version])).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def latest_per_key(df: DataFrame, key: str, by: Sequence[Column]) -> DataFrame:
    """DISTINCT ON: one row of each key, the first by the order."""
    return keep_first(df, [key], by)
