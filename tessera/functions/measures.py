"""Measures that the aggregates share: money as decimals, averages rounded, safe shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(value: str | Column) -> Column:
    """Sum rounded half up to cents, from whole millionths, so the order of rows doesn't matter.

    Millionths fit a bigint up to 9.2e12 a row; their sum has 29 digits. That is exact for
    amounts of up to six decimals and spares each row the parsing that a cast from double to
    decimal costs. NaN, infinite and larger amounts count as null, and so does a sum of more
    than 18 digits: no value of a row can end a query.
    """
    value = F.col(value) if isinstance(value, str) else value
    millionths = F.rint(value.cast("double") * 1_000_000).try_cast("bigint").cast("decimal(19,0)")
    return (F.sum(millionths) / F.lit(1_000_000)).try_cast(MONEY)


def exact_average(value: str | Column, to: str) -> Column:
    """Average of decimals, which any order of rows gives alike; what doesn't fit one counts as null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.avg(value.try_cast("decimal(18,6)")).try_cast(to)


def average(value: str | Column, places: int | None = 4) -> Column:
    """Average of the values that aren't null, rounded half up (places None: as it is); null if there is none."""
    return F.avg(value) if places is None else F.round(F.avg(value), places)


def share(part: Column, whole: Column, places: int = 6) -> Column:
    """part / whole rounded; null where the whole is zero, which ANSI division would raise."""
    return F.round(F.try_divide(part, whole), places)
