"""Row rejection with ordered reasons, declared as a list of (code, predicate)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Reasons = Sequence[tuple[str, Column]]

MAX_AMOUNT, MAX_MILES, MIN_MINUTES, MAX_MINUTES = 10_000.0, 300.0, 0.5, 1440.0


def minutes(start: str, end: str) -> Column:
    """Minutes between two timestamps, each cut to whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60.0


def trip_reasons() -> Reasons:
    """The reasons of the batch path, in order. A null distance passes; NaN amounts are out of range."""
    c = F.col
    fare, total, miles, took = c("fare_amount"), c("total_amount"), c("trip_distance_mi"), minutes("pickup_ts", "dropoff_ts")
    return (
        ("null_timestamp", c("pickup_ts").isNull() | c("dropoff_ts").isNull()),
        ("dropoff_not_after_pickup", c("dropoff_ts") <= c("pickup_ts")),
        ("null_amount", fare.isNull() | total.isNull()),
        ("negative_fare", (fare < 0) | (total < 0)),
        ("fare_out_of_range", (fare > MAX_AMOUNT) | (total > MAX_AMOUNT)),
        ("duration_out_of_range", (took < MIN_MINUTES) | (took > MAX_MINUTES)),
        ("distance_out_of_range", (miles < 0) | (miles > MAX_MILES)),
    )


def first_reason(reasons: Reasons) -> Column:
    """The code of the first predicate that is true; null if none is."""
    (code, test), *rest = reasons
    out = F.when(test, F.lit(code))
    for code, test in rest:
        out = out.when(test, F.lit(code))
    return out


def classify(df: DataFrame, reasons: Reasons, name: str = "reason") -> DataFrame:
    return df.withColumn(name, first_reason(reasons))


def valid(df: DataFrame, reasons: Reasons) -> DataFrame:
    """The rows without a reason; one filter, no extra column."""
    return df.where(first_reason(reasons).isNull())


def rejected(df: DataFrame, reasons: Reasons, *keep: str) -> DataFrame:
    """The kept columns and the reason of each rejected row."""
    return classify(df, reasons).where(F.col("reason").isNotNull()).select(*keep, "reason")
