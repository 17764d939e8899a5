"""Conforming raw sources to the bronze schema: one projection for each source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.schemas import BRONZE

# Bronze column and raw column, for what all sources have.
COMMON = {
    "vendor_id": "VendorID",
    "passenger_count": "passenger_count",
    "trip_distance_mi": "trip_distance",
    "rate_code": "RatecodeID",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "payment_type_code": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "Airport_fee",
    "cbd_congestion_fee": "cbd_congestion_fee",
    "ehail_fee": "ehail_fee",
    "trip_type": "trip_type",
}


@dataclass(frozen=True)
class SourceSpec:
    """How a source names the columns of the bronze layer; None where it has no such column."""

    name: str
    columns: dict[str, str | None]


SOURCES = {
    "yellow": SourceSpec("yellow", COMMON | {"pickup_ts": "tpep_pickup_datetime", "dropoff_ts": "tpep_dropoff_datetime", "ehail_fee": None, "trip_type": None}),
    "green": SourceSpec("green", COMMON | {"pickup_ts": "lpep_pickup_datetime", "dropoff_ts": "lpep_dropoff_datetime", "airport_fee": None, "cbd_congestion_fee": None}),
}


def spec(source: str) -> SourceSpec:
    """Any case of a known name; ValueError otherwise."""
    found = SOURCES.get((source or "").lower())
    if found is None:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(SOURCES)}")
    return found


def conform(raw: DataFrame, source: str) -> DataFrame:
    """Renames, casts and orders raw columns as BRONZE; what the raw data lack becomes typed nulls.

    Raw names match with case, as files differ in it. A value that can't be cast becomes
    null; malformed() counts them.
    """
    known, have = spec(source), set(raw.columns)
    out = []
    for f in BRONZE.fields:
        if f.name == "source":
            out.append(F.lit(known.name).alias("source"))
            continue
        name = known.columns.get(f.name)
        column = F.col(f"`{name}`").try_cast(f.dataType) if name in have else F.lit(None).cast(f.dataType)
        out.append(column.alias(f.name))
    return raw.select(out)


def malformed(raw: DataFrame, source: str) -> DataFrame:
    """One row: for each bronze column that is cast, how many values become null by it."""
    known = spec(source)
    casts = {f.name: (known.columns.get(f.name), f.dataType) for f in BRONZE.fields if f.name != "source"}
    lost = {
        n: F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(to).isNull())
        for n, (c, to) in casts.items()
        if c in raw.columns and raw.schema[c].dataType != to
    }
    return raw.agg(*[x.alias(n) for n, x in lost.items()]) if lost else raw.sparkSession.createDataFrame([(0,)], "none int")


def union(*conformed: DataFrame) -> DataFrame:
    """Conformed sources one after the other, by name."""
    first, *rest = conformed
    for df in rest:
        first = first.unionByName(df)
    return first
