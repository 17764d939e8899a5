"""Canonical content keys as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def field(name: str, value: Column) -> Column:
    """name=<length>:<value>; or name=-1:; for null. The length makes the joined fields unambiguous."""
    return F.coalesce(F.concat(F.lit(f"{name}="), F.char_length(value).cast("string"), F.lit(":"), value, F.lit(";")), F.lit(f"{name}=-1:;"))


def text(value: Column) -> Column:
    """Trimmed and lower-cased; blank is null."""
    trimmed = F.lower(F.trim(value))
    return F.when(trimmed != "", trimmed)


def stamp(value: Column) -> Column:
    """A timestamp in the session's zone (UTC), to milliseconds."""
    return F.date_format(value, STAMP)


def number(value: Column, scale: int) -> Column:
    """Rounded half up to a fixed scale, after decimal(12,4); out of range is null; no minus zero."""
    return F.round(value.try_cast("decimal(12,4)"), scale).cast(f"decimal(14,{scale})").cast("string")


def whole(value: Column) -> Column:
    return value.cast("string")


def digest(*fields: Column) -> Column:
    """SHA-256 of the fields in order, lowercase hexadecimal."""
    return F.sha2(F.concat(*fields), 256)


def trip_key() -> Column:
    """The key of a bronze trip: source, vendor, times, places, distance and total."""
    c = F.col
    return digest(
        field("source", text(c("source"))),
        field("vendor_id", whole(c("vendor_id"))),
        field("pickup_ts", stamp(c("pickup_ts"))),
        field("dropoff_ts", stamp(c("dropoff_ts"))),
        field("pickup_location_id", whole(c("pickup_location_id"))),
        field("dropoff_location_id", whole(c("dropoff_location_id"))),
        field("trip_distance", number(c("trip_distance_mi"), 3)),
        field("total_amount", number(c("total_amount"), 2)),
    )
