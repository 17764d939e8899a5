"""Explicit schemas: bronze, silver, the zone dimension and the event envelope."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def struct(spec: str) -> T.StructType:
    """Nullable fields from "name type, ..."; needs no session, unlike fromDDL."""
    fields = (f.split() for f in spec.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


# Column names, types and order of the layers.
BRONZE = struct(
    "source string, vendor_id int, pickup_ts timestamp, dropoff_ts timestamp, passenger_count bigint, trip_distance_mi double, "
    "rate_code bigint, store_and_fwd_flag string, pickup_location_id int, dropoff_location_id int, payment_type_code bigint, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, airport_fee double, cbd_congestion_fee double, ehail_fee double, trip_type bigint"
)
SILVER = struct(
    "trip_key string, source string, vendor_id int, pickup_ts timestamp, dropoff_ts timestamp, passenger_count bigint, "
    "trip_distance_mi double, trip_duration_min double, avg_speed_mph double, pickup_location_id int, dropoff_location_id int, "
    "pickup_borough string, pickup_zone string, dropoff_borough string, dropoff_zone string, payment_type string, "
    "fare_amount double, tip_amount double, total_amount double, tip_pct double, cbd_congestion_fee double"
)
ZONE = struct("LocationID int, Borough string, Zone string, service_zone string")
EVENT = struct(
    "event_id string, trip_key string, event_time timestamp, schema_version int, source string, pickup_borough string, "
    "fare_amount double, total_amount double, trip_distance_mi double, producer_timestamp timestamp"
)
