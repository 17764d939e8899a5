"""Hand-made trips: one of each case, with their outcome."""

from __future__ import annotations

import datetime as dt

from tessera.sources.schemas import BRONZE, ZONE

T = dt.datetime


def trip(source="yellow", vendor=1, start=T(2024, 3, 4, 8, 0), end=T(2024, 3, 4, 8, 20), people=1, miles=4.0, code=1, fare=20.0, tip=4.0, total=27.5, places=(1, 2), **more):
    row = {f.name: None for f in BRONZE.fields} | {
        "source": source, "vendor_id": vendor, "pickup_ts": start, "dropoff_ts": end, "passenger_count": people, "trip_distance_mi": miles,
        "pickup_location_id": places[0], "dropoff_location_id": places[1], "payment_type_code": code, "fare_amount": fare, "tip_amount": tip, "total_amount": total,
    }
    return tuple((row | more)[f.name] for f in BRONZE.fields)


GOOD = [
    trip(),
    trip(code=2, tip=0.0, total=20.0, start=T(2024, 3, 4, 23, 50), end=T(2024, 3, 5, 0, 10)),  # past midnight
    trip(miles=None, total=30.0),  # a null distance passes
    trip(people=None, vendor=2, fare=0.0, tip=5.0, total=8.0),  # no tip share
    trip(source="green", places=(2, 99), code=None),  # unknown zone and payment
]
REPEATED = [trip(people=3), trip(tip=1.0)]  # the same key as the first; lose to it
BAD = [
    (trip(end=None), "null_timestamp"),
    (trip(end=T(2024, 3, 4, 7, 59)), "dropoff_not_after_pickup"),
    (trip(fare=None, total=-1.0), "null_amount"),
    (trip(fare=-3.0), "negative_fare"),
    (trip(total=10000.5), "fare_out_of_range"),
    (trip(fare=float("nan")), "fare_out_of_range"),
    (trip(end=T(2024, 3, 4, 8, 0, 29)), "duration_out_of_range"),
    (trip(miles=300.5), "distance_out_of_range"),
]
ZONES = [(1, "North", "Hill", "Boro"), (2, "South", "Pier", "Boro"), (3, "East", "Mill", "Air")]


def bronze(spark):
    return spark.createDataFrame(GOOD + REPEATED + [r for r, _ in BAD], BRONZE)


def zones(spark):
    return spark.createDataFrame(ZONES, ZONE)
