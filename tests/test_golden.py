"""A small set of trips through all layers, held against expectations worked out by hand and by plain Python.

Twelve yellow trips of one month, three of another year and four green ones; four are
rejected, one repeats another, so fourteen reach silver.
"""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from fixtures import T, trip
from pyspark.sql import functions as F

from tessera.operators import enrich, gold, rejects
from tessera.sources.schemas import BRONZE, ZONE

ZONES = [(1, "Harbour", "Quay", "Inner"), (2, "Hills", "Ridge", "Outer"), (3, "Field", "Runway", "Air")]


def at(day, hour, minute=0, month=1, year=2024):
    return T(year, month, day, hour, minute)


def ride(day, hour, vendor, places, code, fare, tip, total, source="yellow", minutes=20, **more):
    start = at(day, hour, **{k: more.pop(k) for k in ("minute", "month", "year") if k in more})
    return trip(source=source, vendor=vendor, start=start, end=start + dt.timedelta(minutes=minutes), code=code, fare=fare, tip=tip, total=total, places=places, **more)


YELLOW = [
    ride(15, 8, 1, (1, 2), 1, 20.0, 4.0, 27.5),
    ride(15, 9, 2, (1, 3), 1, 50.0, 10.0, 66.25),
    ride(15, 10, 1, (2, 1), 2, 15.0, 0.0, 18.8),
    ride(16, 7, 1, (1, 1), 1, 8.0, 1.6, 12.1),
    ride(16, 23, 2, (3, 2), 2, 52.0, 0.0, 58.55, minutes=45),  # ends on the next day
    ride(17, 12, 1, (1, 2), 1, 10.0, 2.0, 15.0),
    ride(17, 13, 1, (1, 3), 1, 0.0, 5.0, 9.0),  # no fare, so no tip share: skipped in the day's average
    ride(17, 14, 2, (2, 9), 2, 0.0, 0.0, 6.4),  # an unknown zone; the vendor's only trip has no tip share
]
REPEAT = ride(17, 12, 1, (1, 2), 1, 10.0, 1.0, 15.0)  # the key of the trip at 12 o'clock, with a lower tip
REJECTED = [
    (ride(18, 9, 1, (1, 2), 1, -5.0, 0.0, 5.0), "negative_fare"),
    (ride(18, 10, 1, (1, 2), 1, 5.0, 0.0, 5.0, minutes=-3), "dropoff_not_after_pickup"),
    (ride(18, 11, 1, (1, 2), 1, 5.0, 0.0, 5.0, miles=301.0), "distance_out_of_range"),
]
LATER = [
    ride(3, 6, 1, (1, 2), 1, 30.0, 6.0, 40.0, year=2025),
    ride(3, 7, 2, (1, 3), 3, 70.0, 0.0, 80.0, year=2025),
    ride(4, 6, 2, (2, 2), 1, 12.0, 2.5, 18.0, year=2025),
]
GREEN = [
    ride(15, 8, 1, (2, 1), 1, 25.0, 5.0, 33.5, "green"),
    ride(15, 20, 2, (2, 1), 2, 40.0, 0.0, 44.0, "green"),
    ride(16, 20, 2, (3, 3), None, 60.0, 30.0, 96.0, "green"),
]
NO_END = trip(source="green", start=at(19, 9), end=None)
KEPT = [*YELLOW, *LATER, *GREEN]


@pytest.fixture(scope="module")
def layers(spark):
    rows = [*YELLOW, REPEAT, *[r for r, _ in REJECTED], *LATER, *GREEN, NO_END]
    bronze = spark.createDataFrame(rows, BRONZE)
    silver = enrich.silver(bronze, spark.createDataFrame(ZONES, ZONE)).cache()
    return bronze, silver, {n: df.collect() for n, df in gold.build(silver).items()}


def test_counts_and_revenue(layers):
    bronze, silver, frames = layers
    assert bronze.groupBy("source").count().orderBy("source").collect() == [("green", 4), ("yellow", 15)]
    lost = rejects.rejected(bronze, rejects.trip_reasons(), "source", "pickup_ts").collect()
    assert sorted(r.reason for r in lost) == ["distance_out_of_range", "dropoff_not_after_pickup", "negative_fare", "null_timestamp"]
    assert silver.count() == 14 and silver.agg(gold.money("total_amount")).first()[0] == Decimal("525.10")
    assert {n: len(rows) for n, rows in frames.items()} == {"zone_hourly": 14, "borough_od": 12, "payment_daily": 12, "daily_kpi": 12}
    assert all(sum(r.trip_count for r in rows) == 14 and sum(r.total_revenue for r in rows) == Decimal("525.10") for rows in frames.values())


def test_the_repeat_with_the_lower_tip_goes(layers):
    _, silver, _ = layers
    assert [r.tip_amount for r in silver.where("pickup_ts = timestamp'2024-01-17 12:00:00'").collect()] == [2.0]


def test_averages_skip_what_has_no_tip_share(layers):
    *_, frames = layers
    card = next(r for r in frames["payment_daily"] if str(r.pickup_date) == "2024-01-17" and r.payment_type == "credit_card")
    assert card.trip_count == 2 and card.avg_tip_pct == pytest.approx(0.2)
    vendor = next(r for r in frames["daily_kpi"] if (str(r.pickup_date), r.source, r.vendor_id) == ("2024-01-17", "yellow", 2))
    assert vendor.trip_count == 1 and vendor.avg_tip_pct is None and vendor.avg_speed_mph is not None


def test_shares_of_a_day_sum_to_one(layers):
    sums = defaultdict(Decimal)
    for r in layers[2]["payment_daily"]:
        sums[r.pickup_date, r.source] += r.revenue_share
    assert sums and all(abs(s - 1) < Decimal("0.000002") for s in sums.values())


def plain_silver():
    """The fourteen trips as dictionaries, by the definitions of the columns."""
    place = {z[0]: z for z in ZONES}
    labels = {1: "credit_card", 2: "cash", 3: "no_charge"}
    out = []
    for r in KEPT:
        v = dict(zip([f.name for f in BRONZE.fields], r, strict=True))
        took = (v["dropoff_ts"] - v["pickup_ts"]).total_seconds() / 60
        v |= {
            "trip_duration_min": took, "avg_speed_mph": v["trip_distance_mi"] / (took / 60), "tip_pct": v["tip_amount"] / v["fare_amount"] if v["fare_amount"] else None,
            "payment_type": labels.get(v["payment_type_code"], "unknown"), "pickup_date": v["pickup_ts"].date(), "pickup_hour": v["pickup_ts"].hour,
        }
        for role in ("pickup", "dropoff"):
            z = place.get(v[f"{role}_location_id"], (None, "Unknown", "Unknown", None))
            v |= {f"{role}_borough": z[1], f"{role}_zone": z[2]}
        out.append(v)
    return out


def test_silver_row_by_row(layers):
    names = [n for n in ("source", "vendor_id", "pickup_ts", "payment_type", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", "fare_amount", "total_amount")]
    got = sorted(tuple(r[n] for n in names) for r in layers[1].collect())
    assert got == sorted(tuple(v[n] for n in names) for v in plain_silver())
    by = {(r.source, r.pickup_ts, r.vendor_id): r for r in layers[1].collect()}
    for v in plain_silver():
        r = by[v["source"], v["pickup_ts"], v["vendor_id"]]
        for n in ("trip_duration_min", "avg_speed_mph", "tip_pct"):
            assert r[n] == (None if v[n] is None else pytest.approx(v[n]))
    assert len({r.trip_key for r in by.values()}) == 14


SOURCES = {"avg_fare": "fare_amount", "avg_distance_mi": "trip_distance_mi", "avg_duration_min": "trip_duration_min", "avg_speed_mph": "avg_speed_mph", "avg_tip_pct": "tip_pct"}


@pytest.mark.parametrize("name", ["zone_hourly", "borough_od", "payment_daily", "daily_kpi"])
def test_each_aggregate_row_by_row(layers, name):
    keys, groups = gold.aggregates()[name].keys, defaultdict(list)
    for v in plain_silver():
        groups[tuple(v[k] for k in keys)].append(v)
    rows = {tuple(r[k] for k in keys): r for r in layers[2][name]}
    assert rows.keys() == groups.keys()
    for k, members in groups.items():
        r = rows[k]
        total = sum(Decimal(str(v["total_amount"])) for v in members)
        assert r.trip_count == len(members) and r.total_revenue == total.quantize(Decimal("0.01"), ROUND_HALF_UP)
        for n, column in SOURCES.items():
            if n in r.asDict():
                known = [v[column] for v in members if v[column] is not None]
                assert r[n] == (pytest.approx(sum(known) / len(known), abs=5.1e-5) if known else None), (k, n)


def test_the_fact_and_the_serving_table(layers):
    _, silver, frames = layers
    fact = gold.fact(silver, "r1")
    assert fact.where(F.col("etl_run_id") == "r1").count() == 14 and "pickup_hour" not in fact.columns
    kpi = {(str(r.kpi_date), r.vendor_name): r for r in gold.serving_kpi(gold.build(silver)["daily_kpi"]).collect()}
    day = [r for r in frames["daily_kpi"] if (str(r.pickup_date), r.source) == ("2024-01-15", "yellow")]
    assert len(day) == 2 and kpi["2024-01-15", "yellow"].avg_fare == pytest.approx(sum(r.avg_fare for r in day) / 2)  # not weighted by trips
    assert kpi["2024-01-15", "yellow"].trip_count == 3
