import datetime as dt
import json
import os

import pytest
from fixtures import bronze, zones
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.governance.control import ControlPlane
from tessera.operators import enrich
from tessera.sources import readers
from tessera.streaming import events, versions, windows
from tessera.streaming.job import CheckpointInUse, StreamJob, late_rows


def event(minute, n=0, borough="North", **more):
    row = {"event_id": f"e{minute}-{n}", "trip_key": "k", "event_time": f"2024-01-01T08:{minute:02d}:00.000Z", "schema_version": 1, "source": "yellow",
           "pickup_borough": borough, "fare_amount": 10.0, "total_amount": 12.5, "trip_distance_mi": 2.0}
    return json.dumps({k: v for k, v in (row | more).items() if v is not None})


def test_reasons(spark):
    cases = [
        ("{broken", "unparseable"), ("{}", "unparseable"), (event(1, event_id=""), "missing_event_id"), (event(1, trip_key=None), "missing_trip_key"),
        (event(1, event_time="soon"), "missing_event_time"), (event(1, schema_version=2), "unknown_schema_version"), (event(1, source="Yellow"), "unknown_source"),
        (event(1, fare_amount=None), "missing_amount"), (event(1), None), (event(1, pickup_borough=None), None),
    ]
    got = events.classify(events.parse(spark.createDataFrame([(v,) for v, _ in cases], "value string").coalesce(1))).collect()
    assert [r.reject_reason for r in got] == [reason for _, reason in cases]


def test_produced_events_are_valid(spark):
    silver = enrich.silver(bronze(spark), zones(spark)).withColumn("pickup_borough", F.lit(None).cast("string"))
    back = events.valid(events.parse(events.produce(silver)))
    assert back.count() == silver.count() and {r.pickup_borough for r in back.collect()} == {"Unknown"}


def test_window_borders(spark):
    rows = events.parse(spark.createDataFrame([(event(4, event_time="2024-01-01T08:04:59.999Z"),), (event(5),)], "value string"))
    got = sorted((r.window_start.minute, r.window_end.minute, r.trip_count) for r in windows.aggregate(rows, None).collect())
    assert got == [(0, 5, 1), (5, 10, 1)]


@given(st.integers(1, versions.MAX_EPOCH), st.integers(0, versions.MAX_BATCH))
def test_versions_round_trip(epoch, batch):
    v = versions.pack(epoch, batch)
    assert versions.unpack(v) == (epoch, batch) and 0 < v < 1 << 63


@given(st.tuples(st.integers(1, 50), st.integers(0, 50)), st.tuples(st.integers(1, 50), st.integers(0, 50)))
def test_versions_order_as_pairs(a, b):
    assert versions.supersedes(versions.pack(*a), versions.pack(*b)) == (a > b)


def test_version_bounds():
    for bad in ((0, 0), (1 << 31, 0), (1, -1), (1, 1 << 32)):
        with pytest.raises(ValueError):
            versions.pack(*bad)


class Stream:
    """Files that arrive one after the other, and a job over them."""

    def __init__(self, spark, path, **more):
        self.spark, self.path, self.n, self.more = spark, path, 0, more
        (path / "in").mkdir()
        self.control = ControlPlane(str(path / "c.db"))

    def add(self, *lines):
        file = self.path / "in" / f"{self.n:03d}.json"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.n,) * 2)  # files are read by age, and ties in any order
        self.n += 1

    def drain(self, files=1):
        job = StreamJob(self.control, str(self.path / "out"), str(self.path / "check"), **self.more)
        q = job.start(readers.stream_text(self.spark, str(self.path / "in"), files))
        q.awaitTermination(120)
        return q

    def state(self):
        rows = windows.current(self.spark, str(self.path / "out")).collect()
        return {(r.window_start.minute, r.pickup_borough): (r.trip_count, float(r.total_revenue)) for r in rows}


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    s = Stream(spark, tmp_path)
    lines = [event(m, n, b) for m in (1, 3, 6, 8, 12) for n in range(3) for b in ("North", "South")] + ["{broken"]
    for i in range(0, 12, 6):
        s.add(*lines[i : i + 6])
    s.drain()
    for i in range(12, len(lines), 6):  # after a stop, the same checkpoint goes on
        s.add(*lines[i : i + 6])
    s.drain()
    batch = windows.aggregate(events.valid(events.parse(spark.createDataFrame([(x,) for x in lines], "value string"))), None).collect()
    assert s.state() == {(r.window_start.minute, r.pickup_borough): (r.trip_count, float(r.total_revenue)) for r in batch}
    assert s.control.rows("SELECT count(*) FROM stream_epoch")[0][0] == 1


def test_late_events_are_dropped_and_early_enough_ones_count(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.add(event(20), event(30))  # the watermark becomes 08:20
    s.add(event(22, n=1))  # its window ends after the watermark: counts
    s.add(event(16, n=1))  # its window ends at 08:20: dropped
    q = s.drain()
    assert s.state() == {(20, "North"): (2, 25.0), (30, "North"): (1, 12.5)}
    assert late_rows(q) == 1


def test_amounts_that_are_no_amounts_dont_stop_the_stream(spark, tmp_path):
    s = Stream(spark, tmp_path)
    wild = [float("nan"), float("inf"), 1e14, -1e300, 1e9 + 1]
    s.add(event(1), *[event(2, n=i, total_amount=x) for i, x in enumerate(wild)], *[event(3, n=i, fare_amount=x) for i, x in enumerate(wild)])
    s.add(*[event(4, n=i, trip_distance_mi=x) for i, x in enumerate([*wild, 1e13])])
    s.drain()
    assert s.state() == {(0, "North"): (7, 87.5)}
    found = windows.current(spark, str(tmp_path / "out")).first()
    assert float(found.avg_fare) == 10.0 and found.avg_distance_mi < 2e9
    parsed = events.parse(spark.createDataFrame([(event(1, total_amount=x),) for x in wild], "value string"))
    assert {r.reject_reason for r in events.classify(parsed).collect()} == {"amount_out_of_range"}
    raw = spark.createDataFrame([(dt.datetime(2024, 1, 1), "n", x, x, x) for x in wild], "event_time timestamp, pickup_borough string, total_amount double, fare_amount double, trip_distance_mi double")
    assert windows.aggregate(raw, None).first().trip_count == 5


def test_a_second_query_on_a_checkpoint_is_refused(spark, tmp_path):
    s = Stream(spark, tmp_path, once=False)
    s.add(event(1))
    job = StreamJob(s.control, str(tmp_path / "out"), str(tmp_path / "check"), once=False, trigger_seconds=1)
    q = job.start(readers.stream_text(spark, str(tmp_path / "in")))
    try:
        with pytest.raises(CheckpointInUse, match="check"):
            job.start(readers.stream_text(spark, str(tmp_path / "in")))
    finally:
        q.stop()
    job.start(readers.stream_text(spark, str(tmp_path / "in"))).stop()


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = windows.aggregate(events.parse(spark.createDataFrame([(event(1),), (event(2),)], "value string")), None)
    out = str(tmp_path / "out")
    for _ in range(2):
        windows.write_version(rows, out, 1, 0, "q")
    assert spark.read.parquet(out).count() == 1
    windows.write_version(rows.withColumn("trip_count", F.lit(9).cast("bigint")), out, 1, 1, "q")
    got = windows.current(spark, out).first()
    assert (got.trip_count, got.batch_id, got.stream_epoch, got.version) == (9, 1, 1, versions.pack(1, 1))


def test_republished_events_count_once_if_asked(spark, tmp_path):
    s = Stream(spark, tmp_path, deduplicate=True)
    s.add(event(1), event(2))
    s.add(event(1), event(2), event(3))
    s.drain()
    assert s.state() == {(0, "North"): (3, 37.5)}


def test_retention(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 30),)], "t timestamp")
    assert windows.retained(df, "t", 10, dt.datetime(2024, 2, 1)).count() == 1
