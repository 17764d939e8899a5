import hashlib

import pytest
from fixtures import BAD, GOOD, bronze, trip, zones
from pyspark.sql import functions as F

from tessera.functions import keys
from tessera.functions.measures import money
from tessera.operators import content_hash, dedup, enrich, gold, percentiles, rejects, sinks
from tessera.plans import registry
from tessera.sources import conform, readers
from tessera.sources.schemas import BRONZE, SILVER, struct


@pytest.fixture(scope="module")
def silver(spark):
    return enrich.silver(bronze(spark), zones(spark)).cache()


def test_reasons_in_order(spark):
    got = [r["reason"] for r in spark.createDataFrame([r for r, _ in BAD], BRONZE).select(rejects.first_reason(rejects.trip_reasons()).alias("reason")).collect()]
    assert got == [reason for _, reason in BAD]


def test_silver_rows_and_columns(silver):
    assert silver.schema.simpleString() == SILVER.simpleString()
    rows = silver.collect()
    assert len(rows) == len(GOOD)
    first = next(r for r in rows if r.total_amount == 27.5 and r.source == "yellow")
    assert (first.passenger_count, first.tip_amount, first.pickup_borough, first.dropoff_zone, first.payment_type) == (1, 4.0, "North", "Pier", "credit_card")
    assert first.trip_duration_min == 20.0 and first.avg_speed_mph == pytest.approx(12.0) and first.tip_pct == pytest.approx(0.2)
    lost = next(r for r in rows if r.source == "green")
    assert (lost.dropoff_zone, lost.payment_type) == ("Unknown", "unknown")
    assert next(r for r in rows if r.fare_amount == 0).tip_pct is None


def test_rejected_listing(spark):
    got = rejects.rejected(bronze(spark), rejects.trip_reasons(), "source").collect()
    assert sorted(r.reason for r in got) == sorted(reason for _, reason in BAD)


def test_key_is_a_digest_of_tagged_fields(spark):
    df = spark.createDataFrame([trip(source=" Yellow ", total=27.505, miles=None)], BRONZE)
    text = "source=6:yellow;vendor_id=1:1;pickup_ts=23:2024-03-04T08:00:00.000;dropoff_ts=23:2024-03-04T08:20:00.000;pickup_location_id=1:1;dropoff_location_id=1:2;trip_distance=-1:;total_amount=5:27.51;"
    assert df.select(keys.trip_key().alias("k")).first().k == hashlib.sha256(text.encode()).hexdigest()


def test_key_survives_overflow(spark):
    df = spark.createDataFrame([trip(total=1e30)], BRONZE)
    assert len(df.select(keys.trip_key().alias("k")).first().k) == 64


def test_dimension_keys_must_be_unique(spark):
    twice = zones(spark).unionByName(zones(spark))
    with pytest.raises(ValueError, match="repeats"):
        enrich.silver(bronze(spark), twice)


def test_gold_aggregates_add_up(silver):
    frames = gold.build(silver)
    found = gold.reconcile(silver, frames)
    assert set(found) == {"silver", "zone_hourly", "borough_od", "payment_daily", "daily_kpi"}
    assert {n for n, _ in found.values()} == {len(GOOD)}
    shares = frames["payment_daily"].groupBy("pickup_date", "source").agg(F.sum("revenue_share").alias("s")).collect()
    assert all(float(r.s) == pytest.approx(1, abs=1e-5) for r in shares)
    wrong = frames | {"zone_hourly": frames["zone_hourly"].limit(1)}
    with pytest.raises(gold.ReconciliationError, match="zone_hourly"):
        gold.reconcile(silver, wrong)


def test_averages_skip_nulls(silver):
    rows = gold.build(silver)["daily_kpi"].where("source = 'yellow'").collect()
    by = {r.vendor_id: r for r in rows}
    assert by[2].avg_tip_pct is None and by[1].avg_distance_mi == 4.0


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 0.0)], "k string, total_amount double").withColumns({"pickup_date": F.lit("d"), "source": F.lit("s")})
    out = gold.Aggregate(("pickup_date", "source", "k"), {"total_revenue": F.sum("total_amount")}, ("pickup_date", "source")).over(df)
    assert out.first().revenue_share is None


def test_serving_averages_are_unweighted(silver):
    out = gold.serving_kpi(gold.build(silver)["daily_kpi"]).where("vendor_name = 'yellow'").first()
    assert out.trip_count == 4 and out.avg_fare == pytest.approx((20.0 + 0.0) / 2)


def test_workload_reads_a_range(silver, spark):
    out = gold.workload(silver, zones(spark))
    assert out.agg(F.sum("trip_count")).first()[0] == len(GOOD)
    assert gold.workload(silver, zones(spark), (2020, 2021)).count() == 0


def test_conform_missing_and_case(spark):
    raw = spark.createDataFrame([(1, 2.5, 1.0)], "VendorID int, fare_amount double, airport_fee double")
    row = conform.conform(raw, "YELLOW").first()
    assert (row.source, row.vendor_id, row.fare_amount, row.airport_fee, row.trip_type) == ("yellow", 1, 2.5, None, None)
    with pytest.raises(ValueError, match="unknown source"):
        conform.conform(raw, "blue")
    assert conform.union(conform.conform(raw, "yellow"), conform.conform(raw, "green")).count() == 2


def test_malformed_values_become_null_and_are_counted(spark):
    raw = spark.createDataFrame([("1", "x", "2024-03-04 08:00:00", "1e400"), ("?", "2.5", "never", None), ("99999999999", None, "", "NaN")], "VendorID string, fare_amount string, tpep_pickup_datetime string, total_amount string")
    rows = conform.conform(raw, "yellow").collect()
    assert [r.vendor_id for r in rows] == [1, None, None] and [r.fare_amount for r in rows] == [None, 2.5, None]
    assert [r.pickup_ts is None for r in rows] == [False, True, True]
    lost = conform.malformed(raw, "yellow").first()
    assert (lost.vendor_id, lost.fare_amount, lost.pickup_ts) == (2, 1, 2)
    assert enrich.silver(conform.conform(raw, "yellow"), zones(spark)).count() == 0


def test_money_of_wild_values(spark):
    for values, want in (([1.005, float("nan"), None, float("inf"), 1e15, -2.0], -0.995), ([float("nan")], None), ([9e12] * 3, 27e12)):
        got = spark.createDataFrame([(v,) for v in values], "v double").agg(money("v")).first()[0]
        assert (got is None) == (want is None) and (want is None or abs(float(got) - want) < 0.011)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentiles_equal_the_built_in(spark, monkeypatch, p):
    import random

    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.random() * 100, 7.0, float(rng.randint(0, 3)), None])) for _ in range(4000)] + [("one", 3.5), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    for accuracy in (50, 10_000):  # a narrow and a wide band
        monkeypatch.setattr(percentiles, "ACCURACY", accuracy)
        got = {r.k: r.x for r in percentiles.exact_percentile(df, ["k"], "v", p, "x").collect()}
        want = {r.k: r.x for r in df.groupBy("k").agg(F.percentile("v", p).alias("x")).collect() if r.x is not None}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_exists_with_null_prices(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,), (4,)], "c_custkey int")
    orders = spark.createDataFrame([(1, "1-URGENT", None), (2, None, 500_000.0), (2, "x", None), (3, None, 10.0)], "o_custkey int, o_orderpriority string, o_totalprice double")
    assert sorted(map(tuple, registry.kept_customers(customers, orders).collect())) == [(1, True), (3, False)]


def test_large_dimensions_are_not_broadcast(spark, monkeypatch):
    dim = spark.range(200).select(F.col("id").alias("k"), F.lit("x" * 50).alias("v"))
    facts = spark.range(5).withColumnRenamed("id", "f")
    plan = lambda: enrich.lookup(facts, dim, "f", "k", {"v2": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr(enrich, "DIMENSION_ROWS", 100)
    assert "broadcast" not in plan()
    monkeypatch.setattr(enrich, "DIMENSION_ROWS", 1000)
    monkeypatch.setattr(enrich, "DIMENSION_BYTES", 1000)
    assert "broadcast" not in plan()


def test_csv_and_parquet_readers(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough\n1,North\n2,\n")
    assert readers.csv(spark, str(tmp_path / "z.csv")).dtypes[0] == ("LocationID", "int")
    rows = readers.csv(spark, str(tmp_path / "z.csv"), struct("LocationID int, Borough string")).collect()
    assert [tuple(r) for r in rows] == [(1, "North"), (2, None)]
    for n in "ab":
        spark.range(3).write.parquet(str(tmp_path / n))
    assert readers.parquet(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 6
    lines = spark.createDataFrame([('{"x": 1}',), ("broken",)], "v string")
    assert [r.x for r in readers.json_strings(lines, "v", struct("x int")).collect()] == [1, None]


def test_dedup_is_the_same_for_any_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), (F.col("id") % 7).alias("v"), (F.col("id") % 11).alias("w"))
    once = sorted(map(tuple, dedup.keep_first(df.repartition(3), ["k"], [F.desc("v")]).collect()))
    again = sorted(map(tuple, dedup.keep_first(df.repartition(7, "w"), ["k"], [F.desc("v")]).collect()))
    assert once == again and len(once) == 50


def test_content_hash(spark):
    h = lambda rows, s="a string, b string": content_hash.content_hash(spark.createDataFrame(rows, s))
    assert h([("x", "y"), ("z", None)]) == h([("z", None), ("x", "y")])
    assert h([(None, "a")]) != h([("a", None)])
    assert h([("ab", "c")]) != h([("a", "bc")])
    d = spark.createDataFrame([(1.5,)], "a double")
    assert content_hash.content_hash(d.select(d.a.cast("decimal(10,1)").alias("a"))) == content_hash.content_hash(d.select(d.a.cast("decimal(10,4)").alias("a")))
    assert h([]).rows == 0


def test_content_hash_against_brute_force(spark):
    xxhash = pytest.importorskip("xxhash")
    rows = [("é", 5, 1.5, None), (None, -7, None, "x"), ("a|b", None, 1e300, "")]
    df = spark.createDataFrame(rows, "s string, b int, d double, c string")
    hashes = []
    for s, b, d, c in rows:
        fields = [None if b is None else str(b), c, None if d is None else f"{d:.9e}", s]  # by column name
        text = "|".join("-" if f is None else f"{len(f)}:{f}" for f in fields)
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        hashes.append(h - (1 << 64) if h >> 63 else h)
    mixed = 0
    for h in hashes:
        mixed ^= h
    assert content_hash.content_hash(df) == content_hash.ContentHash(3, str(sum(hashes)), mixed)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(ValueError, match="missing columns: w, x"):
        sinks.aligned(df, ["k", "w", "x"])
    assert sinks.aligned(df, ["v", "k", "loaded_at"]).columns == ["v", "k", "loaded_at"]
    folder = str(tmp_path / "t")
    sinks.write_run(df, folder, "r1")
    sinks.write_run(df, folder, "r2")
    sinks.write_run(df.limit(1), folder, "r1")
    assert spark.read.parquet(folder).count() == 3
    assert sinks.delete_run(spark, folder, "r2") and spark.read.parquet(folder).count() == 1
    new = spark.createDataFrame([(2, "c"), (None, "n")], "k int, v string")
    assert sorted(map(str, (tuple(r) for r in sinks.upserted(df, new, ["k"]).collect()))) == ["(1, 'a')", "(2, 'c')", "(None, 'n')"]
    spark.sql("CREATE TABLE sink_target (v STRING, k INT, loaded_at TIMESTAMP) USING parquet")
    sinks.append(df, "sink_target")
    assert spark.table("sink_target").count() == 2
    spark.sql("DROP TABLE sink_target")
