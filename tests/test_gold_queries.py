"""Gold queries against their SQL, on trips whose averages lie where rounding to four places first cuts to another hundredth."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import gold
from tessera.plans import trips

#: 34 / 83 = 0.409638..., which CUT raises over 0.41; rounded to 0.4096 first, it stays below.
N, REST = 83, 34


def to_rest(total):
    return (REST - total) % N


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """N trips of a day, vendor and pair of places, whose average minutes and fares end in REST / N."""
    d = str(tmp_path_factory.mktemp("tables"))
    quantities = [3 + i % 40 for i in range(N)]
    for i in range(to_rest(sum(quantities))):
        quantities[i] += 1
    numbers = list(range(1, N + 1))
    numbers[-1] += to_rest(sum(q * 210 for q in quantities) + sum(numbers))
    lines = [(1, 5, 7, n, float(q)) for q, n in zip(quantities, numbers, strict=True)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{d}/lineitem.parquet")
    orders = spark.createDataFrame([(1, "F", "1996-01-02")], "o_orderkey long, o_orderstatus string, day string")
    orders.select("o_orderkey", "o_orderstatus", F.col("day").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(5, "ETHIOPIA", 0), (7, "GERMANY", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{d}/nation.parquet")
    spark.createDataFrame([(0, "AFRICA"), (1, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{d}/region.parquet")
    return d


@pytest.mark.parametrize("name", ["gold_serving_kpi", "gold_zone_hourly", "gold_borough_od", "gold_daily_kpi"])
def test_averages_are_cut_as_in_sql(spark, tables, name):
    con = pytest.importorskip("duckdb").connect()
    for t in ("lineitem", "orders", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    q = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in q.description]
    (want,) = (dict(zip(names, r, strict=True)) for r in q.fetchall())
    (got,) = (r.asDict() for r in entry.queries()[name](spark, tables).collect())
    assert got == want and got["trip_count"] == N


def test_averages_are_rounded_unless_asked_for_whole(spark, tables):
    rows = trips.silver(spark, tables)
    whole, rounded = gold.build(rows, places=None), gold.build(rows)
    for name in ("zone_hourly", "borough_od", "daily_kpi"):
        a, b = whole[name].first().avg_duration_min, rounded[name].first().avg_duration_min
        assert a % 1 == pytest.approx(REST / N, abs=1e-9) and b == round(a, 4) != a
    serving = [gold.serving_kpi(df["daily_kpi"], rounded=df is rounded).first().avg_fare for df in (whole, rounded)]
    assert serving[0] % 1 == pytest.approx(REST / N, abs=1e-9) and serving[1] == round(serving[0], 4) != serving[0]
