"""Every query of the engine proper over the star-schema tables, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import keys
from tessera.functions.measures import average as rounded
from tessera.functions.measures import money, share
from tessera.operators import content_hash, dedup, enrich, quality_rules, rejects, sinks
from tessera.operators.percentiles import exact_percentile
from tessera.operators.quality_rules import Rule
from tessera.session import table
from tessera.sources import conform, readers
from tessera.sources.schemas import struct
from tessera.streaming import events as stream_events
from tessera.streaming import versions, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "regional_daily"


def query(sql: str | None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def average(column: str, places: int = 8):
    """Averages of cents with more places than cents have ties in, so that sums in any order agree."""
    return rounded(column, places)


def days(column: str):
    """The date as text, which has one form in every engine."""
    return F.to_date(column).cast("string")


@query("""
SELECT CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS day, coalesce(r.r_name, 'Unknown') AS region, count(*) AS n,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue, round(avg(o.o_totalprice), 8) AS avg_price, round(avg(c.c_acctbal), 8) AS avg_balance
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY 1, 2""")
def regional_daily(spark, d):
    """Hourly-zone analogue: facts enriched through a chain of dimensions, then grouped by day and place."""
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    customers = table(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_acctbal", "r_name")
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy(days("o_orderdate").alias("day"), F.coalesce("r_name", F.lit("Unknown")).alias("region")).agg(
        F.count("*").alias("n"), money("o_totalprice").alias("revenue"), average("o_totalprice").alias("avg_price"), average("c_acctbal").alias("avg_balance")
    )


@query("""
WITH s AS (SELECT s_suppkey, r_name AS from_region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_custkey, r_name AS to_region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT from_region, to_region, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue, round(avg(l_quantity), 8) AS avg_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN s ON l_suppkey = s_suppkey JOIN c ON o_custkey = c_custkey GROUP BY 1, 2""")
def origin_destination(spark, d):
    """Role-playing dimension: the same regions for supplier and customer of each line."""
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    suppliers = table(spark, d, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("r_name").alias("from_region"))
    customers = table(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("r_name").alias("to_region"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rows = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("from_region", "to_region").agg(F.count("*").alias("n"), money("l_extendedprice").alias("revenue"), average("l_quantity").alias("avg_quantity"))


@query("""
WITH g AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue FROM orders GROUP BY 1, 2)
SELECT *, round(CAST(revenue AS DOUBLE) / nullif(CAST(sum(revenue) OVER (PARTITION BY day) AS DOUBLE), 0), 6) AS revenue_share FROM g""")
def daily_share(spark, d):
    """Share of a partition's total by a window over the aggregate, not by a self-join."""
    g = table(spark, d, "orders").groupBy(days("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), money("o_totalprice").alias("revenue"))
    whole = F.sum("revenue").over(Window.partitionBy("day")).cast("double")
    return g.withColumn("revenue_share", share(F.col("revenue").cast("double"), whole))


@query("""
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue,
       round(avg(l_quantity), 8) AS avg_quantity, round(avg(l_extendedprice), 8) AS avg_price, round(avg(l_discount), 8) AS avg_discount, round(avg(l_tax), 8) AS avg_tax
FROM lineitem GROUP BY 1, 2, 3""")
def daily_kpi(spark, d):
    """Counts, revenue and averages in one partial and one final aggregation."""
    return table(spark, d, "lineitem").groupBy(days("l_shipdate").alias("day"), "l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), money("l_extendedprice").alias("revenue"),
        average("l_quantity").alias("avg_quantity"), average("l_extendedprice").alias("avg_price"), average("l_discount").alias("avg_discount"), average("l_tax").alias("avg_tax"),
    )


LINE_REASONS_SQL = """CASE WHEN l_shipdate IS NULL OR o_orderdate IS NULL THEN 'null_timestamp' WHEN l_shipdate <= o_orderdate THEN 'ship_not_after_order'
 WHEN l_quantity IS NULL THEN 'null_quantity' WHEN l_quantity > 45 THEN 'quantity_out_of_range' WHEN l_discount > 0.08 THEN 'discount_out_of_range' END"""


def line_reasons() -> rejects.Reasons:
    c = F.col
    return (
        ("null_timestamp", c("l_shipdate").isNull() | c("o_orderdate").isNull()),
        ("ship_not_after_order", c("l_shipdate") <= c("o_orderdate")),
        ("null_quantity", c("l_quantity").isNull()),
        ("quantity_out_of_range", c("l_quantity") > 45),
        ("discount_out_of_range", c("l_discount") > 0.08),
    )


def lines_with_orders(spark, d) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_discount", "l_extendedprice")
    return lines.join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))


@query(f"""
SELECT l_orderkey, l_linenumber, l_shipdate, reason FROM
 (SELECT l_orderkey, l_linenumber, l_shipdate, {LINE_REASONS_SQL} AS reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE reason IS NOT NULL""")
def reject_listing(spark, d):
    """Rejected rows with the first reason that holds."""
    return rejects.rejected(lines_with_orders(spark, d), line_reasons(), "l_orderkey", "l_linenumber", "l_shipdate")


@query(f"""
SELECT count(*) AS kept, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue FROM
 (SELECT *, {LINE_REASONS_SQL} AS reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE reason IS NULL""")
def valid_totals(spark, d):
    """What is left when rejected rows are filtered out."""
    return rejects.valid(lines_with_orders(spark, d), line_reasons()).agg(F.count("*").alias("kept"), money("l_extendedprice").alias("revenue"))


@query("""
SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_extendedprice DESC NULLS LAST, l_quantity DESC NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST, l_discount NULLS LAST,
  l_tax NULLS LAST, l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS place FROM lineitem) WHERE place = 1""")
def dedup_lines(spark, d):
    """Deterministic deduplication by an ordering that all columns complete."""
    return dedup.keep_first(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_extendedprice").desc_nulls_last(), F.col("l_quantity").desc_nulls_last()])


def _field_sql(name: str, value: str) -> str:
    return f"coalesce('{name}=' || length({value}) || ':' || {value} || ';', '{name}=-1:;')"


@query(f"""
SELECT o_orderkey, sha256({_field_sql('status', "nullif(lower(trim(o_orderstatus)), '')")} || {_field_sql('customer', 'CAST(o_custkey AS VARCHAR)')} ||
  {_field_sql('day', "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g')")} || {_field_sql('price', "CAST(CAST(round(CAST(o_totalprice AS DECIMAL(12,4)), 2) AS DECIMAL(14,2)) AS VARCHAR)")}) AS order_key FROM orders""")
def canonical_keys(spark, d):
    """SHA-256 content keys of length-tagged fields, as one column expression."""
    c = F.col
    key = keys.digest(
        keys.field("status", keys.text(c("o_orderstatus"))), keys.field("customer", keys.whole(c("o_custkey"))),
        keys.field("day", keys.stamp(c("o_orderdate").cast("timestamp"))), keys.field("price", keys.number(c("o_totalprice"), 2)),
    )
    return table(spark, d, "orders").select("o_orderkey", key.alias("order_key"))


@query("""
SELECT s_suppkey, coalesce(n_name, 'Unknown') AS nation FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 15) ON s_nationkey = n_nationkey""")
def enrich_unknown(spark, d):
    """Dimension lookup with a default for what isn't found."""
    dim = table(spark, d, "nation").where("n_nationkey < 15")
    return enrich.lookup(table(spark, d, "supplier"), dim, "s_nationkey", "n_nationkey", {"nation": "n_name"}).select("s_suppkey", "nation")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def order_rules() -> list[Rule]:
    return [
        Rule("price_not_null", "not_null", "o_totalprice"),
        Rule("price_in_range", "range", "o_totalprice", {"min": 1000, "max": 300000}),
        Rule("priority_accepted", "accepted_values", "o_orderpriority", {"values": PRIORITIES}),
        Rule("price_expression", "expression", None, {"expression": "o_totalprice > o_custkey"}),
        Rule("order_fresh", "freshness", "o_orderdate", {"days": 1000}),
        Rule("customer_unique", "unique", "o_custkey"),
    ]


AS_OF = "1998-12-31"


@query(f"""
SELECT 'price_not_null' AS rule, count(*) AS evaluated, count(*) FILTER (o_totalprice IS NULL) AS violated FROM orders
UNION ALL SELECT 'price_in_range', count(*), count(*) FILTER (coalesce(o_totalprice < 1000 OR o_totalprice > 300000, true)) FROM orders
UNION ALL SELECT 'priority_accepted', count(*), count(*) FILTER (coalesce(o_orderpriority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM'), true)) FROM orders
UNION ALL SELECT 'price_expression', count(*), count(*) FILTER (coalesce(NOT (o_totalprice > o_custkey), true)) FROM orders
UNION ALL SELECT 'order_fresh', count(*), count(*) FILTER (coalesce(o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 1000 DAY, true)) FROM orders
UNION ALL SELECT 'customer_unique', count(o_custkey), count(o_custkey) - count(DISTINCT o_custkey) FROM orders""")
def dq_rules(spark, d):
    """Six kinds of rules, compiled to columns and counted over one scan; one row for each rule."""
    import datetime as dt

    rules = order_rules()
    rows = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    counted = quality_rules.single_pass(rows, rules, dt.datetime.fromisoformat(AS_OF))
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"e{i}").alias("evaluated"), F.col(f"v{i}").alias("violated")) for i, r in enumerate(rules)]))
    return counted.select(each.alias("r")).select("r.*")


@query("""
SELECT policy, sum(CASE WHEN policy = 'ignore' AND x IS NULL THEN 0 ELSE 1 END)::BIGINT AS evaluated,
       sum(CASE WHEN x IS NULL THEN (policy = 'violation')::INT WHEN x < 10 OR x > 40 THEN 1 ELSE 0 END)::BIGINT AS violated
FROM (SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS x FROM lineitem), (VALUES ('violation'), ('pass'), ('ignore')) p(policy) GROUP BY policy""")
def dq_null_policies(spark, d):
    """The same range rule under each null policy."""
    rows = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("x"))
    rules = [Rule(p, "range", "x", {"min": 10, "max": 40}, null_policy=p) for p in quality_rules.POLICIES]
    counted = quality_rules.single_pass(rows, rules)
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("policy"), F.col(f"e{i}").alias("evaluated"), F.col(f"v{i}").alias("violated")) for i, r in enumerate(rules)]))
    return counted.select(each.alias("r")).select("r.*")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')""")
def referential_orphans(spark, d):
    """Rows whose reference is missing, by an anti join to the distinct keys."""
    open_orders = table(spark, d, "orders").where("o_orderstatus = 'O'")
    lost, _ = quality_rules.orphans(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", open_orders, "o_orderkey")
    return lost


@query("""
SELECT 'orders' AS dataset, greatest(0, p - n) AS violated, p AS evaluated FROM
 (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O'), (SELECT count(*) AS p FROM orders)""")
def row_count_delta(spark, d):
    """Rows lost against a former count."""
    both = table(spark, d, "orders").agg(F.count("*").alias("evaluated"), F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("now"))
    return both.select(F.lit("orders").alias("dataset"), F.greatest(F.lit(0), F.col("evaluated") - F.col("now")).alias("violated"), "evaluated")


def as_events(spark, d) -> DataFrame:
    """The events table in the shape of trip events."""
    c = F.col
    return table(spark, d, "events").select(
        c("event_id").cast("string").alias("event_id"), c("ts").cast("timestamp").alias("event_time"), c("event_type").alias("pickup_borough"),
        c("value").alias("total_amount"), (c("value") / 2).alias("fare_amount"), (c("value") / 4).alias("trip_distance_mi"),
    )


@query("""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type AS pickup_borough, count(*) AS trip_count,
       CAST(sum(CAST(value AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS total_revenue,
       CAST((2 * CAST(sum(CAST(value / 2 AS DECIMAL(18,6))) * 1000000 AS HUGEINT) + 100 * count(value)) // (200 * count(value)) AS DOUBLE) / 10000 AS avg_fare,
       round(CAST(CAST(sum(CAST(value / 4 AS DECIMAL(18,6))) AS DOUBLE) / count(value) AS FLOAT)::DOUBLE, 4) AS avg_distance_mi
FROM events GROUP BY ALL""")
def tumbling_windows(spark, d):
    """The streaming window aggregate, run as a batch. """
    out = windows.aggregate(as_events(spark, d), watermark=None)
    plain = lambda n: F.col(n).cast("timestamp_ntz").alias(n)
    return out.select(plain("window_start"), plain("window_end"), "pickup_borough", "trip_count", "total_revenue", F.col("avg_fare").cast("double").alias("avg_fare"), F.round(F.col("avg_distance_mi").cast("double"), 4).alias("avg_distance_mi"))


@query("""
WITH e AS (SELECT event_id, event_type, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT CASE WHEN k IS NULL THEN 'unparseable' WHEN event_type = 'error' THEN 'unknown_source' WHEN k > 50 THEN 'unknown_schema_version' WHEN value IS NULL THEN 'missing_amount' ELSE 'valid' END AS outcome,
       count(*) AS n FROM e GROUP BY 1""")
def event_validation(spark, d):
    """JSON parsed by a schema, then ordered rejection."""
    e = table(spark, d, "events").withColumn("k", F.from_json("props", struct("k int"))["k"])
    reasons = (
        ("unparseable", F.col("k").isNull()), ("unknown_source", F.col("event_type") == "error"),
        ("unknown_schema_version", F.col("k") > 50), ("missing_amount", F.col("value").isNull()),
    )
    return e.groupBy(F.coalesce(rejects.first_reason(reasons), F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query("""
SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS version FROM events GROUP BY 1, 2""")
def last_version(spark, d):
    """Last version wins: of each key the row of the highest version, by max_by."""
    rows = table(spark, d, "events").select("user_id", "event_type", "value", F.col("event_id").alias("version"))
    return dedup.newest(rows, ["user_id", "event_type"], "version")


@query("""
SELECT event_id, ((1 + event_id % 7) << 32) | (event_id % 1000) AS version, 1 + event_id % 7 AS epoch, event_id % 1000 AS batch FROM events""")
def version_packing(spark, d):
    """Versions packed from epoch and batch, and unpacked again."""
    e = table(spark, d, "events").select("event_id")
    v = e.withColumn("version", versions.packed(1 + F.col("event_id") % 7, F.col("event_id") % 1000))
    return v.select("event_id", "version", versions.epoch_of(F.col("version")).alias("epoch"), versions.batch_of(F.col("version")).alias("batch"))


@query("""
WITH g AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue, round(avg(o_totalprice), 8) AS avg_price FROM orders GROUP BY ALL)
SELECT day, o_orderstatus, sum(n)::BIGINT AS n, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue, round(avg(avg_price), 5) AS avg_of_avg_price FROM g GROUP BY 1, 2""")
def serving_rollup(spark, d):
    """Roll-up of an aggregate with the plain average of its averages."""
    g = table(spark, d, "orders").groupBy(days("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority")
    g = g.agg(F.count("*").alias("n"), money("o_totalprice").alias("revenue"), average("o_totalprice").alias("avg_price"))
    return g.groupBy("day", "o_orderstatus").agg(F.sum("n").alias("n"), F.sum("revenue").cast("decimal(28,2)").alias("revenue"), average("avg_price", 5).alias("avg_of_avg_price"))


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) WHERE place = 1""")
def latest_per_key(spark, d):
    """DISTINCT ON: the newest row of each key."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return dedup.latest_per_key(rows, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("""
SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) AS median_price, round(avg(o_totalprice), 8) AS avg_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
       round(stddev_samp(o_totalprice), 4) AS sd_price, count(DISTINCT o_custkey) AS customers, bool_and(o_totalprice > 1000) AS all_over FROM orders GROUP BY 1""")
def order_statistics(spark, d):
    """Exact interpolated median, sample deviation, distinct counts and bool_and; no group has to fit a task."""
    orders = table(spark, d, "orders")
    plain = orders.groupBy("o_orderpriority").agg(
        average("o_totalprice").alias("avg_price"), F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.round(F.stddev_samp("o_totalprice"), 4).alias("sd_price"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_over"),
    )
    customers = orders.select("o_orderpriority", "o_custkey").distinct().groupBy("o_orderpriority").agg(F.count("o_custkey").alias("customers"))
    medians = exact_percentile(orders, ["o_orderpriority"], "o_totalprice", 0.5, "median_price")
    return plain.join(customers, "o_orderpriority").join(medians, "o_orderpriority").withColumn("median_price", F.round("median_price", 4))


@query("""
SELECT o_orderstatus, n, coalesce(big, 0) AS big FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) LEFT JOIN
 (SELECT o_orderstatus, count(*) AS big FROM orders WHERE o_totalprice > 200000 GROUP BY 1) USING (o_orderstatus)""")
def correlated_counts(spark, d):
    """Scalar correlated counts, decorrelated to one conditional aggregate."""
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count(F.when(F.col("o_totalprice") > 200000, 1)).alias("big"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(spark, d):
    """GROUP BY with HAVING."""
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("""
SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS urgent FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def exists_filters(spark, d):
    """EXISTS and NOT EXISTS of one table, in one aggregate of it and one join; a null price isn't over the bound."""
    return kept_customers(table(spark, d, "customer"), table(spark, d, "orders"))


def kept_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    is_true = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    by = orders.groupBy("o_custkey").agg(is_true(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), is_true(F.col("o_totalprice") > 450000).alias("over"))
    return customers.join(by.where("NOT over"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "urgent")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def newest_order(spark, d):
    """Top-1 by time."""
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1)


@query("SELECT count(*) AS n, sum(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus), 1, 8))::BIGINT)::BIGINT AS total, min(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus), 1, 8))::BIGINT) AS low FROM orders")
def md5_hash(spark, d):
    """Order-independent sum and minimum of 32-bit md5 prefixes."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")), 1, 8), 16, 10).cast("bigint")
    return table(spark, d, "orders").select(h.alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("total"), F.min("h").alias("low"))


@query(None)
def strong_hash(spark, d):
    """Row count, sum and xor of 64-bit hashes over length-tagged columns (no equal hash in SQL)."""
    h = F.xxhash64(content_hash.row_text(table(spark, d, "orders")))
    return table(spark, d, "orders").select(h.alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("total"), F.bit_xor("h").alias("mixed"))


@query("""
SELECT p_brand, p_type, year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue,
       round(avg(l_quantity), 8) AS avg_quantity, round(avg(l_discount), 8) AS avg_discount, round(avg(l_tax), 8) AS avg_tax
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' GROUP BY 1, 2, 3, 4""")
def bench_workload(spark, d):
    """The benchmark's shape: a range of years, a dimension, groups by month. The range reaches the scan."""
    lines = table(spark, d, "lineitem").where("l_shipdate >= timestamp_ntz'1995-01-01' AND l_shipdate < timestamp_ntz'1997-01-01'")
    rows = lines.join(table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows.groupBy("p_brand", "p_type", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.count("*").alias("n"), money("l_extendedprice").alias("revenue"), *[average(f"l_{n}", 8).alias(f"avg_{n}") for n in ("quantity", "discount", "tax")],
    )


@query("""
SELECT 'yellow' AS source, CAST(l_suppkey AS INT) AS vendor_id, CAST(l_linenumber AS BIGINT) AS passenger_count, l_quantity AS trip_distance_mi, l_extendedprice AS fare_amount, CAST(NULL AS DOUBLE) AS ehail_fee FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT 'green', CAST(l_suppkey AS INT), CAST(l_linenumber AS BIGINT), l_quantity, l_extendedprice, l_tax FROM lineitem WHERE l_returnflag <> 'A'""")
def conform_sources(spark, d):
    """Two sources of different columns conformed to one schema, with typed nulls, and united by name."""
    lines = table(spark, d, "lineitem")
    c = F.col
    shared = [c("l_suppkey").alias("VendorID"), c("l_linenumber").alias("passenger_count"), c("l_quantity").alias("trip_distance"), c("l_extendedprice").alias("fare_amount")]
    yellow = conform.conform(lines.where("l_returnflag = 'A'").select(*shared), "yellow")
    green = conform.conform(lines.where("l_returnflag <> 'A'").select(*shared, c("l_tax").alias("ehail_fee")), "GREEN")
    return conform.union(yellow, green).select("source", "vendor_id", "passenger_count", "trip_distance_mi", "fare_amount", "ehail_fee")


@query("""
SELECT o_orderkey, CASE CAST(substr(o_orderpriority, 1, 1) AS INT) WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge' WHEN 4 THEN 'dispute' WHEN 6 THEN 'voided' ELSE 'unknown' END AS label,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, hour(o_orderdate)::INT AS hour, CASE WHEN o_custkey % 10 > 0 THEN round(o_totalprice / (o_custkey % 10), 6) END AS guarded FROM orders""")
def derived_columns(spark, d):
    """Code labels, date parts and a guarded division."""
    c = F.col
    by = c("o_custkey") % 10
    return table(spark, d, "orders").select(
        "o_orderkey", enrich.payment_label(F.substring("o_orderpriority", 1, 1).cast("int")).alias("label"), days("o_orderdate").alias("day"), F.hour("o_orderdate").alias("hour"),
        F.when(by > 0, F.round(c("o_totalprice") / by, 6)).alias("guarded"),
    )


@query("""
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""")
def distinct_pairs(spark, d):
    """DISTINCT."""
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("""
SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 <> 0""")
def keyed_upsert(spark, d):
    """Rows of equal keys replaced by newer ones."""
    old = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = old.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return sinks.upserted(old, new.toDF(*old.columns), ["c_custkey"])


@query("""
WITH s AS (SELECT count(*) AS trips, CAST(sum(CAST(o_totalprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) AS revenue FROM orders)
SELECT frame, trips, CAST(revenue AS DOUBLE) AS revenue FROM (SELECT 'silver' AS frame, trips, revenue FROM s
UNION ALL SELECT 'daily', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(28,8))) AS DECIMAL(18,2)) FROM orders)""")
def reconciliation(spark, d):
    """Totals of the base and of an aggregate of it, in one job."""
    orders = table(spark, d, "orders")
    daily = orders.groupBy(days("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(28,8)")).alias("r"))
    base = orders.agg(F.lit("silver").alias("frame"), F.count("*").alias("trips"), money("o_totalprice").cast("double").alias("revenue"))
    return base.unionByName(daily.agg(F.lit("daily").alias("frame"), F.sum("n").alias("trips"), F.sum("r").cast("decimal(18,2)").cast("double").alias("revenue")))


@query("""
SELECT event_id::VARCHAR AS event_id, event_type AS pickup_borough, ts AS event_time, value AS total_amount FROM events""")
def json_round_trip(spark, d):
    """Events written as JSON strings and read back by their schema."""
    e = as_events(spark, d)
    lines = e.select(F.to_json(F.struct("event_id", "event_time", "pickup_borough", "total_amount"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
    out = stream_events.parse(lines)
    return out.select("event_id", "pickup_borough", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "total_amount")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')")
def dimension_view(spark, d):
    """Two dimensions, queried by name in SQL; no view is left in the session."""
    text = "SELECT n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')"
    return spark.sql(text, nation=table(spark, d, "nation"), region=readers.parquet(spark, f"{d}/region.parquet"))


@query("""
SELECT window_start, window_end, user_id, n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS n FROM events
WHERE ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events) GROUP BY ALL)""")
def retained_windows(spark, d):
    """Retention: windows of the last seven days of the data."""
    e = table(spark, d, "events")
    rows = windows.retained(e, "ts", 7, e.agg(F.max("ts").alias("m")).scalar())
    start = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return rows.groupBy(start.alias("window_start"), (start + F.expr("INTERVAL 1 HOUR")).alias("window_end"), "user_id").agg(F.count("*").alias("n"))
