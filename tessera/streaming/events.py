"""Trip events: parsing, validation with ordered reasons, and production from silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.rejects import Reasons, first_reason
from tessera.sources.schemas import EVENT

SCHEMA_VERSION, KNOWN_SOURCES, NO_BOROUGH = 1, ("yellow", "green"), "Unknown"
#: Amounts beyond this, and NaN, aren't amounts.
MAX_AMOUNT = 1e9


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """The envelope's fields; malformed JSON gives a row of nulls, a malformed field a null."""
    return lines.select(F.from_json(F.col(column).cast("string"), EVENT, {"mode": "PERMISSIVE"}).alias("event")).select("event.*")


def event_reasons() -> Reasons:
    """The reasons of the stream path, in order. NaN is greater than any number, so it is out of range."""
    c = F.col
    wild = lambda n: (c(n) > MAX_AMOUNT) | (c(n) < -MAX_AMOUNT)
    blank = lambda n: c(n).isNull() | (c(n) == "")
    return (
        ("unparseable", c("event_id").isNull() & c("trip_key").isNull() & c("event_time").isNull()),
        ("missing_event_id", blank("event_id")),
        ("missing_trip_key", blank("trip_key")),
        ("missing_event_time", c("event_time").isNull()),
        ("unknown_schema_version", c("schema_version").isNull() | (c("schema_version") != SCHEMA_VERSION)),
        ("unknown_source", c("source").isNull() | ~c("source").isin(*KNOWN_SOURCES)),
        ("missing_amount", c("total_amount").isNull() | c("fare_amount").isNull()),
        ("amount_out_of_range", wild("total_amount") | wild("fare_amount")),
    )


def classify(events: DataFrame) -> DataFrame:
    return events.withColumn("reject_reason", first_reason(event_reasons()))


def valid(events: DataFrame) -> DataFrame:
    return events.where(first_reason(event_reasons()).isNull())


def event_id() -> Column:
    return F.concat(F.col("trip_key"), F.lit("-"), F.date_format("pickup_ts", "yyyyMMddHHmmss"))


def produce(silver: DataFrame, produced_at: Column | None = None) -> DataFrame:
    """key, value (JSON) of an event for each silver trip; a null borough becomes Unknown."""
    event = F.struct(
        event_id().alias("event_id"),
        F.col("trip_key"),
        F.col("pickup_ts").alias("event_time"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("source"),
        F.coalesce("pickup_borough", F.lit(NO_BOROUGH)).alias("pickup_borough"),
        "fare_amount",
        "total_amount",
        "trip_distance_mi",
        (produced_at if produced_at is not None else F.current_timestamp()).alias("producer_timestamp"),
    )
    return silver.select(F.col("trip_key").alias("key"), F.to_json(event).alias("value"))


def publish_files(events: DataFrame, folder: str) -> None:
    """Appends the values as text files, for the file source."""
    events.select("value").write.mode("append").text(folder)


def publish_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Writes keys and values to a topic; needs Spark's Kafka connector."""
    events.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
