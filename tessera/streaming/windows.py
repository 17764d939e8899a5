"""Event-time windows, their watermark, and the versioned sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.measures import exact_average, money
from tessera.operators.dedup import newest
from tessera.session import utc
from tessera.streaming import versions

WINDOW, WATERMARK = "5 minutes", "10 minutes"
KEYS = ("window_start", "window_end", "pickup_borough")


def aggregate(events: DataFrame, watermark: str | None = WATERMARK, window: str = WINDOW) -> DataFrame:
    """Tumbling windows [start, end) by borough: count, revenue, average fare and distance.

    Without a watermark the same query runs as a batch. Money is summed as decimals, so
    that a replay gives the same rows whatever the order. An amount that is no number, or
    too large for its decimal, counts as null.
    """
    rows = events.withWatermark("event_time", watermark) if watermark else events
    out = rows.groupBy(F.window("event_time", window).alias("w"), "pickup_borough").agg(
        F.count("*").alias("trip_count"),
        money("total_amount").alias("total_revenue"),
        exact_average("fare_amount", "decimal(12,4)").alias("avg_fare"),
        exact_average("trip_distance_mi", "float").alias("avg_distance_mi"),
    )
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pickup_borough", "trip_count", "total_revenue", "avg_fare", "avg_distance_mi")


def without_repeats(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Opt-in: an event_id counts once within the watermark, so a republished event changes nothing."""
    return events.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


def stamped(batch: DataFrame, query_id: str, epoch: int, batch_id: int) -> DataFrame:
    """Adds stream_query_id, batch_id, stream_epoch and version; a pure function of its arguments."""
    return batch.withColumns({
        "stream_query_id": F.lit(query_id),
        "batch_id": F.lit(batch_id).cast("bigint"),
        "stream_epoch": F.lit(epoch).cast("bigint"),
        "version": F.lit(versions.pack(epoch, batch_id)).cast("bigint"),
    })


def write_version(rows: DataFrame, folder: str, epoch: int, batch_id: int, query_id: str) -> None:
    """Writes a batch to the folder of its version, replacing what an interrupted attempt left there."""
    stamped(rows, query_id, epoch, batch_id).write.mode("overwrite").parquet(f"{folder}/part={versions.pack(epoch, batch_id)}")


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The last version of each window."""
    return newest(spark.read.parquet(folder).drop("part"), KEYS, "version")


def retained(rows: DataFrame, column: str, days: int, as_of) -> DataFrame:
    """The rows no older than so many days at a given time, which may be a column or a scalar query."""
    at = as_of if isinstance(as_of, Column) else F.lit(utc(as_of))
    return rows.where(F.col(column) >= at - F.make_dt_interval(F.lit(days)))
