"""Gold aggregates, declared as group keys and measures, and their reconciliation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.measures import average, money, share


def dated(silver: DataFrame) -> DataFrame:
    """Adds the pickup's date and hour."""
    return silver.withColumns({"pickup_date": F.to_date("pickup_ts"), "pickup_hour": F.hour("pickup_ts")})


@dataclass(frozen=True)
class Aggregate:
    """A grouping with its measures; share_over: keys of the total that revenue_share refers to."""

    keys: tuple[str, ...]
    measures: dict[str, Column] = field(compare=False)
    share_over: tuple[str, ...] = ()

    def over(self, df: DataFrame) -> DataFrame:
        out = df.groupBy(*self.keys).agg(*[m.alias(n) for n, m in self.measures.items()])
        if self.share_over:
            whole = F.sum("total_revenue").over(Window.partitionBy(*self.share_over))
            out = out.withColumn("revenue_share", share(F.col("total_revenue"), whole))
        return out


def aggregates(places: int | None = 4) -> dict[str, Aggregate]:
    """The four aggregates; their averages have so many places (None: all, for what compares or rounds them itself)."""
    mean = lambda c: average(c, places)
    base = {"trip_count": F.count("*"), "total_revenue": money("total_amount")}
    fare, miles = {"avg_fare": mean("fare_amount")}, {"avg_distance_mi": mean("trip_distance_mi")}
    took, speed, tip = {"avg_duration_min": mean("trip_duration_min")}, {"avg_speed_mph": mean("avg_speed_mph")}, {"avg_tip_pct": mean("tip_pct")}
    return {
        "zone_hourly": Aggregate(("pickup_date", "pickup_hour", "pickup_location_id", "pickup_borough", "pickup_zone"), base | fare | miles | took | tip),
        "borough_od": Aggregate(("pickup_date", "pickup_borough", "dropoff_borough"), base | miles | took),
        "payment_daily": Aggregate(("pickup_date", "source", "payment_type"), base | {"total_tips": money("tip_amount")} | tip, ("pickup_date", "source")),
        "daily_kpi": Aggregate(("pickup_date", "source", "vendor_id"), base | fare | miles | took | speed | tip),
    }


def build(silver: DataFrame, places: int | None = 4) -> dict[str, DataFrame]:
    rows = dated(silver)
    return {name: a.over(rows) for name, a in aggregates(places).items()}


def fact(silver: DataFrame, run_id: str) -> DataFrame:
    """The trip fact: silver with its date and the run."""
    return stamped(dated(silver).drop("pickup_hour"), run_id)


def stamped(df: DataFrame, run_id: str) -> DataFrame:
    """Adds etl_run_id where it is absent."""
    return df if "etl_run_id" in df.columns else df.withColumn("etl_run_id", F.lit(run_id))


class ReconciliationError(RuntimeError):
    """An aggregate doesn't add up to silver."""


def totals(df: DataFrame, count: Column, revenue: Column, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("frame"), F.coalesce(count, F.lit(0)).cast("bigint").alias("trips"), F.coalesce(revenue, F.lit(0)).cast("decimal(28,2)").alias("revenue"))


def reconcile(silver: DataFrame, frames: dict[str, DataFrame], tolerance: float = 0.01) -> dict[str, tuple[int, float]]:
    """Counts and revenue of silver and of each frame, in one job; ReconciliationError if they differ.

    Each group rounds its revenue to cents, so a frame may be off by half a cent a group.
    """
    out = totals(silver, F.count("*"), money("total_amount"), "silver").withColumn("groups", F.lit(0).cast("bigint"))
    for name, df in frames.items():
        out = out.unionByName(
            df.agg(
                F.lit(name).alias("frame"), F.coalesce(F.sum("trip_count"), F.lit(0)).cast("bigint").alias("trips"),
                F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("decimal(28,2)").alias("revenue"), F.count("*").alias("groups"),
            )
        )
    found = {r["frame"]: r for r in out.collect()}
    base = found["silver"]
    bad = [
        f"{n}: {r['trips']} trips, {r['revenue']} (silver: {base['trips']}, {base['revenue']})"
        for n, r in found.items()
        if r["trips"] != base["trips"] or abs(float(r["revenue"] - base["revenue"])) > tolerance + 0.005 * r["groups"]
    ]
    if bad:
        raise ReconciliationError("; ".join(bad))
    return {n: (r["trips"], float(r["revenue"])) for n, r in found.items()}


def serving_kpi(daily: DataFrame, rounded: bool = True) -> DataFrame:
    """(date, source, vendor) to (date, source): sums, and the plain average of the vendors' averages.

    The averages aren't weighted by trips; that is this table's definition.
    """
    unweighted = {n: average(n, (6 if n == "avg_tip_pct" else 4) if rounded else None) for n in ("avg_fare", "avg_distance_mi", "avg_duration_min", "avg_tip_pct")}
    return daily.groupBy(F.col("pickup_date").alias("kpi_date"), F.col("source").alias("vendor_name")).agg(
        F.sum("trip_count").alias("trip_count"), F.sum("total_revenue").cast("decimal(28,2)").alias("total_revenue"), *[m.alias(n) for n, m in unweighted.items()]
    )


def zone_dimension(zones: DataFrame) -> DataFrame:
    """The zone dimension under its serving names."""
    return zones.select(
        F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"), F.col("Zone").alias("zone"), F.col("service_zone").alias("service_zone")
    )


def workload(silver: DataFrame, zones: DataFrame, years: tuple[int, int] = (2024, 2025), hint: bool = True) -> DataFrame:
    """The benchmark's query: trips of a range of years by zone and month.

    The years are a range of timestamps, which prunes row groups; year() IN (...) would not.
    """
    low, high = years
    rows = silver.where((F.col("pickup_ts") >= F.lit(f"{low}-01-01").cast("timestamp")) & (F.col("pickup_ts") < F.lit(f"{high + 1}-01-01").cast("timestamp")))
    side = zones.select(F.col("LocationID").alias("pickup_location_id"), F.col("Borough").alias("borough"), "service_zone")
    rows = rows.join(F.broadcast(side) if hint else side, "pickup_location_id", "left")
    return rows.groupBy("borough", "service_zone", F.year("pickup_ts").alias("year"), F.month("pickup_ts").alias("month")).agg(
        F.count("*").alias("trip_count"), money("total_amount").alias("total_revenue"),
        *[average(c, 6).alias(f"avg_{n}") for c, n in (("fare_amount", "fare"), ("trip_distance_mi", "distance"), ("trip_duration_min", "duration"))],
    )
