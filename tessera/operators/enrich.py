"""Derived columns and dimension lookups of the silver layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import trip_key
from tessera.operators import dedup, rejects
from tessera.sources.schemas import SILVER

UNKNOWN = "Unknown"

# The labels of payment codes.
PAYMENTS = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute", 5: "unknown", 6: "voided"}

#: Rows, and bytes by the optimiser's estimate, up to which a dimension is broadcast; larger ones are joined as Spark decides.
DIMENSION_ROWS, DIMENSION_BYTES = 100_000, 64 << 20


def payment_label(code: Column) -> Column:
    out = F.lit("unknown")
    for k, v in PAYMENTS.items():
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


def derive(df: DataFrame) -> DataFrame:
    """Duration, speed, tip share and payment label; each null where its divisor isn't positive."""
    c = F.col
    took = rejects.minutes("pickup_ts", "dropoff_ts")
    return df.withColumn("trip_duration_min", took).withColumns({
        "avg_speed_mph": F.when(c("trip_duration_min") > 0, c("trip_distance_mi") / (c("trip_duration_min") / 60.0)),
        "tip_pct": F.when(c("fare_amount") != 0, c("tip_amount") / c("fare_amount")),
        "payment_type": payment_label(c("payment_type_code")),
    })


def unique_dimension(dim: DataFrame, key: str) -> DataFrame:
    """The dimension; ValueError if a key repeats, as facts would be multiplied."""
    again = dim.groupBy(key).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"dimension key {key}={again[0][0]} repeats")
    return dim


def is_small(dim: DataFrame) -> bool:
    """Whether a dimension is within both bounds. Rows are counted up to the bound, on the executors."""
    size = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = dim.limit(DIMENSION_ROWS + 1).agg(F.count("*"), F.sum(sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in dim.columns), F.lit(0)))).first()
    return rows[0] <= DIMENSION_ROWS and (size <= DIMENSION_BYTES or (rows[1] or 0) * 4 <= DIMENSION_BYTES)


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, str], default: str | None = UNKNOWN) -> DataFrame:
    """Left join to a dimension in one of its roles; what isn't found takes the default.

    columns: output name to dimension column. The dimension is broadcast only if it is
    within DIMENSION_ROWS and DIMENSION_BYTES.
    """
    small = is_small(dim.select(dim_key, *columns.values()))
    side = dim.select(F.col(dim_key).alias("__key"), *[F.col(v).alias(f"__{k}") for k, v in columns.items()])
    out = df.join(F.broadcast(side) if small else side, F.col(key) == F.col("__key"), "left").drop("__key")
    value = lambda n: F.coalesce(F.col(f"__{n}"), F.lit(default)) if default is not None else F.col(f"__{n}")
    return out.withColumns({n: value(n) for n in columns}).drop(*[f"__{n}" for n in columns])


def silver(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    """Bronze to silver: reject, key, deduplicate, derive, look up zones, pin the columns."""
    zones = unique_dimension(zones, "LocationID")
    rows = rejects.valid(bronze, rejects.trip_reasons()).withColumn("trip_key", trip_key())
    rows = derive(dedup.keep_first(rows, ["trip_key"], dedup.trip_order()))
    for role in ("pickup", "dropoff"):
        rows = lookup(rows, zones, f"{role}_location_id", "LocationID", {f"{role}_borough": "Borough", f"{role}_zone": "Zone"})
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER.fields])
