"""Exact percentiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketch that finds the band in which a percentile lies; the band holds some 8 / ACCURACY of a group.
ACCURACY = 10_000


def exact_percentile(df: DataFrame, keys: Sequence[str], column: str, p: float, name: str) -> DataFrame:
    """keys and the interpolating percentile p of a column's values that aren't null.

    The built-in exact percentile holds all distinct values of a group in one task. Here a
    sketch, whose error in rank is bounded, gives a band of values in which the wanted ranks
    must lie; a second pass counts the values below the band and each distinct value within
    it, both in partial sums before the shuffle, and only those counts are put in order.
    """
    rows = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("__v"))
    room = 4.0 / ACCURACY
    band = F.percentile_approx("__v", [max(0.0, p - room), min(1.0, p + room)], ACCURACY)
    bounds = rows.groupBy(*keys).agg(F.count("*").alias("__n"), band.alias("__b")).select(*[F.col(k).alias(f"__{k}") for k in keys], "__n", "__b")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    cond = same[0]
    for x in same[1:]:
        cond = cond & x
    v, below, above = F.col("__v"), F.col("__v") < F.col("__b")[0], F.col("__v") > F.col("__b")[1]
    side = F.when(below, 0).when(above, 2).otherwise(1)
    near = rows.join(bounds, cond).select(*keys, "__n", v, side.alias("__side"), F.when(~below & ~above, v).alias("__in"))
    counts = near.groupBy(*keys, "__side", "__in").agg(F.count("*").alias("__c"), F.first("__n").alias("__n"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
    order = Window.partitionBy(*keys).orderBy("__side", F.col("__in").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("__to", F.sum("__c").over(order)).withColumn("__at", (F.col("__n") - 1) * F.lit(float(p)))
    # A wanted rank may be the one next to the band, as the last below it or the first above it.
    value = F.when(F.col("__side") == 0, F.col("__most")).otherwise(F.col("__least"))
    holds = lambda rank: (F.col("__to") > rank) & (F.col("__to") - F.col("__c") <= rank)
    low, high = F.floor("__at"), F.ceil("__at")
    found = placed.groupBy(*keys).agg(
        F.max(F.when(holds(low), value)).alias("__low"), F.max(F.when(holds(high), value)).alias("__high"), F.first(F.col("__at") - F.floor("__at")).alias("__part")
    )
    return found.select(*keys, (F.col("__low") * (1 - F.col("__part")) + F.col("__high") * F.col("__part")).alias(name))
