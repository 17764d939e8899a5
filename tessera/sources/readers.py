"""Readers. Each gives a lazy DataFrame; filters and columns reach the scan through Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMPS = "yyyy-MM-dd HH:mm:ss"


def parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """One or several Parquet paths of one schema."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema, empty fields are null; without, types are inferred."""
    reader = spark.read.option("header", True).option("timestampFormat", TIMESTAMPS).option("nullValue", "")
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def json_strings(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The fields of a column of JSON strings; a malformed string gives nulls."""
    return df.select(F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"}).alias("event")).select("event.*")


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog."""
    return spark.table(name)


def stream_text(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files that arrive in a folder, as the column value."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(folder)


def stream_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message values of a Kafka topic from the earliest offset, as the column value.

    Needs Spark's Kafka connector on the class path. Missing offsets don't stop the query.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )
