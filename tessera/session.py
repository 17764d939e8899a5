"""Session construction and small helpers that every module shares."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def build(app: str = "tessera", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine assumes: UTC, ANSI, AQE."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.shuffle.partitions": str(cores if str(cores).isdigit() else os.cpu_count() or 8),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return ship(SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=settings).getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package when the driver found it by sys.path alone.

    On a cluster the package is installed or sent with --py-files; an entry that names a
    folder the executors don't have is ignored there.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(at: dt.datetime) -> dt.datetime:
    """A time without a zone is one of UTC, whatever the machine's zone."""
    return at if at.tzinfo else at.replace(tzinfo=dt.UTC)
