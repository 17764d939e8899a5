"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import gc
import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def fold(key: str, n: int) -> Column:
    """crc32 of the key written as text, modulo n."""
    return F.crc32(F.col(key).cast("string")) % n


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's setting.

    Where it is unset, a folder of this machine will do for a local session, which has no
    other executors; on a cluster that is an error.
    """
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Rows and bytes that go to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to what a Python worker should hold of long texts at once.

    The settings stay, as the frames that operators return are run later, by their session.
    """
    for name, bound in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key)
        if not (now.isdigit() and 0 < int(now) <= bound):
            spark.conf.set(key, str(bound))


@contextlib.contextmanager
def no_cycles() -> Iterator[None]:
    """Without Python's search for cyclic garbage, which would walk through large caches again and again; for code that makes none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def named(df: DataFrame, *names: str) -> DataFrame:
    """The columns an operator reads, and no others, so that clashing extra columns don't matter."""
    return df.select(*names)


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return named(spark.read.parquet(f"{sf_dir}/{name}.parquet"), *columns)
