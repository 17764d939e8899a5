"""Batch sinks: aligned appends, replacement by run, and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that a target fills in itself, so that a frame may lack them.
DEFAULTED = ("ingested_at", "loaded_at", "updated_at")


def aligned(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """The target's columns in its order; ValueError that names all missing ones."""
    missing = [c for c in target_columns if c not in df.columns and c not in DEFAULTED]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[c if c in df.columns else F.current_timestamp().alias(c) for c in target_columns])


def append(df: DataFrame, table: str) -> None:
    """Appends to a catalog table; columns are matched by name first, as insertInto goes by place."""
    aligned(df, df.sparkSession.table(table).columns).write.insertInto(table)


def write_run(df: DataFrame, folder: str, run_id: str, column: str = "etl_run_id") -> None:
    """Writes a run's rows as one partition; a rerun replaces that partition alone."""
    rows = df if column in df.columns else df.withColumn(column, F.lit(run_id))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(folder)


def remove(spark: SparkSession, folder: str) -> bool:
    """Deletes a folder through Hadoop's file system, wherever it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def promote_run(spark: SparkSession, staged: str, folder: str, run_id: str, column: str = "etl_run_id") -> None:
    """Moves a run's partition from a staged folder to its place, whose former rows go."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    target = path(f"{folder}/{column}={run_id}")
    files.delete(target, True)
    if not files.rename(path(f"{staged}/{column}={run_id}"), target):
        raise OSError(f"{staged} couldn't be moved to {target}")


def delete_run(spark: SparkSession, folder: str, run_id: str, column: str = "etl_run_id") -> bool:
    """Removes a run's partition."""
    return remove(spark, f"{folder}/{column}={run_id}")


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with the rows of new in place of those of equal keys; null keys are equal to each other."""
    on = [old[k].eqNullSafe(new[k]) for k in keys]
    cond = on[0]
    for x in on[1:]:
        cond = cond & x
    return old.join(new, cond, "left_anti").unionByName(new.select(*old.columns))


def upsert_sqlite(control, table: str, keys: Sequence[str], df: DataFrame, bound: int = 1_000_000) -> int:
    """Upserts a small frame to a serving table; ValueError over bound rows, which is checked first."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"over {bound} rows don't go to {table}")
    names = df.columns
    sets = ", ".join(f"{n} = excluded.{n}" for n in names if n not in keys)
    sql = f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join('?' * len(names))}) ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {sets}"
    plain = lambda v: v if v is None or isinstance(v, (int, float, str)) else float(v) if hasattr(v, "as_tuple") else str(v)
    with control.transaction() as c:
        c.executemany(sql, [tuple(map(plain, r)) for r in rows])
    return len(rows)
