"""Task metrics of a run: from the session's own status store while it lives, or from Spark's JSON event log.

The log tells all attempts of tasks from the successful ones; the status store has a stage's
sums over all its tasks.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Metric name and its place in the log's task metrics.
PLACES = {
    "run_time_ms": ("Executor Run Time",),
    "cpu_time_ns": ("Executor CPU Time",),
    "gc_time_ms": ("JVM GC Time",),
    "peak_memory_bytes": ("Peak Execution Memory",),
    "memory_spilled_bytes": ("Memory Bytes Spilled",),
    "disk_spilled_bytes": ("Disk Bytes Spilled",),
    "input_bytes": ("Input Metrics", "Bytes Read"),
    "input_rows": ("Input Metrics", "Records Read"),
    "shuffle_write_bytes": ("Shuffle Write Metrics", "Shuffle Bytes Written"),
    "shuffle_read_bytes": ("Shuffle Read Metrics", "Local Bytes Read"),
}
LARGEST = {"peak_memory_bytes"}


def task_metrics(lines: Iterable[str]) -> dict[str, dict[str, int]]:
    """{"all": ..., "successful": ...}: sums, but the maximum of peak memory; other lines are passed over."""
    out = {scope: dict.fromkeys(("tasks", *PLACES), 0) for scope in ("all", "successful")}
    for line in lines:
        try:
            e = json.loads(line)
        except ValueError:
            continue
        if e.get("Event") != "SparkListenerTaskEnd":
            continue
        m = e.get("Task Metrics") or {}
        good = (e.get("Task End Reason") or {}).get("Reason") == "Success"
        for scope in ("all", "successful") if good else ("all",):
            out[scope]["tasks"] += 1
            for name, place in PLACES.items():
                value = m
                for k in place:
                    value = (value or {}).get(k, 0)
                if name == "shuffle_read_bytes":
                    value = (value or 0) + ((m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0))
                out[scope][name] = max(out[scope][name], value or 0) if name in LARGEST else out[scope][name] + (value or 0)
    return out


# Metric name and the status store's accessor of it.
ACCESSORS = {
    "run_time_ms": "executorRunTime",
    "cpu_time_ns": "executorCpuTime",
    "gc_time_ms": "jvmGcTime",
    "peak_memory_bytes": "peakExecutionMemory",
    "memory_spilled_bytes": "memoryBytesSpilled",
    "disk_spilled_bytes": "diskBytesSpilled",
    "input_bytes": "inputBytes",
    "input_rows": "inputRecords",
    "shuffle_write_bytes": "shuffleWriteBytes",
    "shuffle_read_bytes": "shuffleReadBytes",
}


@contextlib.contextmanager
def job_group(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs that are started inside belong to the group; the caller's group is put back."""
    context = spark.sparkContext
    keys = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = [context.getLocalProperty(k) for k in keys]
    context.setJobGroup(name, name)
    try:
        yield
    finally:
        for k, v in zip(keys, before, strict=True):
            context.setLocalProperty(k, v)


def of_group(spark: SparkSession, name: str) -> dict[str, int]:
    """The metrics of a group's stages, with the numbers of stages and of tasks; what the store no longer has counts as nothing."""
    scala, tracker = spark.sparkContext._jsc.sc(), spark.sparkContext.statusTracker()
    scala.listenerBus().waitUntilEmpty()
    out = dict.fromkeys(("stages", "tasks", *ACCESSORS), 0)
    stages = {s for j in tracker.getJobIdsForGroup(name) if (info := tracker.getJobInfo(j)) for s in info.stageIds}
    for s in sorted(stages):
        try:
            stage = scala.statusStore().lastStageAttempt(s)
        except Py4JJavaError:  # the store keeps the latest stages only
            continue
        if not stage.numCompleteTasks() + stage.numFailedTasks():
            continue
        out["stages"] += 1
        out["tasks"] += stage.numCompleteTasks() + stage.numFailedTasks()
        for n, accessor in ACCESSORS.items():
            value = getattr(stage, accessor)()
            out[n] = max(out[n], value) if n in LARGEST else out[n] + value
    return out
