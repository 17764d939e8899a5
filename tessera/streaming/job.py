"""The streaming job: lines in, versioned windows out."""

from __future__ import annotations

import os
import threading
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.governance.control import ControlPlane
from tessera.streaming import events, windows


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query has dropped behind the watermark, over the progress reports it keeps."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


class CheckpointInUse(RuntimeError):
    """Another query runs on the checkpoint."""


#: The queries that this driver has started, by checkpoint.
RUNNING: dict[str, StreamingQuery] = {}
STARTING = threading.Lock()


@dataclass(frozen=True)
class StreamJob:
    """One query over a stream of JSON lines. The epoch belongs to the checkpoint and is allocated once."""

    control: ControlPlane
    output: str
    checkpoint: str
    watermark: str = windows.WATERMARK
    once: bool = True
    trigger_seconds: int = 2
    deduplicate: bool = False

    def start(self, lines: DataFrame) -> StreamingQuery:
        """Starts the query; with once it ends when the input there is has been read."""
        epoch = self.control.epoch(self.checkpoint)
        output = self.output
        rows = events.valid(events.parse(lines))
        rows = windows.without_repeats(rows, self.watermark) if self.deduplicate else rows
        out = windows.aggregate(rows, None if self.deduplicate else self.watermark)

        def sink(batch: DataFrame, batch_id: int) -> None:
            windows.write_version(batch, output, epoch, batch_id, "trip-windows")

        writer = out.writeStream.outputMode("update").option("checkpointLocation", self.checkpoint).foreachBatch(sink)
        writer = writer.trigger(availableNow=True) if self.once else writer.trigger(processingTime=f"{self.trigger_seconds} seconds")
        where = os.path.abspath(self.checkpoint)
        with STARTING:
            if (running := RUNNING.get(where)) is not None and running.isActive:
                raise CheckpointInUse(f"another query of this driver, {running.id}, runs on {self.checkpoint}")
            try:
                RUNNING[where] = writer.start()
            except StreamingQueryException as error:  # another driver's query has the checkpoint's next batch
                if "CONCURRENT" in str(error.getCondition() or "").upper():
                    raise CheckpointInUse(f"another query runs on {self.checkpoint}") from error
                raise
            return RUNNING[where]
