"""Row versions of replayable streams: the epoch in the upper 32 bits, the batch in the lower."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_EPOCH, MAX_BATCH = (1 << 31) - 1, (1 << 32) - 1


def pack(epoch: int, batch: int) -> int:
    if not 1 <= epoch <= MAX_EPOCH:
        raise ValueError(f"epoch {epoch} isn't in 1..{MAX_EPOCH}")
    if not 0 <= batch <= MAX_BATCH:
        raise ValueError(f"batch {batch} isn't in 0..{MAX_BATCH}")
    return epoch << 32 | batch


def unpack(version: int) -> tuple[int, int]:
    return version >> 32, version & MAX_BATCH


def supersedes(new: int, old: int) -> bool:
    return new > old


def packed(epoch: Column, batch: Column) -> Column:
    return F.shiftleft(epoch.cast("bigint"), 32).bitwiseOR(batch.cast("bigint"))


def epoch_of(version: Column) -> Column:
    return F.shiftrightunsigned(version, 32)


def batch_of(version: Column) -> Column:
    return version.bitwiseAND(F.lit(MAX_BATCH))
