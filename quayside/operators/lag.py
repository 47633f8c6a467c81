"""Offsets per partition: ends, commits, starts, and progress through the lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import PROGRESS_THRESHOLD

PARTITION = ["topic", "partition"]


def end_offsets(records: DataFrame) -> DataFrame:
    """High watermark: one past the last record of each partition."""
    return records.groupBy(*PARTITION).agg((F.max("offset") + 1).alias("end_offset"))


def start_offsets(batch: DataFrame) -> DataFrame:
    """First offset of each partition in an open batch."""
    return batch.groupBy(*PARTITION).agg(F.min("offset").alias("start_offset"))


def committed_offsets(partitions: DataFrame, landing_log: DataFrame) -> DataFrame:
    """Committed end of each partition; a partition never landed counts as 0."""
    landed = landing_log.groupBy(*PARTITION).agg(F.max("end_offset").alias("_end"))
    return (
        partitions.select(*PARTITION)
        .distinct()
        .join(landed, PARTITION, "left")
        .select(*PARTITION, F.coalesce("_end", F.lit(0)).cast("bigint").alias("committed_offset"))
    )


def lag_progress(
    starts: DataFrame, ends: DataFrame, positions: DataFrame, threshold: float = PROGRESS_THRESHOLD
) -> DataFrame:
    """Share of the lag that the open batch has consumed, per partition.

    Partitions without a watermark are skipped, a missing position counts as
    the start, and only a positive lag can trigger. The comparison is strict.
    ``positions`` is ``(topic, partition, position)``.
    """
    lag = F.col("end_offset") - F.col("start_offset")
    consumed = F.coalesce("position", "start_offset") - F.col("start_offset")
    progress = F.when(lag > 0, consumed.cast("double") / lag)
    return (
        starts.join(ends, PARTITION)
        .join(positions, PARTITION, "left")
        .select(
            *PARTITION,
            "start_offset",
            "end_offset",
            F.coalesce("position", "start_offset").alias("position"),
            progress.alias("progress"),
            F.coalesce(progress > threshold, F.lit(False)).alias("flush"),
        )
    )


def topics_to_flush(progress: DataFrame) -> DataFrame:
    """Topics of which any partition has passed the threshold."""
    return progress.groupBy("topic").agg(F.max("flush").alias("flush"), F.max("progress").alias("progress"))
