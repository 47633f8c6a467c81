"""Flush batches on a stream, cut by the batch job on every micro-batch, with the
records of the open batches carried over as a table. Offsets need to rise from one
micro-batch to the next, as those of a topic do. A hot partition is spread over
many tasks, so a backlog may come in one piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.batches import cut_batches
from quayside.session import cut_lineage
from quayside.sources.catalog import read_if_there

PARTITION = ["topic", "partition"]
RECORD = [*PARTITION, "offset", "timestamp", "bytes"]


def cut_micro_batch(batch: DataFrame, batch_id: int, path: str, max_bytes: int, max_age_seconds: float) -> None:
    """One step: cut what was open and what is new, write what has closed.

    Everything is named by batch id and overwritten, and the step reads only
    what the step before it left, so it may be repeated.
    """
    spark = batch.sparkSession
    new = batch.select(*RECORD)
    clocks = read_if_there(spark, f"{path}/clock/flush={batch_id - 1}")
    if clocks is not None:
        # Time does not run backwards from one step to the next either.
        late = new.join(clocks, PARTITION, "left")
        still_open = read_if_there(spark, f"{path}/open/flush={batch_id - 1}").select(*RECORD)
        new = late.withColumn("timestamp", F.greatest("timestamp", "clock")).select(*RECORD).unionByName(still_open)
    cut = cut_lineage(cut_batches(new, max_bytes, max_age_seconds), "flushes")
    filling = cut.filter("closed_by = 'open'").select(*PARTITION, "batch_start", "first_at")
    carried = new.join(filling, PARTITION).filter(F.col("offset") >= F.col("batch_start"))
    carried.withColumn("timestamp", F.greatest("timestamp", "first_at")).select(*RECORD).write.mode("overwrite").parquet(
        f"{path}/open/flush={batch_id}"
    )
    latest = cut.select(*PARTITION, F.col("last_at").alias("clock"))
    latest = latest if clocks is None else latest.unionByName(clocks)
    latest.groupBy(*PARTITION).agg(F.max("clock").alias("clock")).write.mode("overwrite").parquet(f"{path}/clock/flush={batch_id}")
    cut.filter("closed_by <> 'open'").write.mode("overwrite").parquet(f"{path}/closed/flush={batch_id}")


def cut_micro_batches(records: DataFrame, max_bytes: int, max_age_seconds: float, path: str, checkpoint: str) -> DataFrame:
    """Cut everything available step by step; returns the closed batches."""

    def step(batch: DataFrame, batch_id: int) -> None:
        cut_micro_batch(batch, batch_id, path, max_bytes, max_age_seconds)

    writer = records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return records.sparkSession.read.parquet(f"{path}/closed").drop("flush")
