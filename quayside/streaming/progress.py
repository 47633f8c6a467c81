"""What streams report of themselves, and limits that follow from what was landed."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from quayside.config import TopicSettings
from quayside.operators import telemetry
from quayside.sources import commits
from quayside.streaming import landing

PROGRESS = """query string, run string, batch_id bigint, reported_at string, input_rows bigint, trigger_ms bigint,
    source int, start_offsets string, end_offsets string, latest_offsets string"""
ENDED = "query string, run string, failure string"


class ProgressLog(StreamingQueryListener):
    """Writes a small file below ``path`` for each progress report and each end of a query, as they come."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        head = {
            "query": p.name, "run": str(p.runId), "batch_id": p.batchId, "reported_at": p.timestamp, "input_rows": p.numInputRows,
            "trigger_ms": (p.durationMs or {}).get("triggerExecution"),
        }
        for i, s in enumerate(p.sources):
            row = {**head, "source": i, "start_offsets": s.startOffset, "end_offsets": s.endOffset, "latest_offsets": s.latestOffset}
            row = {k: v if v is None or isinstance(v, (int, str)) else json.dumps(v) for k, v in row.items()}
            # A stream that waits reports the same batch again; its time tells the reports apart.
            at = "".join(c for c in p.timestamp if c.isdigit())
            commits.create_if_absent(self.spark, f"{self.path}/progress/{p.runId}-{p.batchId}-{i}-{at}.json", row)

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        row = {"query": self.names.get(run), "run": run, "failure": event.exception}
        commits.create_if_absent(self.spark, f"{self.path}/ended/{run}.json", row)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All progress reports below ``path``."""
    return spark.read.schema(PROGRESS).json(f"{path}/progress")


def read_ended(spark: SparkSession, path: str) -> DataFrame:
    """Queries that have ended, with the failure if there was one."""
    return spark.read.schema(ENDED).json(f"{path}/ended")


def live_offsets(progress: DataFrame) -> DataFrame:
    """``topic, partition, committed_offset, end_offset, lag`` from each partition's last report of a Kafka source.

    Reports of a source whose offsets are not by topic and partition, as those of files, give no rows.
    """
    shape = T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))
    last = progress.groupBy("query", "source").agg(F.max_by(F.struct("end_offsets", "latest_offsets"), F.struct("reported_at", "batch_id")).alias("r"))
    ends, latest = (F.from_json(f"r.{c}", shape).alias(c) for c in ("end_offsets", "latest_offsets"))
    topics = last.select("query", ends, latest).select("query", "latest_offsets", F.explode("end_offsets").alias("topic", "_by_partition"))
    rows = topics.select("query", "latest_offsets", "topic", F.explode("_by_partition").alias("_p", "committed_offset"))
    end = F.coalesce(F.col("latest_offsets")[F.col("topic")][F.col("_p")], F.col("committed_offset"))
    # Two queries may read one topic; each has a row.
    return rows.filter("_p RLIKE '^[0-9]+$'").select(
        "query", "topic", F.col("_p").cast("int").alias("partition"), "committed_offset", end.alias("end_offset"),
        (end - F.col("committed_offset")).alias("lag"),
    )


def admitted(spark: SparkSession, target: str, settings: TopicSettings, pool_bytes: int, active: int = 1) -> TopicSettings:
    """The settings with limits that follow from what the topic has landed: its share of the pool
    of bytes, the interval in which its rate fills that, and the measured size of a record."""
    if landing.committed(spark, target).last < 0:
        return replace(settings, max_batch_bytes=min(settings.max_batch_bytes, pool_bytes // active))
    rolled = landing.topic_rollup(spark, target).filter(F.col("topic") == settings.name)
    budget = telemetry.flush_budget(
        telemetry.rates(rolled), pool_bytes, F.lit(active), F.lit(settings.max_batch_bytes),
        F.lit(settings.min_flush_seconds), F.lit(settings.max_flush_seconds),
    )
    row = budget.join(rolled.select("topic", "bytes", "records"), "topic").first()
    if row is None or not row["records"]:
        return replace(settings, max_batch_bytes=min(settings.max_batch_bytes, pool_bytes // active))
    return replace(
        settings,
        max_batch_bytes=row["max_batch_bytes"],
        min_flush_seconds=row["interval_seconds"],
        average_record_bytes=max(1, round(row["bytes"] / row["records"])),
    )


def land_admitted(
    spark: SparkSession,
    read: Callable[[TopicSettings], DataFrame],
    target: str,
    checkpoint: str,
    schema: Callable[[], T.StructType],
    settings: TopicSettings,
    pool_bytes: int,
    rounds: int = 1,
    active: int = 1,
    between: Callable[[int, TopicSettings], None] | None = None,
) -> list[TopicSettings]:
    """Land what there is in ``rounds`` runs, each under the limits that the runs before it call for.

    ``read`` makes the stream for the settings of a run; ``between`` hears of each run before it starts.
    """
    used = []
    for n in range(rounds):
        limits = admitted(spark, target, settings, pool_bytes, active)
        used.append(limits)
        if between:
            between(n, limits)
        landing.land_stream(read(limits), target, checkpoint, schema, limits).awaitTermination()
    return used
