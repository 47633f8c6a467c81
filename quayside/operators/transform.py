"""SQL over a batch, and a view of fresh rows beside exported history."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import cut_lineage

# The name under which a transform sees its batch, and the classes of SQL
# states that the data are to blame for: data exceptions, failed functions, raised errors.
INPUT_VIEW = "input"
DATA_STATES = ("22", "38", "39", "P0")
# Records that fail in one batch before the transform itself is held to be wrong.
MOST_FAILURES = 100
# Buckets that a failing set of records is split in, as bits of their hash.
BITS = 4
# Small jobs of one failing set that run side by side.
SIDE_BY_SIDE = 8
_VIEW = threading.Lock()


class TransformFailed(Exception):
    """A transform that fails whatever the data, or on too many records."""


def transform_batch(batch: DataFrame, sql: str) -> DataFrame:
    """Run ``sql`` over a batch that it calls ``input``; works inside ``foreachBatch``."""
    # The name is resolved at once, so the view may be another one's afterwards.
    with _VIEW:
        batch.createOrReplaceTempView(INPUT_VIEW)
        return batch.sparkSession.sql(sql)


@dataclass(frozen=True)
class Failure:
    key: tuple
    condition: str
    trace: str


def _attempt(rows: DataFrame, run: Callable[[DataFrame], DataFrame]) -> PySparkException | None:
    """The data's error, if any. What else goes wrong is raised: a lost executor is no fault of a record."""
    try:
        run(rows).write.format("noop").mode("overwrite").save()
    except (AnalysisException, ParseException) as wrong:
        raise TransformFailed(str(wrong)) from wrong
    except PySparkException as failure:
        if not (failure.getSqlState() or "").startswith(DATA_STATES):
            raise
        return failure
    return None


def failing_records(rows: DataFrame, key: list[str], run: Callable[[DataFrame], DataFrame], most: int | None = None) -> list[Failure]:
    """The records on which ``run`` fails, each with the error's condition and stack trace.

    A set that fails is split by the hash of its key and its parts are run on their own, until one
    record is left or records of one key: sixteen small jobs for each failing set and
    level, so few failures cost little and none cost one run. After a first failure the records are
    stored, and the small jobs read that.
    """
    found: list[Failure] = []
    most = MOST_FAILURES if most is None else most

    def search(part: DataFrame, level: int, failure: PySparkException) -> None:
        bucket = F.shiftrightunsigned("_hash", level * BITS).bitwiseAND(F.lit((1 << BITS) - 1))
        sizes = part.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()
        if len(sizes) == 1 and (sizes[0]["n"] == 1 or level * BITS >= 64):
            for r in part.select(*key).distinct().limit(most + 1).collect():
                found.append(Failure(tuple(r), failure.getCondition() or "", str(failure)))
            if len(found) > most:
                raise TransformFailed(f"over {most} records fail, the last one by {found[-1].condition}")
            return
        inside = [part.filter(bucket == r["bucket"]) for r in sizes]
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            errors = list(pool.map(lambda rows: _attempt(rows.drop("_hash"), run), inside))
        for rows, error in zip(inside, errors):
            if error is not None:
                search(rows, level + 1, error)

    if (first := _attempt(rows, run)) is not None:
        search(cut_lineage(rows.withColumn("_hash", F.xxhash64(*key)), "failing"), 0, first)
    return found


def fresh_view(landed: DataFrame, history: DataFrame, since: Column, exported_snapshot: Column) -> DataFrame:
    """History plus the landed rows it lacks, as far back as ``since``.

    Rows up to the exported snapshot are in the history already. Both inputs
    carry ``snapshot_id`` and ``ts``; the filters reach the file scans.
    """
    fresh = landed.filter((F.col("ts") >= since) & (F.col("snapshot_id") > exported_snapshot))
    return history.withColumn("origin", F.lit("history")).unionByName(
        fresh.withColumn("origin", F.lit("landed")), allowMissingColumns=True
    )
