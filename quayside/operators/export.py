"""Which tables and files are due for export, and what is recorded afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import EXPORT_AGE_MINUTES, EXPORT_BYTES
from quayside.operators.evolve import SchemaConflict
from quayside.sources import commits

STATE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_exported_snapshot", T.LongType()),
        T.StructField("last_export_time", T.TimestampNTZType()),
        T.StructField("export_enabled", T.BooleanType()),
        T.StructField("export_blocked", T.BooleanType()),
        T.StructField("export_blocked_reason", T.StringType()),
    ]
)


def _pending(files: DataFrame, state: DataFrame) -> DataFrame:
    """Files beyond the last exported snapshot of tables that may be exported."""
    return files.join(state, "table_name", "left").filter(
        (F.col("last_exported_snapshot").isNull() | (F.col("snapshot_id") > F.col("last_exported_snapshot")))
        & F.coalesce("export_enabled", F.lit(True))
        & ~F.coalesce("export_blocked", F.lit(False))
    )


def export_candidates(
    files: DataFrame,
    snapshots: DataFrame,
    state: DataFrame,
    now: Column,
    min_bytes: int = EXPORT_BYTES,
    max_age_minutes: int = EXPORT_AGE_MINUTES,
) -> DataFrame:
    """Tables with enough unexported bytes, or whose oldest unexported file is old enough.

    Files are summed per table and snapshot before commit times are looked up,
    so the join sees one row per table and snapshot.
    """
    sums = (
        _pending(files, state)
        .groupBy("table_name", "last_exported_snapshot", "snapshot_id")
        .agg(F.sum("file_size_bytes").alias("_bytes"))
    )
    minutes = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("_oldest").cast("timestamp"))) / 60_000_000
    return (
        sums.join(snapshots.select("snapshot_id", "commit_time"), "snapshot_id")
        .groupBy("table_name", "last_exported_snapshot")
        .agg(
            F.max("snapshot_id").alias("current_snapshot"),
            F.sum("_bytes").cast("bigint").alias("accumulated_bytes"),
            F.min("commit_time").alias("_oldest"),
        )
        .filter((F.col("accumulated_bytes") >= min_bytes) | (minutes >= max_age_minutes))
        .drop("_oldest")
    )


def files_since(files: DataFrame, candidates: DataFrame) -> DataFrame:
    """Files of the candidates that the last export did not cover, up to the snapshot that the state will name.

    Files that land after the candidates were computed wait for the next export.
    """
    since = candidates.select(
        "table_name", F.coalesce("last_exported_snapshot", F.lit(-1)).alias("_since"), F.col("current_snapshot").alias("_to")
    )
    return (
        files.join(since, "table_name")
        .filter((F.col("snapshot_id") > F.col("_since")) & (F.col("snapshot_id") <= F.col("_to")))
        .select("table_name", "path", "snapshot_id", "record_count", "file_size_bytes")
    )


def record_export(state: DataFrame, exported: DataFrame, at: Column) -> DataFrame:
    """Export state after success: an upsert by table.

    ``exported`` is ``(table_name, current_snapshot)``. Tables that were not
    exported keep their row; flags of exported ones are kept too.
    """
    done = exported.select("table_name", F.col("current_snapshot").alias("_to"))
    hit = F.col("_to").isNotNull()
    return state.join(done, "table_name", "full").select(
        "table_name",
        F.coalesce("_to", "last_exported_snapshot").alias("last_exported_snapshot"),
        F.when(hit, at).otherwise(F.col("last_export_time")).alias("last_export_time"),
        F.coalesce("export_enabled", F.lit(True)).alias("export_enabled"),
        F.coalesce("export_blocked", F.lit(False)).alias("export_blocked"),
        "export_blocked_reason",
    )


def block_exports(state: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Block the tables in ``conflicts (table_name, reason)``; the others go on."""
    reasons = conflicts.select("table_name", F.col("reason").alias("_reason"))
    hit = F.col("_reason").isNotNull()
    return state.join(reasons, "table_name", "full").select(
        "table_name",
        "last_exported_snapshot",
        "last_export_time",
        F.coalesce("export_enabled", F.lit(True)).alias("export_enabled"),
        (hit | F.coalesce("export_blocked", F.lit(False))).alias("export_blocked"),
        F.coalesce("_reason", "export_blocked_reason").alias("export_blocked_reason"),
    )


def expirable_files(files: DataFrame, state: DataFrame) -> DataFrame:
    """Files whose snapshot has been exported. Lists them and deletes nothing."""
    exported = state.filter(F.col("last_exported_snapshot").isNotNull()).select("table_name", "last_exported_snapshot")
    return (
        files.join(exported, "table_name")
        .filter(F.col("snapshot_id") <= F.col("last_exported_snapshot"))
        .select("table_name", "path", "snapshot_id", "record_count", "file_size_bytes")
    )


# --- the state and its history -------------------------------------------------
#
#     commits/, folds/   intents, outcomes and states in order (sources/commits.py)
#     states/<name>/     a whole state
#     runs/<name>/       what a run has chosen: due tables and their files
#
# An intent names the files of its tables before the first of them is written. Each table's outcome
# is a commit of its own: done, blocked, or failed. A table that is neither done nor
# blocked is open, and the next run writes it from the same list.


@dataclass(frozen=True)
class _Run:
    """A table that a run has promised to export."""

    run: str
    snapshot: int
    attempts: int = 0
    reason: str | None = None


@dataclass(frozen=True)
class _Ledger:
    """State and open tables as the history tells them."""

    folder: str | None
    open: dict[str, _Run]
    done: list[tuple[str, int, str]]
    blocked: list[tuple[str, str]]

    @classmethod
    def of(cls, history: commits.History) -> _Ledger:
        fold = history.fold or {"folder": None, "open": {}}
        folder, done, blocked = fold["folder"], [], []
        open_ = {table: _Run(**run) for table, run in fold["open"].items()}
        for entry in history.tail:
            kind, table = entry["kind"], entry.get("table")
            if kind == "state":
                folder, done, blocked = entry["folder"], [], []
            elif kind == "intent":
                open_ |= {t: _Run(entry["run"], snapshot) for t, snapshot in entry["tables"].items()}
            elif kind == "failed":
                known = open_[table]
                open_[table] = replace(known, attempts=known.attempts + 1, reason=entry["reason"])
            else:
                run = open_.pop(table)
                done += [(table, run.snapshot, entry["at"])] if kind == "done" else []
                blocked += [(table, entry["reason"])] if kind == "blocked" else []
        return cls(folder, open_, done, blocked)


def _state_of(spark: SparkSession, path: str, ledger: _Ledger) -> DataFrame:
    if ledger.folder:
        state = spark.read.schema(STATE).parquet(f"{path}/states/{ledger.folder}")
    else:
        state = spark.createDataFrame([], STATE)
    for at in sorted({at for _, _, at in ledger.done}):
        # A table may be done twice: what was left open, and what was due then.
        rows = list({t: s for t, s, a in ledger.done if a == at}.items())
        exported = spark.createDataFrame(rows, "table_name string, current_snapshot bigint")
        state = record_export(state, exported, F.lit(at).cast("timestamp_ntz"))
    if ledger.blocked:
        state = block_exports(state, spark.createDataFrame(ledger.blocked, "table_name string, reason string"))
    return state


def save_state(state: DataFrame, path: str, base: commits.History | None = None) -> int:
    """Write a whole state, then the commit that makes it the current one; returns its number.

    Readers follow commits, so they see the old state until the new one is complete. A save that another commit
    has overtaken, since ``base`` or else since its own start, is refused.
    """
    spark = state.sparkSession
    base, folder = base or commits.read_history(spark, path), uuid.uuid4().hex
    state.select(*STATE.names).write.parquet(f"{path}/states/{folder}")

    def build(history: commits.History) -> dict:
        if history.last != base.last:
            raise commits.CommitConflict(f"the state of {path} has changed meanwhile")
        return {"kind": "state", "folder": folder}

    number = commits.commit(spark, path, build)
    still_open = {table: asdict(run) for table, run in _Ledger.of(base).open.items()}
    commits.save_fold(spark, path, number, {"folder": folder, "open": still_open})
    return number


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The current state with the outcomes since it was saved, empty before the first."""
    return _state_of(spark, path, _Ledger.of(commits.read_history(spark, path)))


def open_exports(spark: SparkSession, path: str) -> DataFrame:
    """Tables that a run has begun and not ended: ``table_name, run, current_snapshot, attempts, reason``."""
    ledger = _Ledger.of(commits.read_history(spark, path))
    rows = [(t, r.run, r.snapshot, r.attempts, r.reason) for t, r in sorted(ledger.open.items())]
    return spark.createDataFrame(rows, "table_name string, run string, current_snapshot bigint, attempts int, reason string")


def run_export(
    files: DataFrame,
    snapshots: DataFrame,
    state_path: str,
    now: Column,
    write: Callable[[str, int, DataFrame], None],
    min_bytes: int = EXPORT_BYTES,
    max_age_minutes: int = EXPORT_AGE_MINUTES,
    side_by_side: int = 4,
) -> DataFrame:
    """One run of the export job; returns the exported ``(table_name, current_snapshot)``.

    Tables that an earlier run left open come first, with the files that it had chosen: a run that was
    cut off, or one of whose tables failed, exports each file once. Then the other tables that are
    due are chosen, their files stored under the name of the run, and exported. ``write(table, snapshot, files)``
    exports one table; it names its output by the snapshot and overwrites it. It is called from
    ``side_by_side`` threads, each call a Spark job of its own. A table whose versions conflict is blocked with the reason; one that
    fails otherwise stays open with the reason (``open_exports``); the others go on. Runs of one state
    follow one another: of two at once the second is refused when it writes down its intent or state.
    """
    spark = files.sparkSession
    at = str(spark.range(1).select(now.cast("timestamp_ntz").cast("string")).first()[0])
    ledger = _Ledger.of(commits.read_history(spark, state_path))
    done = _export(spark, state_path, ledger.open, at, write, side_by_side)
    begun = commits.read_history(spark, state_path)
    ledger = _Ledger.of(begun)
    # What is open already is not chosen anew.
    resumed = spark.createDataFrame([(t,) for t in ledger.open], "table_name string")
    state = _state_of(spark, state_path, ledger)
    run = uuid.uuid4().hex
    folder = f"{state_path}/runs/{run}"
    due = export_candidates(files, snapshots, state, now, min_bytes, max_age_minutes).join(resumed, "table_name", "left_anti")
    due.write.parquet(f"{folder}/due")
    due = spark.read.parquet(f"{folder}/due")
    tables = {r["table_name"]: r["current_snapshot"] for r in due.select("table_name", "current_snapshot").collect()}
    if tables:
        files_since(files, due).write.parquet(f"{folder}/files")

        def intend(history: commits.History) -> dict:
            if history.last != begun.last:
                raise commits.CommitConflict(f"another run has begun at {state_path}")
            return {"kind": "intent", "run": run, "tables": tables}

        commits.commit(spark, state_path, intend)
        done += _export(spark, state_path, {t: _Run(run, s) for t, s in tables.items()}, at, write, side_by_side)
    base = commits.read_history(spark, state_path)
    ledger = _Ledger.of(base)
    if ledger.done or ledger.blocked:
        save_state(_state_of(spark, state_path, ledger), state_path, base)
    return spark.createDataFrame(done, "table_name string, current_snapshot bigint")


def _export(
    spark: SparkSession, path: str, tables: dict[str, _Run], at: str, write: Callable[[str, int, DataFrame], None], side_by_side: int
) -> list[tuple[str, int]]:
    """Export each table from the list of its run and commit its outcome."""

    def one(item: tuple[str, _Run]) -> list[tuple[str, int]]:
        table, run = item
        chosen = spark.read.parquet(f"{path}/runs/{run.run}/files").filter(F.col("table_name") == table)
        outcome = {"kind": "done", "table": table, "at": at}
        try:
            write(table, run.snapshot, chosen)
        except SchemaConflict as conflict:
            outcome = {"kind": "blocked", "table": table, "reason": str(conflict)}
        except Exception as failure:
            outcome = {"kind": "failed", "table": table, "reason": str(failure)}
        commits.commit(spark, path, lambda _: outcome)
        return [(table, run.snapshot)] if outcome["kind"] == "done" else []

    with ThreadPoolExecutor(side_by_side) as pool:
        return [row for rows in pool.map(one, sorted(tables.items())) for row in rows]
