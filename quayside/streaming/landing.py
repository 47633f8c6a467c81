"""Landing of topics: each micro-batch becomes one snapshot, exactly once.

Layout of a target table, where W is the writer and N its own number of the batch::

    data/schema_version=V/W/landed_batch=N/
                              accepted rows, declared columns only
    rejects/W/landed_batch=N/ dead letters
    origins/W/landed_batch=N/ topic, partition, offset and hash of every record
    manifest/W/landed_batch=N/
                              files of the batch, as rows of a file catalog
    log/W/landed_batch=N/     offsets, counts, bytes and seconds per topic and partition
    commits/, folds/          numbered commits (``sources/commits.py``); the number
                              of its commit is a batch's snapshot
    schemas/N.json            table schemas
    stops/W/landed_batch=N/   why a topic stopped at that batch

A writer is one checkpoint: Spark gives each a name of its own, also one that
takes the place of a lost one. Every path is named by writer and batch and overwritten, so a retried
batch replaces what an earlier attempt left, and nothing counts before its commit. Several writers may land to one table. A record that another writer
has landed, of the same offset and the same bytes, is not landed again.

Every FOLD_EVERY commits, logs and manifests are put together in one folder, so readers list
that and the commits behind it, however long the table's history is.
"""

from __future__ import annotations

import hashlib
import json
import secrets
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.config import EXPORT_BYTES, TopicSettings
from quayside.functions.sizes import payload_bytes
from quayside.operators import telemetry
from quayside.operators.compact import cast_to, compact, file_rows, union_versions
from quayside.operators.evolve import SchemaConflict, by_field_id, evolve_struct, renamed, with_field_ids
from quayside.operators.quarantine import STAGE_TRANSFORM, dead_letters
from quayside.operators.transform import TransformFailed, failing_records, transform_batch
from quayside.operators.validate import VIOLATIONS, InvalidRecords, accepted, rejected, rule_counts, typed_columns, validate
from quayside.sources import commits
from quayside.sources.catalog import read_if_there
from quayside.sources.topics import decode_json, flush_trigger

BATCH = "landed_batch"
# The writer of batches that no stream has landed, and the one of compacted files.
DIRECT, COMPACTED = "direct", "compacted"
FOLD_EVERY = 64
# How often those who wait for topics look up.
WATCH_SECONDS = 1
# Spark's name of the stream that a batch belongs to.
STREAM_ID = "sql.streaming.queryId"

MANIFEST = """table_id bigint, table_name string, path string, path_is_relative boolean, record_count bigint,
    file_size_bytes bigint, schema_version int"""
LOG = """topic string, partition int, start_offset bigint, end_offset bigint, records bigint, accepted bigint, rejected bigint,
    skipped bigint, bytes bigint, elapsed_seconds double, landed_at timestamp_ntz"""
_ROWS = {"manifest": MANIFEST, "log": LOG}


def _part(target: str, kind: str, writer: str, batch_id: int) -> str:
    return f"{target}/{kind}/{writer}/{BATCH}={batch_id}"


def _data(target: str, version: int, writer: str) -> str:
    return f"{target}/data/schema_version={version}/{writer}"


# --- schemas -----------------------------------------------------------------


def _schema_rows(spark: SparkSession, target: str) -> dict[int, dict]:
    return {n: commits.read_json(spark, f"{target}/schemas/{n}.json") for n in commits.numbered(spark, f"{target}/schemas")}


def _newest_schema(spark: SparkSession, target: str) -> tuple[int, T.StructType, dict] | None:
    newest = max(commits.numbered(spark, f"{target}/schemas"), default=None)
    if newest is None:
        return None
    row = commits.read_json(spark, f"{target}/schemas/{newest}.json")
    return newest, T.StructType.fromJson(row["schema"]), row


def current_schema(spark: SparkSession, target: str) -> tuple[int, T.StructType] | None:
    """Newest version and schema of a table, or None before its first batch."""
    known = _newest_schema(spark, target)
    return known and known[:2]


def _new_table_id() -> int:
    """Rises with the time of creation; random low bits keep tables made at once apart."""
    return time.time_ns() // 1_000_000 << 20 | secrets.randbits(20)


def _change_schema(spark: SparkSession, target: str, change: Callable[[T.StructType | None], T.StructType]) -> tuple[int, T.StructType, int]:
    """Store what ``change`` makes of the newest schema as the next version, unless it is the same; of two that
    change it at once the second starts from what the first made. Returns version, schema and the table's id."""
    while True:
        known = _newest_schema(spark, target)
        wanted = change(known[1] if known else None)
        if known and known[1] == wanted:
            return known[0], known[1], known[2]["table_id"]
        version, before = (known[0] + 1, known[2]) if known else (0, {"table_id": _new_table_id(), "last_field_id": 0})
        schema, last = with_field_ids(wanted, before["last_field_id"])
        row = {"schema": schema.jsonValue(), "table_id": before["table_id"], "last_field_id": last}
        if commits.create_if_absent(spark, f"{target}/schemas/{version}.json", row):
            return version, schema, row["table_id"]


def ensure_table(spark: SparkSession, target: str, declared: T.StructType) -> tuple[int, T.StructType, int]:
    """Create or evolve the table; returns the schema version to land under, that schema and the table's id.

    Each column gets an id that it keeps. The name of the batch column is the table's own: no schema may declare it.
    """
    if BATCH in map(str.lower, declared.names):
        raise SchemaConflict(f"column '{BATCH}': the name is reserved")
    return _change_schema(spark, target, lambda known: evolve_struct(known, declared))


def rename_column(spark: SparkSession, target: str, old: str, new: str) -> int:
    """Give a column a new name; returns the schema version. Files that have the old name are read by the column's id."""
    if new.lower() == BATCH:
        raise SchemaConflict(f"column '{new}': the name is reserved")

    def change(known: T.StructType | None) -> T.StructType:
        if known is None:
            raise SchemaConflict(f"column '{old}': there is no table")
        return renamed(known, old, new)

    return _change_schema(spark, target, change)[0]


# --- what is committed ---------------------------------------------------------


def _extend(ranges: list[list], entry: dict) -> list[list]:
    """Live ranges ``[version, writer, first, last]`` after one more commit."""
    left = []
    for version, writer, first, last in ranges:
        for gone in entry.get("replaces", []):
            if gone["writer"] == writer and first <= gone["first"] and gone["last"] <= last:
                if first < gone["first"]:
                    left.append([version, writer, first, gone["first"] - 1])
                first = gone["last"] + 1
        if first <= last:
            left.append([version, writer, first, last])
    version, writer, batch = entry["schema_version"], entry["writer"], entry["batch"]
    for known in reversed(left):
        if known[1] == writer:
            if known[0] == version and known[3] + 1 == batch:
                known[3] = batch
                return left
            break
    return [*left, [version, writer, batch, batch]]


@dataclass(frozen=True)
class Committed:
    """What a table's commits come to: its newest number, each writer's last batch, and the live ranges of batches."""

    last: int
    last_of: dict[str, int]
    ranges: list[list]
    tail: list[dict]
    folded: str | None
    folded_to: int

    @classmethod
    def of(cls, history: commits.History) -> Committed:
        fold = history.fold or {"last_of": {}, "ranges": [], "path": None, "number": -1}
        last_of, ranges = dict(fold["last_of"]), [list(r) for r in fold["ranges"]]
        for entry in history.tail:
            ranges = _extend(ranges, entry)
            if entry["writer"] != COMPACTED:
                last_of[entry["writer"]] = max(entry["batch"], last_of.get(entry["writer"], -1))
        return cls(history.last, last_of, ranges, history.tail, fold["path"], fold["number"])


def committed(spark: SparkSession, target: str) -> Committed:
    return Committed.of(commits.read_history(spark, target))


def _commit(spark: SparkSession, target: str, entry: dict) -> int | None:
    """Commit a batch unless its writer has done so already; ``replaces`` must still be live."""

    def build(history: commits.History) -> dict | None:
        state = Committed.of(history)
        if state.last_of.get(entry["writer"], -1) >= entry["batch"]:
            return None
        # Compacted files: what they stand for may have been compacted meanwhile.
        for gone in entry.get("replaces", []):
            if not _in_one(state, gone["writer"], gone["first"], gone["last"]):
                raise commits.CommitConflict(f"batches {gone['first']} to {gone['last']} of {gone['writer']} are not live")
        return entry

    number = commits.commit(spark, target, build)
    state = committed(spark, target)
    if state.last - state.folded_to >= FOLD_EVERY:
        fold(spark, target)
    return number


def _tail_rows(spark: SparkSession, target: str, kind: str, state: Committed) -> DataFrame | None:
    """Rows of ``kind`` of the batches behind the fold, each with the number of its commit."""
    paths: dict[str, list[str]] = {}
    for entry in state.tail:
        paths.setdefault(entry["writer"], []).append(_part(target, kind, entry["writer"], entry["batch"]))
    parts = []
    for writer, listed in paths.items():
        shape = T.StructType.fromDDL(_ROWS[kind]).add(BATCH, T.LongType())
        rows = spark.read.schema(shape).option("basePath", f"{target}/{kind}/{writer}").parquet(*listed)
        parts.append(rows.withColumn("_writer", F.lit(writer)))
    if not parts:
        return None
    numbers = [(e["writer"], e["batch"], e["number"]) for e in state.tail]
    numbers = spark.createDataFrame(numbers, f"_writer string, {BATCH} bigint, _number bigint")
    return reduce(DataFrame.unionByName, parts).join(numbers, ["_writer", BATCH])


def _all_rows(spark: SparkSession, target: str, kind: str, state: Committed) -> DataFrame:
    """Rows of ``kind`` of all committed batches: ``_writer``, ``landed_batch`` of that writer, ``_number``, and the rows' own columns."""
    shape = T.StructType.fromDDL(f"_writer string, {BATCH} bigint, {_ROWS[kind]}, _number bigint, _end bigint")
    found = spark.read.schema(shape).parquet(f"{state.folded}/{kind}") if state.folded else spark.createDataFrame([], shape)
    tail = _tail_rows(spark, target, kind, state)
    if tail is not None:
        tail = tail.withColumn("_end", F.lit(None).cast("bigint")).select(*shape.names)
        found = found.unionByName(tail) if state.folded else tail
    gone = [(g["writer"], g["first"], g["last"], e["number"]) for e in state.tail for g in e.get("replaces", [])]
    if kind == "manifest" and gone:
        ended = spark.createDataFrame(gone, "_w string, _first bigint, _last bigint, _by bigint")
        hit = (F.col("_writer") == F.col("_w")) & F.col(BATCH).between(F.col("_first"), F.col("_last"))
        found = found.join(ended, hit, "left").withColumn("_end", F.coalesce("_end", "_by")).select(*shape.names)
    return found


def fold(spark: SparkSession, target: str) -> int:
    """Put logs and manifests of all commits together; returns the number up to which they are folded."""
    state = committed(spark, target)
    path = f"{target}/folded/upto={state.last}-{uuid.uuid4().hex}"
    for kind in _ROWS:
        _all_rows(spark, target, kind, state).write.parquet(f"{path}/{kind}")
    _rollup(spark, target, state).write.parquet(f"{path}/rollup")
    commits.save_fold(spark, target, state.last, {"last_of": state.last_of, "ranges": state.ranges, "path": path})
    return state.last


def _rollup(spark: SparkSession, target: str, state: Committed) -> DataFrame:
    tail = _tail_rows(spark, target, "log", state)
    new = None if tail is None else telemetry.rollup(tail.withColumn("batch_id", F.col("_number")))
    old = spark.read.schema(telemetry.ROLLUP).parquet(f"{state.folded}/rollup") if state.folded else None
    if new is None:
        return old if old is not None else spark.createDataFrame([], telemetry.ROLLUP)
    return new if old is None else telemetry.merge_rollups(old, new)


def topic_rollup(spark: SparkSession, target: str) -> DataFrame:
    """What was landed per topic: counts, sizes, rate. Reads the newest fold's roll-up and the logs behind it, not the whole log."""
    return _rollup(spark, target, committed(spark, target))


# --- landing -------------------------------------------------------------------


def _stop(spark: SparkSession, target: str, topics: DataFrame, writer: str, batch_id: int, reason: str) -> None:
    row = topics.select("topic").distinct().select("topic", F.lit(batch_id).alias("batch_id"), F.lit(reason).alias("reason"))
    row.coalesce(1).write.mode("overwrite").parquet(_part(target, "stops", writer, batch_id))


def _reason_of(refusal: Exception) -> str:
    kinds = {SchemaConflict: "schema_evolution_failed: ", TransformFailed: "transform_failed: "}
    return f"{kinds.get(type(refusal), '')}{refusal}"


_ORIGIN = ["topic", "partition", "offset", "_mark"]


def _landed_by_others(batch: DataFrame, target: str, writer: str, state: Committed) -> tuple[DataFrame | None, list]:
    """Origins of other writers' batches whose offsets meet those of this batch, and its ``(topic, partition, records)``.

    Writers of different topics or of later offsets, the usual cases, are told apart by the log alone.
    """
    if not any(w != writer for w in state.last_of):
        return None, []
    spark = batch.sparkSession
    spans = batch.groupBy("topic", "partition").agg(F.min("offset").alias("_a"), F.max("offset").alias("_b"), F.count("*").alias("_n")).collect()
    shape = "topic string, partition int, _a bigint, _b bigint, _n bigint"
    log = _all_rows(spark, target, "log", state).filter(F.col("_writer") != writer)
    met = (
        log.join(spark.createDataFrame(spans, shape), ["topic", "partition"])
        .filter((F.col("_a") < F.col("end_offset")) & (F.col("_b") >= F.col("start_offset")))
        .groupBy("_writer")
        .agg(F.min(BATCH).alias("first"), F.max(BATCH).alias("last"))
        .collect()
    )
    known = [
        spark.read.parquet(f"{target}/origins/{r['_writer']}").filter(F.col(BATCH).between(r["first"], r["last"])).select(*_ORIGIN)
        for r in met
    ]
    return (reduce(DataFrame.unionByName, known) if known else None), [(s["topic"], s["partition"], s["_n"]) for s in spans]


def land_batch(
    batch: DataFrame,
    batch_id: int,
    target: str,
    declared: T.StructType,
    on_invalid: str = "quarantine",
    table_name: str | None = None,
    writer: str | None = None,
    transform: str | None = None,
) -> None:
    """Land one micro-batch. The records are decoded once and read from the cache,
    which holds typed values of good records and the text of bad ones only.

    A batch that its writer has committed is left as it is when it comes again, and records
    that another writer has landed are skipped and counted so in the log. The writer is the
    stream that the batch belongs to, if any.
    Records may have a ``key`` and ``headers``: dead letters keep them. The files are
    listed under ``table_name``, by default the last part of ``target``. ``transform`` is SQL over
    the accepted rows as ``input``, whose result must have the declared columns; records on which it
    fails become dead letters."""
    spark = batch.sparkSession
    began = time.monotonic()
    writer = writer or spark.sparkContext.getLocalProperty(STREAM_ID) or DIRECT
    state = committed(spark, target)
    if state.last_of.get(writer, -1) >= batch_id:
        return
    try:
        version, stored, table_id = ensure_table(spark, target, declared)
    except SchemaConflict as conflict:
        _stop(spark, target, batch, writer, batch_id, _reason_of(conflict))
        raise
    batch = batch.withColumn("_mark", F.xxhash64(F.col("value").cast("binary")))
    known, given = _landed_by_others(batch, target, writer, state)
    if known is not None:
        same = [F.col(f"b.{c}").eqNullSafe(F.col(f"k.{c}")) for c in _ORIGIN]
        batch = batch.alias("b").join(known.alias("k"), reduce(lambda a, b: a & b, same), "left_anti")
    good = F.size("violations") == 0
    # A transform may refuse any record.
    wanted = F.lit(True) if transform else ~good
    checked = cached = (
        validate(decode_json(batch), declared)
        .select(
            *_ORIGIN,
            *[F.when(wanted, F.col(c)).alias(c) for c in ("value", "key", "headers") if c in batch.columns],
            "payload_error",
            "violations",
            F.when(good, F.struct(*typed_columns(declared))).alias("_row"),
            payload_bytes(F.col("payload")).alias("_size"),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        if on_invalid == "stop":
            worst = rule_counts(checked).orderBy(F.desc("violations"), "column", "rule").limit(1).collect()
            if worst:
                reason = f"invalid_records: {worst[0]['column']} {worst[0]['rule']}"
                _stop(spark, target, checked, writer, batch_id, reason)
                raise InvalidRecords(reason)
        shaped = accepted(checked).select("_row.*")
        if transform:
            try:
                checked = _transform_failures(checked, transform, declared)
                shaped = _transformed(accepted(checked), transform, declared)
                failed = checked.filter(F.col("failure_stage") == STAGE_TRANSFORM).select("failure_reason").limit(1).collect()
                if failed and on_invalid == "stop":
                    raise TransformFailed(failed[0][0])
            except TransformFailed as failure:
                _stop(spark, target, cached, writer, batch_id, _reason_of(failure))
                raise
        data = f"{_data(target, version, writer)}/{BATCH}={batch_id}"
        # With their ids, which Spark writes to the files.
        ids = {f.name: f.metadata for f in stored.fields}
        shaped = shaped.select(*[F.col(f"`{n}`").alias(n, metadata=ids[n]) for n in shaped.columns])
        shaped.write.mode("overwrite").parquet(data)
        dead_letters(
            rejected(checked), F.current_timestamp(), F.col("topic"), F.substring_index("topic", ".", 1), F.lit(version)
        ).write.mode("overwrite").parquet(_part(target, "rejects", writer, batch_id))
        checked.select(*_ORIGIN).write.mode("overwrite").parquet(_part(target, "origins", writer, batch_id))
        name = table_name or target.rstrip("/").rsplit("/", 1)[-1]
        _list_files(spark, data, table_id, name, version, _part(target, "manifest", writer, batch_id))
        counted = checked.groupBy("topic", "partition").agg(
            F.min("offset").alias("start_offset"),
            (F.max("offset") + 1).alias("end_offset"),
            F.count("*").alias("records"),
            F.count_if(good).alias("accepted"),
            F.count_if(~good).alias("rejected"),
            F.coalesce(F.sum("_size"), F.lit(0)).cast("bigint").alias("bytes"),
        )
        if known is not None:
            counted = counted.join(spark.createDataFrame(given, "topic string, partition int, _n bigint"), ["topic", "partition"], "full")
            counted = counted.na.fill(0, ["records", "accepted", "rejected", "bytes"])
        counted.select(
            *["topic", "partition", "start_offset", "end_offset", "records", "accepted", "rejected"],
            (F.col("_n") - F.col("records") if known is not None else F.lit(0)).cast("bigint").alias("skipped"),
            "bytes",
            F.lit(time.monotonic() - began).alias("elapsed_seconds"),
            F.current_timestamp().cast("timestamp_ntz").alias("landed_at"),
        ).coalesce(1).write.mode("overwrite").parquet(_part(target, "log", writer, batch_id))
        _commit(spark, target, {"writer": writer, "batch": batch_id, "schema_version": version})
    finally:
        cached.unpersist()


def _transformed(rows: DataFrame, sql: str, declared: T.StructType) -> DataFrame:
    made = transform_batch(rows.select("_row.*"), sql)
    if set(made.columns) != set(declared.names):
        raise TransformFailed(f"the transform gives {made.columns} where {declared.names} are declared")
    return cast_to(made, declared)


def _transform_failures(checked: DataFrame, sql: str, declared: T.StructType) -> DataFrame:
    """``checked`` with records on which the transform fails marked as refused, by stage, reason and stack trace."""
    failures = failing_records(accepted(checked).select(*_ORIGIN, "_row"), _ORIGIN, lambda rows: _transformed(rows, sql, declared))
    rows = [(*f.key, f"transform {f.condition}", f.trace, STAGE_TRANSFORM) for f in failures]
    shape = "topic string, partition int, offset bigint, _mark bigint, failure_reason string, failure_stack_trace string, failure_stage string"
    marks = checked.sparkSession.createDataFrame(rows, shape)
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"m.{c}")) for c in _ORIGIN]
    joined = checked.alias("c").join(marks.alias("m"), reduce(lambda a, b: a & b, same), "left").select("c.*", "m.failure_reason", "m.failure_stack_trace", "m.failure_stage")
    refused = F.array(F.struct(F.lit("$").alias("column"), F.col("failure_reason").alias("rule"))).cast(VIOLATIONS)
    return joined.withColumn("violations", F.when(F.col("failure_stage").isNotNull(), refused).otherwise(F.col("violations")))


def _list_files(spark: SparkSession, data: str, table_id: int, table_name: str, version: int, path: str) -> None:
    file_rows(spark, data).select(
        F.lit(table_id).alias("table_id"),
        F.lit(table_name).alias("table_name"),
        "path",
        F.lit(False).alias("path_is_relative"),
        "record_count",
        "file_size_bytes",
        F.lit(version).alias("schema_version"),
    ).write.mode("overwrite").parquet(path)


def land_stream(
    records: DataFrame,
    target: str,
    checkpoint: str,
    schema: Callable[[], T.StructType],
    settings: TopicSettings,
    bounded: bool = True,
    on_invalid: str = "quarantine",
    refused: Callable[[str], None] | None = None,
    transform: str | None = None,
) -> StreamingQuery:
    """Start landing a stream; ``schema`` is asked again before every batch.

    Source offsets are committed by the checkpoint once the batch is written.
    ``bounded`` stops when everything available has been landed. ``refused`` is
    told the reason when this run stops over its schema or its records.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        try:
            land_batch(batch, batch_id, target, schema(), on_invalid, settings.table, transform=transform)
        except (SchemaConflict, InvalidRecords, TransformFailed) as refusal:
            if refused:
                refused(_reason_of(refusal))
            raise

    # One name for each checkpoint: the same topic may be landed to two targets at once.
    name = f"land-{settings.name}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    writer = records.writeStream.queryName(name).foreachBatch(flush)
    return writer.option("checkpointLocation", checkpoint).trigger(**flush_trigger(settings, bounded)).start()


@dataclass(frozen=True)
class LandingJob:
    settings: TopicSettings
    records: DataFrame
    schema: Callable[[], T.StructType]
    target: str
    checkpoint: str
    on_invalid: str = "quarantine"
    bounded: bool = True
    transform: str | None = None


def land_topics(
    spark: SparkSession,
    jobs: list[LandingJob],
    told: Callable[[str, str, str | None], None] | None = None,
    until: Callable[[], bool] | None = None,
) -> DataFrame:
    """Land several topics at once, one query each: ``(topic, outcome, reason)``.

    A topic that fails, or that cannot start, stops alone; the others run to
    their end. ``told`` hears of each outcome when it comes, whatever the others do. Jobs that are not
    ``bounded`` run until ``until``, asked every WATCH_SECONDS, says so, and are then ``ended``.
    """
    running, rows = [], []

    def tell(job: LandingJob, outcome: str, reason: str | None = None) -> None:
        rows.append((job.settings.name, outcome, reason))
        if told:
            told(*rows[-1])

    for job in jobs:
        reasons: list[str] = []
        try:
            query = land_stream(
                job.records, job.target, job.checkpoint, job.schema, job.settings, job.bounded, job.on_invalid, reasons.append, job.transform
            )
            running.append((job, query, reasons))
        except Exception as failure:
            tell(job, "not_started", str(failure))
    while running:
        over = [r for r in running if not r[1].isActive]
        running = [r for r in running if r not in over]
        for job, query, reasons in over:
            failure = query.exception()
            if failure is None:
                tell(job, "finished")
            else:
                tell(job, "stopped", reasons[-1] if reasons else str(failure))
        if running and until and until():
            for job, query, _ in running:
                query.stop()
                tell(job, "ended")
            break
        if running:
            # Returns, or raises, as soon as any query ends.
            spark.streams.resetTerminated()
            try:
                spark.streams.awaitAnyTermination(WATCH_SECONDS)
            except StreamingQueryException:
                pass
    return spark.createDataFrame(rows, "topic string, outcome string, reason string")


# --- reading -------------------------------------------------------------------


def read_stops(spark: SparkSession, target: str) -> DataFrame | None:
    """``topic, batch_id, reason``; a batch that stopped again has its last reason."""
    found = [read_if_there(spark, f"{target}/stops/{writer}") for writer in commits.names_in(spark, f"{target}/stops")]
    found = [s.drop(BATCH) for s in found if s is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def read_part(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """``log``, ``rejects`` or ``manifest`` of the committed batches; ``landed_batch`` is the number of the commit."""
    state = committed(spark, target)
    number = F.col("_number")
    if kind == "rejects":
        landed = _all_rows(spark, target, "log", state).select("_writer", BATCH, "_number").distinct()
        parts = [
            spark.read.parquet(f"{target}/rejects/{writer}").withColumn("_writer", F.lit(writer)).join(landed, ["_writer", BATCH])
            for writer in state.last_of
        ]
        return reduce(DataFrame.unionByName, parts).withColumn(BATCH, number).drop("_writer", "_number")
    rows = _all_rows(spark, target, kind, state)
    names = T.StructType.fromDDL(_ROWS[kind]).names
    if kind == "log":
        return rows.select(*names, number.alias("batch_id"), F.col("_writer").alias("landed_by"), number.alias(BATCH))
    return rows.select(
        *names[:-1], number.alias("snapshot_id"), F.col("_end").alias("end_snapshot"), names[-1], number.alias(BATCH)
    )


def flush_log(log: DataFrame) -> DataFrame:
    """``topic, seq, bytes, elapsed_seconds`` of every landed batch, as ``throughput_ema`` reads it."""
    return log.groupBy("topic", F.col("batch_id").alias("seq")).agg(
        F.sum("bytes").cast("bigint").alias("bytes"), F.max("elapsed_seconds").alias("elapsed_seconds")
    )


def snapshots(log: DataFrame) -> DataFrame:
    """``snapshot_id, commit_time`` of the landed batches."""
    return log.groupBy(F.col("batch_id").alias("snapshot_id")).agg(F.max("landed_at").alias("commit_time"))


def offset_continuity(log: DataFrame) -> DataFrame:
    """Where the offset ranges of a partition's batches do not follow one another: ``gap`` or ``overlap``.

    A window spans the batches of one partition of a topic. Offsets of a compacted
    topic have gaps of their own.
    """
    landed = log.filter("records > 0")
    before = Window.partitionBy("topic", "partition").orderBy("start_offset", "end_offset")
    reached = F.max("end_offset").over(before.rowsBetween(Window.unboundedPreceding, -1))
    kind = F.when(F.col("start_offset") > F.col("reached"), "gap").when(F.col("start_offset") < F.col("reached"), "overlap")
    return (
        landed.withColumn("reached", reached)
        .withColumn("kind", kind)
        .filter("kind IS NOT NULL")
        .select("topic", "partition", "batch_id", "reached", "start_offset", "kind")
    )


def _between(writer: str, ranges: list) -> Column:
    """The batches of a writer. Those of compacted files have no order, so each is named."""
    if writer == COMPACTED:
        return F.col(BATCH).isin([first for first, _ in ranges])
    return reduce(lambda a, b: a | b, [F.col(BATCH).between(first, last) for first, last in ranges])


def _rows_of(spark: SparkSession, target: str, version: int, writer: str, schema: T.StructType, ranges: list) -> DataFrame:
    """Rows of a writer's batches under one schema version. Each has a folder of its own, so that none is listed for another."""
    stored = _nullable(schema).add(BATCH, T.LongType())
    return spark.read.schema(stored).parquet(_data(target, version, writer)).filter(_between(writer, ranges))


def _schemas(spark: SparkSession, target: str) -> dict[int, T.StructType]:
    return {n: T.StructType.fromJson(row["schema"]) for n, row in _schema_rows(spark, target).items()}


def read_versions(spark: SparkSession, target: str) -> list[tuple[T.StructType, DataFrame]]:
    """Committed rows per schema version and writer, each read with its own schema.

    A writer's batches are a range or a few: a partition filter, not a list of paths.
    """
    schemas, state = _schemas(spark, target), committed(spark, target)
    live: dict[tuple[int, str], list] = {}
    for version, writer, first, last in state.ranges:
        live.setdefault((version, writer), []).append((first, last))
    return [
        (schemas[version], _rows_of(spark, target, version, writer, schemas[version], live[version, writer]))
        for version, writer in sorted(live)
    ]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """All committed rows under the newest schema."""
    known = current_schema(spark, target)
    parts = [by_field_id(rows, schema, known[1]) for schema, rows in read_versions(spark, target)]
    if not parts:
        return spark.createDataFrame([], known[1] if known else T.StructType([]))
    return union_versions(parts)


def _registered_ranges(manifest: DataFrame, paths: DataFrame) -> list:
    """Runs of batches with registered files: ``schema_version, _writer, registered, first, last``.

    Registration takes batches as they come, so there are few runs. The windows
    run over one row per batch.
    """
    in_version = Window.partitionBy("schema_version", "_writer").orderBy(BATCH)
    in_run = Window.partitionBy("schema_version", "_writer", "known").orderBy(BATCH)
    return (
        manifest.join(paths.select("_path", F.lit(1).alias("_known")), F.col("path") == F.col("_path"), "left")
        .groupBy("schema_version", "_writer", BATCH)
        .agg(F.count("*").alias("files"), F.count("_known").alias("known"))
        .withColumn("known", F.when(F.col("known") == F.col("files"), "all").when(F.col("known") > 0, "some").otherwise("none"))
        .withColumn("run", F.row_number().over(in_version) - F.row_number().over(in_run))
        .withColumn("run", F.when(F.col("_writer") == COMPACTED, F.col(BATCH)).otherwise(F.col("run")))
        .filter("known <> 'none'")
        .groupBy("schema_version", "_writer", F.col("known").alias("registered"), "run")
        .agg(F.min(BATCH).alias("first"), F.max(BATCH).alias("last"))
        .orderBy("schema_version", "_writer", "first")
        .collect()
    )


def read_registered(spark: SparkSession, target: str, registered: DataFrame) -> DataFrame:
    """Rows of the registered files only, under the newest schema.

    The manifest tells which batches to read, so only their folders are scanned.
    Rows are compared with file paths only in a batch of which some files are
    registered and others are not.
    """
    paths = registered.select(F.col("path").alias("_path")).distinct()
    newest, schemas = current_schema(spark, target)[1], _schemas(spark, target)
    ranges = _registered_ranges(_all_rows(spark, target, "manifest", committed(spark, target)), paths)
    parts = []
    for version, writer, kind in sorted({(r["schema_version"], r["_writer"], r["registered"]) for r in ranges}):
        runs = [(r["first"], r["last"]) for r in ranges if (r["schema_version"], r["_writer"], r["registered"]) == (version, writer, kind)]
        rows = _rows_of(spark, target, version, writer, schemas[version], runs)
        if kind == "some":
            rows = rows.withColumn("_path", F.col("_metadata.file_path")).join(paths, "_path", "left_semi")
        parts.append(by_field_id(rows, schemas[version], newest))
    return union_versions(parts) if parts else spark.createDataFrame([], _nullable(newest))


# --- compaction ----------------------------------------------------------------


def compact_table(spark: SparkSession, target: str, target_bytes: int = EXPORT_BYTES) -> list[int]:
    """Rewrite the small files of a table larger; returns the numbers of the commits.

    Batches all of whose files are below half the target size are put together, for each schema version
    on its own; larger files stay. One commit adds the new files and ends the old ones, so that
    readers see each row once before, during and after. If another compaction has ended one of the
    batches meanwhile, the commit is refused and nothing changes. Old files are not deleted.
    """
    schemas, state = _schemas(spark, target), committed(spark, target)
    manifest = _all_rows(spark, target, "manifest", state)
    small = (
        manifest.filter("_end IS NULL")
        .groupBy("schema_version", "_writer", BATCH)
        .agg(F.max("file_size_bytes").alias("largest"), F.count("*").alias("files"), F.max("table_id").alias("table_id"), F.max("table_name").alias("table_name"))
        .filter(F.col("largest") < target_bytes / 2)
        .orderBy("schema_version", "_writer", BATCH)
        .toLocalIterator()
    )
    chosen: dict[int, list] = {}
    names: dict[int, tuple] = {}
    files: dict[int, int] = {}
    for r in small:
        version, found = r["schema_version"], chosen.setdefault(r["schema_version"], [])
        names[version] = r["table_id"], r["table_name"]
        files[version] = files.get(version, 0) + r["files"]
        run = found[-1] if found else None
        # Runs never join batches that some other range parts: each must lie in one live range.
        if run and run[0] == r["_writer"] and run[2] + 1 == r[BATCH] and r["_writer"] != COMPACTED and _in_one(state, run[0], run[1], r[BATCH]):
            run[2] = r[BATCH]
        else:
            found.append([r["_writer"], r[BATCH], r[BATCH]])
    numbers = []
    for version, runs in chosen.items():
        if files[version] < 2:
            continue
        # One scan over all chosen folders, so that files of several writers are packed together.
        folders = [f"{_data(target, version, w)}/{BATCH}={n}" for w, first, last in runs for n in range(first, last + 1)]
        rows = spark.read.schema(_nullable(schemas[version])).parquet(*folders)
        # No other run has this number; it is no batch of any stream.
        batch = time.time_ns() // 1000 << 10 | secrets.randbits(10)
        data = f"{_data(target, version, COMPACTED)}/{BATCH}={batch}"
        compact(rows, data, target_bytes)
        _list_files(spark, data, *names[version], version, _part(target, "manifest", COMPACTED, batch))
        spark.createDataFrame([], LOG).coalesce(1).write.parquet(_part(target, "log", COMPACTED, batch))
        replaces = [{"writer": w, "first": a, "last": b} for w, a, b in runs]
        numbers.append(_commit(spark, target, {"writer": COMPACTED, "batch": batch, "schema_version": version, "replaces": replaces}))
    return numbers


def _in_one(state: Committed, writer: str, first: int, last: int) -> bool:
    return any(r[1] == writer and r[2] <= first and last <= r[3] for r in state.ranges)
