"""Queries that land streams and read back what was landed.

Each run writes below a fresh folder of the shared directory.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.config import MAX_FLUSH_SECONDS, MIN_FLUSH_SECONDS, TopicSettings
from quayside.functions.json_schema import struct_type
from quayside.operators import compact, export, register, telemetry
from quayside.plans import fixtures as X
from quayside.plans.registered import QUERIES, query
from quayside.plans.telemetry_queries import BATCH_BYTES, BATCH_SECONDS
from quayside.plans.topic_queries import SPLIT_AT
from quayside.session import cut_lineage, fresh_dir
from quayside.sources.catalog import describe_columns, live_files, read_if_there
from quayside.sources.topics import read_topic_files
from quayside.streaming import flush, landing, progress

SETTINGS = TopicSettings(name="team.events", table="team.events")
NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _land(records, target, schema=X.EVENT_SCHEMA, times=1, on_invalid="quarantine"):
    for _ in range(times):
        landing.land_stream(
            records, target, f"{target}-checkpoint", lambda: schema, SETTINGS, on_invalid=on_invalid
        ).awaitTermination()
    return target


def _landed(spark, sf_dir, times=1):
    return _land(X.topic_stream(spark, sf_dir, dirty=True), fresh_dir(spark, "landed"), times=times)


_ROWS = """SELECT event_id, user_id, event_type, amount AS "value", CASE WHEN event_id % 20 <> 13 THEN props END AS props
  FROM judged WHERE violations IS NULL"""


@query("K1 K2 P1 T5 T8 T9", _ROWS, X.JUDGED_SQL)
def landed_rows(spark, sf_dir):
    """Land everything there is, resume from the checkpoint, and read the table."""
    return landing.read_table(spark, _landed(spark, sf_dir, times=2))


@query("S1 S2 K1 T4 T9", _ROWS, X.JUDGED_SQL)
def landed_from_files(spark, sf_dir):
    """The same over files of JSON records, a few files per micro-batch."""
    source = fresh_dir(spark, "topic")
    X.topic_log(spark, sf_dir, dirty=True).write.option("timestampNTZFormat", NTZ).json(source)
    records = read_topic_files(spark, source, max_bytes=X.MICRO_BATCH_BYTES)
    return landing.read_table(spark, _land(records, fresh_dir(spark, "landed")))


@query(
    "K6 S5 A4 A7 T10",
    f"""SELECT topic, "partition", min("offset") AS start_offset, max("offset") + 1 AS end_offset, count(*) AS records,
      count(*) FILTER (violations IS NULL) AS accepted, count(*) FILTER (violations IS NOT NULL) AS rejected
    FROM judged GROUP BY ALL""",
    X.JUDGED_SQL,
)
def landed_offsets(spark, sf_dir):
    log = landing.read_part(spark, _landed(spark, sf_dir), "log")
    return log.groupBy("topic", "partition").agg(
        F.min("start_offset").alias("start_offset"),
        F.max("end_offset").alias("end_offset"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("records", "accepted", "rejected")],
    )


@query(
    "D10 D11 K1",
    """SELECT topic AS original_topic, "partition" AS original_partition, "offset" AS original_offset,
      violations AS failure_reason, 0 AS schema_version FROM judged WHERE violations IS NOT NULL""",
    X.JUDGED_SQL,
)
def landed_dead_letters(spark, sf_dir):
    letters = landing.read_part(spark, _landed(spark, sf_dir), "rejects")
    return letters.select("original_topic", "original_partition", "original_offset", "failure_reason", "schema_version")


@query(
    "K1 A5 A13 S9",
    """SELECT count(*) FILTER (violations IS NULL) AS record_count, true AS has_files, true AS has_bytes FROM judged""",
    X.JUDGED_SQL,
)
def landed_manifest(spark, sf_dir):
    manifest = landing.read_part(spark, _landed(spark, sf_dir), "manifest")
    return manifest.agg(
        F.sum("record_count").cast("bigint").alias("record_count"),
        (F.count("*") > 0).alias("has_files"),
        (F.min("file_size_bytes") > 0).alias("has_bytes"),
    )


def _log(spark, sf_dir):
    """The log of a topic landed in three batches, the first of which comes twice."""
    target, log = fresh_dir(spark, "logged"), X.topic_log(spark, sf_dir)
    for n in (0, 1, 2, 0):
        batch = log.filter(F.expr(X.BATCH_OF.format(ts="timestamp")) == n)
        landing.land_batch(batch, n, target, X.EVENT_SCHEMA)
    return landing.read_part(spark, target, "log")


@query("A7 T8 T10", "SELECT topic, CAST(sum(records) AS BIGINT) AS records FROM landing_log GROUP BY topic", X.LANDING_SQL)
def records_consumed(spark, sf_dir):
    return telemetry.consumed(_log(spark, sf_dir))


@query("A8 T8 T10", "SELECT topic, count(DISTINCT batch_id) AS flushes FROM landing_log GROUP BY topic", X.LANDING_SQL)
def flush_counts(spark, sf_dir):
    return telemetry.flushes(_log(spark, sf_dir))


@query(
    "A9 T10",
    """SELECT topic, count(*) AS batches, CAST(sum(bytes) AS BIGINT) AS total_bytes, max(bytes) AS largest_bytes,
      quantile_disc(bytes, 0.5) AS p50
    FROM (SELECT topic, batch_id, CAST(sum(bytes) AS BIGINT) AS bytes FROM landing_log GROUP BY ALL) GROUP BY topic""",
    X.LANDING_SQL,
)
def batch_size_summary(spark, sf_dir):
    return telemetry.batch_sizes(_log(spark, sf_dir), percentiles=(0.5,))


@query(
    "W1 A7 A8 A9 T10",
    """SELECT topic, count(*) AS batches, CAST(sum(records) AS BIGINT) AS records, CAST(sum(bytes) AS BIGINT) AS bytes,
      max(bytes) AS largest_bytes FROM (SELECT topic, batch_id, CAST(sum(bytes) AS BIGINT) AS bytes, sum(records) AS records
      FROM landing_log GROUP BY ALL) GROUP BY topic""",
    X.LANDING_SQL,
)
def topic_rollups(spark, sf_dir):
    """Totals per topic from the roll-up of the first two batches, merged with the log of the third."""
    target, log = fresh_dir(spark, "logged"), X.topic_log(spark, sf_dir)
    for n in range(3):
        if n == 2:
            landing.fold(spark, target)
        landing.land_batch(log.filter(F.expr(X.BATCH_OF.format(ts="timestamp")) == n), n, target, X.EVENT_SCHEMA)
    return landing.topic_rollup(spark, target).select("topic", "batches", "records", "bytes", "largest_bytes")


@query(
    "W1 F8 F9 T10",
    """SELECT topic, count(DISTINCT batch_id) AS flushes, true AS moving, 3000 AS max_batch_bytes, true AS within_bounds
    FROM landing_log GROUP BY topic""",
    X.LANDING_SQL,
)
def landed_throughput(spark, sf_dir):
    """Rates and budgets from what landing logged; its seconds differ from run to run."""
    log = _log(spark, sf_dir)
    rates = cut_lineage(telemetry.throughput_ema(landing.flush_log(log)), "rates")
    budgets = telemetry.flush_budget(
        rates.drop("flushes"), 20000, F.lit(5), F.lit(3000), F.lit(MIN_FLUSH_SECONDS), F.lit(MAX_FLUSH_SECONDS)
    )
    return rates.select("topic", "flushes").join(budgets, "topic").select(
        "topic",
        "flushes",
        (F.col("bytes_per_second") > 0).alias("moving"),
        F.col("max_batch_bytes").cast("int").alias("max_batch_bytes"),
        F.col("interval_seconds").between(MIN_FLUSH_SECONDS, MAX_FLUSH_SECONDS).alias("within_bounds"),
    )


# A table that starts with a whole-number value and one column that goes away,
# then has the value widened and a user column added.
_FIRST = struct_type([("event_id", "BIGINT", False), ("value", "BIGINT", False), ("props", "VARCHAR", True)])
_SECOND = struct_type([("event_id", "BIGINT", False), ("user_id", "BIGINT", False), ("value", "DOUBLE", False)])


def _evolved(spark, sf_dir, target=None, batches=2):
    """The first or both of two batches; a batch that is there already is left as it is."""
    target, log = target or fresh_dir(spark, "evolved"), X.topic_log(spark, sf_dir)
    early = F.col("timestamp") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    whole = F.regexp_replace("value", r'("value":\d+)\.\d+', "$1")
    landing.land_batch(log.filter(early).withColumn("value", whole), 0, target, _FIRST)
    if batches > 1:
        landing.land_batch(log.filter(~early), 1, target, _SECOND)
    return target


_EVOLVED = f"""SELECT event_id, CASE WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN floor("value") ELSE "value" END AS "value",
  CASE WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN props END AS props,
  CASE WHEN ts >= TIMESTAMP '{SPLIT_AT}' THEN user_id END AS user_id FROM events"""


@query("K3 T5 D5 S12 X2 S7", _EVOLVED)
def evolved_table(spark, sf_dir):
    return landing.read_table(spark, _evolved(spark, sf_dir))


@query("S12 K4 J1", f"SELECT * FROM ({_EVOLVED}) WHERE user_id IS NOT NULL")
def registered_rows(spark, sf_dir):
    """Only the second batch's files are registered, so only its rows are read."""
    target = _evolved(spark, sf_dir)
    listed = landing.read_part(spark, target, "manifest").filter(f"{landing.BATCH} = 1")
    return landing.read_registered(spark, target, listed)


def _catalog(spark, target):
    """Live files of a landed table, as its manifest lists them."""
    manifest = landing.read_part(spark, target, "manifest")
    return live_files(manifest, manifest.select("table_id", "table_name").distinct())


@query("S9 S12 J1 J5 K1 K4", _EVOLVED)
def landed_to_registered(spark, sf_dir):
    """Land, list, register and read by what is registered, with another batch landed between two registrations."""
    target, known = fresh_dir(spark, "evolved"), fresh_dir(spark, "registered")
    for batches in (1, 2):
        register.register_files(_catalog(spark, _evolved(spark, sf_dir, target, batches)), known)
    return landing.read_registered(spark, target, register.read_registrations(spark, known))


@query(
    "D1 D2 D3 D4 D5 D7 S12",
    f"""SELECT *, CASE WHEN user_id IS NULL THEN 0 ELSE 1 END AS exported_at,
      CAST((SELECT count(*) FILTER (ts >= TIMESTAMP '{SPLIT_AT}') FROM events) AS BIGINT) AS expirable_rows FROM ({_EVOLVED})""",
)
def exported_table(spark, sf_dir):
    """The export job after each of two batches and twice more; what it wrote, and what may now go.

    The second export is cut off once its files are written: the third run writes them again, under the same name.
    """
    target, out, state = (fresh_dir(spark, name) for name in ("evolved", "exported", "export-state"))
    runs, tries = [], []
    for batches in (1, 2, 2, 2):
        landed = _evolved(spark, sf_dir, target, batches)

        def write(table, snapshot, files):
            compact.compact(landing.read_registered(spark, landed, files), f"{out}/exported_at={snapshot}")
            tries.append(snapshot)
            if tries.count(1) == 1 and snapshot == 1:
                raise OSError("cut off")

        log = landing.read_part(spark, target, "log")
        now = F.current_timestamp().cast("timestamp_ntz")
        runs.append(export.run_export(_catalog(spark, target), landing.snapshots(log), state, now, write, min_bytes=1))
    newest = landing.current_schema(spark, target)[1]
    written = [
        compact.cast_to(spark.read.parquet(f"{out}/exported_at={row['current_snapshot']}"), newest).withColumn(
            "exported_at", F.lit(row["current_snapshot"]).cast("int")
        )
        for run in runs
        for row in run.collect()
    ]
    expirable = export.expirable_files(_catalog(spark, target), export.load_state(spark, state))
    later = expirable.filter("snapshot_id = 1").agg(F.sum("record_count").cast("bigint")).scalar()
    return compact.union_versions(written).withColumn("expirable_rows", later)


@query("K1 K6 T8", f"SELECT *, (SELECT count(*) FILTER (\"timestamp\" < TIMESTAMP '{SPLIT_AT}') FROM judged) AS skipped FROM ({_ROWS})", X.JUDGED_SQL)
def landed_by_two_checkpoints(spark, sf_dir):
    """One checkpoint lands the first files of a topic; it is lost, and the one in its place reads everything again."""
    source, target, log = fresh_dir(spark, "topic"), fresh_dir(spark, "landed"), X.topic_log(spark, sf_dir, dirty=True)
    early = F.col("timestamp") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    for part, checkpoint in ((early, "first"), (~early, "second")):
        log.filter(part).write.mode("append").option("timestampNTZFormat", NTZ).json(source)
        records = read_topic_files(spark, source, max_bytes=X.MICRO_BATCH_BYTES)
        landing.land_stream(records, target, f"{target}-{checkpoint}", lambda: X.EVENT_SCHEMA, SETTINGS).awaitTermination()
    skipped = landing.read_part(spark, target, "log").agg(F.sum("skipped").cast("bigint")).scalar()
    return landing.read_table(spark, target).withColumn("skipped", skipped)


@query("S2 T2 T4 F8 F9", f"SELECT *, true AS several, true AS within FROM ({_ROWS})", X.JUDGED_SQL)
def landed_in_admitted_batches(spark, sf_dir):
    """Files of a topic in two runs: the first under a share of the pool, the second under what the log calls for.

    A quarter of the topic's bytes is what a micro-batch may read, so several are needed at any size.
    """
    source, target, log = fresh_dir(spark, "topic"), fresh_dir(spark, "landed"), X.topic_log(spark, sf_dir, dirty=True)
    halves = [F.pmod(F.xxhash64("offset"), F.lit(2)) == n for n in range(2)]
    texts = log.repartition(8, "offset").withColumn("topic", F.lit(SETTINGS.name))
    texts.filter(halves[0]).write.option("timestampNTZFormat", NTZ).json(source)
    sizes = spark.read.format("binaryFile").load(source).agg(F.sum("length").cast("bigint"))
    pool = max(1, sizes.first()[0] // 2)

    def between(n, limits):
        if n:
            texts.filter(halves[n]).write.mode("append").option("timestampNTZFormat", NTZ).json(source)

    def read(limits):
        return read_topic_files(spark, source, max_bytes=limits.max_batch_bytes)

    used = progress.land_admitted(
        spark, read, target, f"{target}-checkpoint", lambda: X.EVENT_SCHEMA, SETTINGS, pool, rounds=2, active=1, between=between
    )
    rolled = landing.topic_rollup(spark, target)
    most = max(u.max_batch_bytes for u in used)
    return landing.read_table(spark, target).select(
        "*", rolled.select(F.col("batches") >= 3).scalar().alias("several"), rolled.select(F.col("largest_bytes") <= most).scalar().alias("within")
    )


_TOTALS = ("records", "accepted", "rejected", "skipped")


@query(
    "K1 K6 T8 S5",
    """SELECT topic, count(*) AS records, count(*) FILTER (violations IS NULL) AS accepted,
      count(*) FILTER (violations IS NOT NULL) AS rejected, 0 AS skipped FROM judged GROUP BY topic""",
    X.JUDGED_SQL,
)
def topics_into_one_table(spark, sf_dir):
    """Every topic has its own checkpoint and all land to one table at once; a count of what each has landed."""
    target, jobs = fresh_dir(spark, "landed"), []
    for (topic,) in X.topic_log(spark, sf_dir).select("topic").distinct().orderBy("topic").collect():
        records = X.topic_stream(spark, sf_dir, dirty=True).filter(F.col("topic") == topic)
        settings = TopicSettings(name=topic, table="team.events")
        jobs.append(landing.LandingJob(settings, records, lambda: X.EVENT_SCHEMA, target, f"{target}-{topic}"))
    landing.land_topics(spark, jobs)
    return landing.read_part(spark, target, "log").groupBy("topic").agg(*[F.sum(c).cast("bigint").alias(c) for c in _TOTALS])


@query(
    "P9 S9 D4 D5 J5",
    """SELECT event_id, "value", true AS fewer_files, count(*) OVER () AS live_rows, 2 * count(*) OVER () AS listed_rows FROM events""",
)
def compacted_table(spark, sf_dir):
    """Three batches put together by one commit: each row is read once, of live files; the old ones are listed with their end."""
    target, log = fresh_dir(spark, "compacted"), X.topic_log(spark, sf_dir)
    for n in range(3):
        landing.land_batch(log.filter(F.expr(X.BATCH_OF.format(ts="timestamp")) == n), n, target, X.EVENT_SCHEMA)
    landing.compact_table(spark, target)
    manifest = landing.read_part(spark, target, "manifest")
    live, gone = F.col("end_snapshot").isNull(), F.col("end_snapshot").isNotNull()
    counts = manifest.agg(
        (F.count_if(live) < F.count_if(gone)).alias("fewer_files"),
        F.sum(F.when(live, F.col("record_count"))).cast("bigint").alias("live_rows"),
        F.sum("record_count").cast("bigint").alias("listed_rows"),
    )
    rows = landing.read_table(spark, target).select("event_id", "value")
    return rows.select("*", *[counts.select(c).scalar().alias(c) for c in counts.columns])


@query(
    "D9 D10 T7",
    """SELECT event_id, "value" / (event_id - 7) AS "value", upper(event_type) AS event_type, 1 AS refused,
      'TRANSFORMATION' AS stage FROM events WHERE event_id <> 7""",
)
def landed_transform(spark, sf_dir):
    """SQL over each micro-batch; the one record that it cannot compute becomes a dead letter and the others land."""
    target = fresh_dir(spark, "transformed")
    sql = 'SELECT event_id, user_id, upper(event_type) AS event_type, value / (event_id - 7) AS value, props FROM input'
    records = X.topic_stream(spark, sf_dir)
    landing.land_stream(records, target, f"{target}-checkpoint", lambda: X.EVENT_SCHEMA, SETTINGS, transform=sql).awaitTermination()
    refused = landing.read_part(spark, target, "rejects").agg(F.count("*").alias("n"), F.max("failure_stage").alias("stage"))
    rows = landing.read_table(spark, target).select("event_id", "value", "event_type")
    return rows.select("*", refused.select("n").scalar().alias("refused"), refused.select("stage").scalar().alias("stage"))


@query(
    "S10 K2 K3",
    """SELECT * FROM (VALUES (0, 'event_id', 'BIGINT', false), (1, 'value', 'DOUBLE', false), (2, 'props', 'VARCHAR', true),
      (3, 'user_id', 'BIGINT', true)) v(pos, name, type, nullable), (SELECT count(*) AS rows FROM events)""",
)
def described_table(spark, sf_dir):
    target = _evolved(spark, sf_dir)
    _, schema = landing.current_schema(spark, target)
    columns = describe_columns(spark, "events", schema)
    rows = landing.read_part(spark, target, "manifest").agg(F.sum("record_count")).scalar()
    return columns.select("pos", "name", "type", "nullable", rows.alias("rows"))


def _jobs(spark, sf_dir, dirty=(), on_invalid="quarantine"):
    root = fresh_dir(spark, "topics")
    jobs = []
    topics = X.topic_log(spark, sf_dir).select("topic").distinct().orderBy("topic").collect()
    for (topic,) in topics:
        records = X.topic_stream(spark, sf_dir, dirty=topic in dirty).filter(F.col("topic") == topic)
        target = f"{root}/{topic}"
        settings = TopicSettings(name=topic, table=topic)
        jobs.append(
            landing.LandingJob(settings, records, lambda: X.EVENT_SCHEMA, target, f"{target}-checkpoint", on_invalid)
        )
    return jobs


@query(
    "T6 T7 A10",
    """SELECT topic, CASE WHEN bad THEN 'stopped' ELSE 'finished' END AS outcome, CASE WHEN bad THEN 'invalid_records' END AS reason
    FROM (SELECT topic, bool_or(violations IS NOT NULL AND event_type IN ('click', 'view')) AS bad FROM judged GROUP BY topic)""",
    X.JUDGED_SQL,
)
def topic_outcomes(spark, sf_dir):
    """Two topics hold bad records under the stop policy; the other three go on."""
    outcomes = landing.land_topics(spark, _jobs(spark, sf_dir, dirty=("team.click", "team.view"), on_invalid="stop"))
    # Which rule stops a topic depends on where its first micro-batch ends.
    return outcomes.withColumn("reason", F.substring_index("reason", ":", 1))


def _stopped(spark, sf_dir):
    """Logs and stops of five topics, two of which hold bad records under the stop policy and are tried twice."""
    jobs = _jobs(spark, sf_dir, dirty=("team.click", "team.view"), on_invalid="stop")
    for _ in range(2):
        landing.land_topics(spark, jobs)
    logs, stops = None, None
    for job in jobs:
        log = read_if_there(spark, f"{job.target}/log")
        if log is not None:
            logs = log if logs is None else logs.unionByName(log)
        stop = landing.read_stops(spark, job.target)
        if stop is not None:
            stops = stop if stops is None else stops.unionByName(stop)
    return logs, stops


@query(
    "A10 T7",
    """SELECT topic, 'invalid_records' AS reason, count(DISTINCT topic) AS stops FROM judged
    WHERE violations IS NOT NULL AND event_type IN ('click', 'view') GROUP BY topic""",
    X.JUDGED_SQL,
)
def stops_by_reason(spark, sf_dir):
    """A stop that comes again counts once. Which rule is named depends on where the micro-batch ends."""
    _, stops = _stopped(spark, sf_dir)
    return telemetry.stop_counts(stops.withColumn("reason", F.substring_index("reason", ":", 1)))


@query(
    "A11",
    """SELECT greatest(count(*), 1) AS active FROM (SELECT DISTINCT topic FROM judged WHERE topic NOT IN
      (SELECT topic FROM judged WHERE violations IS NOT NULL AND event_type IN ('click', 'view')))""",
    X.JUDGED_SQL,
)
def active_topics(spark, sf_dir):
    return telemetry.active_topics(*_stopped(spark, sf_dir))


@query(
    "A14 T6",
    """SELECT topic, count(*) AS produced, count(*) FILTER (ok) AS landed, count(*) FILTER (ok AND topic <> 'team.view') AS registered,
      count(*) FILTER (NOT ok) AS not_landed, count(*) FILTER (ok AND topic = 'team.view') AS not_registered
    FROM (SELECT topic, violations IS NULL OR topic <> 'team.error' AS ok FROM judged) GROUP BY topic""",
    X.JUDGED_SQL,
)
def reconciled_counts(spark, sf_dir):
    """One topic has bad records, and one topic's files are not registered yet."""
    jobs = _jobs(spark, sf_dir, dirty=("team.error",))
    landing.land_topics(spark, jobs)
    produced = X.topic_log(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("rows"))
    landed, files = None, None
    for job in jobs:
        name = F.lit(job.settings.name)
        rows = landing.read_table(spark, job.target).agg(F.count("*").alias("rows")).select(name.alias("topic"), "rows")
        listed = landing.read_part(spark, job.target, "manifest").select(
            name.alias("table_name"), "path", "record_count", "file_size_bytes"
        )
        landed = rows if landed is None else landed.unionByName(rows)
        files = listed if files is None else files.unionByName(listed)
    path = fresh_dir(spark, "registered")
    register.register_files(files.filter("table_name <> 'team.view'"), path)
    registered = register.read_registrations(spark, path).select(F.col("table_name").alias("topic"), F.col("record_count").alias("rows"))
    return register.reconcile(produced, landed, registered)


_BATCH_SQL = QUERIES["flush_batches"].sql


@query("W2 T4", f"SELECT * FROM ({_BATCH_SQL}) WHERE closed_by <> 'open'")
def flush_batches_of_stream(spark, sf_dir):
    """The stream gives the batches that have closed, the same ones as the batch job.

    The files of a table come in no particular order, so they are one step.
    """
    out = fresh_dir(spark, "flushes")
    events = X.table(spark, sf_dir, "events")
    sized = X.with_sizes(spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]"))
    return flush.cut_micro_batches(sized, BATCH_BYTES, BATCH_SECONDS, out, f"{out}-checkpoint")
