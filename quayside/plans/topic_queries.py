"""Queries over topics: decoding, checks, sizes, offsets and lag."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.json_schema import struct_type
from quayside.functions.sizes import payload_bytes, record_bytes
from quayside.operators import lag, quarantine, transform, validate
from quayside.plans import fixtures as X
from quayside.plans.registered import query
from quayside.sources.topics import decode_json, limits_per_topic

FAILED_AT = "2024-02-01 00:00:00"
SPLIT_AT = "2024-01-20 00:00:00"
OPEN_UNTIL = "2024-01-25 00:00:00"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _checked(spark, sf_dir):
    return validate.validate(decode_json(X.topic_log(spark, sf_dir, dirty=True)), X.EVENT_SCHEMA)


@query("S3 P11", 'SELECT "offset", "partition", topic, payload_error FROM decoded', X.JUDGED_SQL + """,
decoded AS (SELECT *, CASE WHEN violations LIKE '$:%' THEN substr(violations, 3) END AS payload_error FROM judged)""")
def decoded_payloads(spark, sf_dir):
    return decode_json(X.topic_log(spark, sf_dir, dirty=True)).select("topic", "partition", "offset", "payload_error")


@query("P2 P3 P4 P5 P11 D11", """SELECT topic, "partition", "offset", violations FROM judged WHERE violations IS NOT NULL""", X.JUDGED_SQL)
def record_violations(spark, sf_dir):
    return validate.rejected(_checked(spark, sf_dir)).select(
        "topic", "partition", "offset", quarantine.reason_text(F.col("violations")).alias("violations")
    )


@query(
    "P2 P3 P4 P5",
    """SELECT topic, split_part(v, ':', 1) AS "column", split_part(v, ':', 2) AS rule, count(*) AS violations
    FROM (SELECT topic, unnest(string_split(violations, ',')) AS v FROM judged WHERE violations IS NOT NULL)
    GROUP BY ALL""",
    X.JUDGED_SQL,
)
def violations_per_rule(spark, sf_dir):
    return validate.rule_counts(_checked(spark, sf_dir))


# A duplicate key keeps its last value, a whole decimal is an integer, and an
# absent or refused text is null.
_ACCEPTED = """SELECT topic, "partition", "offset", event_id, user_id, event_type, amount AS "value",
    CASE WHEN event_id % 20 <> 13 THEN props END AS props FROM judged WHERE violations IS NULL"""


@query("P1 P11 D11", _ACCEPTED, X.JUDGED_SQL)
def accepted_records(spark, sf_dir):
    good = validate.accepted(_checked(spark, sf_dir))
    return validate.conform(good, X.EVENT_SCHEMA, keep=["topic", "partition", "offset"])


@query(
    "P1",
    """SELECT topic, 'extra' AS "key", count(*) AS records FROM judged
    WHERE event_id % 20 = 6 GROUP BY topic""",
    X.JUDGED_SQL,
)
def undeclared_keys(spark, sf_dir):
    decoded = decode_json(X.topic_log(spark, sf_dir, dirty=True))
    return validate.unknown_keys(decoded, X.EVENT_SCHEMA)


_LENIENT = struct_type([("event_id", "BIGINT", False), ("user_id", "BIGINT", True), ("value", "DOUBLE", True)])


@query(
    "P1 P2 P3",
    """SELECT "offset", TRY_CAST(json_extract_string(ok, '$.user_id') AS BIGINT) AS user_id,
    TRY_CAST(CASE WHEN event_id % 20 = 10 THEN CAST(amount AS VARCHAR) ELSE json_extract_string(ok, '$.value') END AS DOUBLE) AS "value"
    FROM (SELECT *, CASE WHEN json_valid("value") THEN "value" END AS ok FROM judged)
    WHERE ok IS NOT NULL AND json_type(ok) = 'OBJECT' AND event_id % 20 NOT IN (1, 2, 3, 9)""",
    X.JUDGED_SQL,
)
def coerced_records(spark, sf_dir):
    """Lenient reading: a number in quotes is taken as the number."""
    checked = validate.validate(decode_json(X.topic_log(spark, sf_dir, dirty=True)), _LENIENT, coerce=True)
    return validate.conform(validate.accepted(checked), _LENIENT, keep=["offset"], coerce=True).drop("event_id")


@query(
    "A3 A7 F1 F5 S3",
    f"""SELECT topic, count(*) AS records, count(*) FILTER (violations IS NULL) AS accepted,
      count(*) FILTER (violations IS NOT NULL) AS rejected,
      CAST(coalesce(sum(CASE
        WHEN violations LIKE '$:%' THEN NULL
        WHEN event_id % 20 = 0 THEN full_bytes - 8
        WHEN event_id % 20 = 1 THEN full_bytes - 8 + 2 * 3 + 24
        WHEN event_id % 20 = 6 THEN full_bytes + 8
        WHEN event_id % 20 = 7 THEN full_bytes - (2 * length(event_type) + 24) + 8
        WHEN event_id % 20 = 11 THEN full_bytes - (2 * length(props) + 24) + 8
        WHEN event_id % 20 = 13 THEN full_bytes - (2 * length(props) + 24)
        WHEN event_id % 20 = 14 THEN full_bytes - 8 + 2 * length(CAST(user_id AS VARCHAR)) + 24
        ELSE full_bytes END), 0) AS BIGINT) AS bytes
    FROM (SELECT *, {X.CLEAN_BYTES_SQL} AS full_bytes FROM judged) GROUP BY topic""",
    X.JUDGED_SQL,
)
def landing_summary(spark, sf_dir):
    """Records, accepted, rejected and estimated bytes per topic."""
    return validate.summary(_checked(spark, sf_dir), payload_bytes(F.col("payload")))


@query(
    "F5",
    """SELECT doc_id, CAST(8 + 8 + 3 * 24
      + 2 * (length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))
      + 2 * length(lang) + 2 * length(source) AS BIGINT) AS bytes FROM documents""",
)
def document_sizes(spark, sf_dir):
    documents = X.table(spark, sf_dir, "documents")
    return documents.select("doc_id", record_bytes(documents.schema).alias("bytes"))


@query("A3 F5", f"""SELECT topic, "partition", CAST(sum({X.CLEAN_BYTES_SQL}) AS BIGINT) AS bytes FROM topic_log GROUP BY ALL""", X.TOPIC_SQL)
def batch_bytes(spark, sf_dir):
    decoded = decode_json(X.topic_log(spark, sf_dir))
    return decoded.groupBy("topic", "partition").agg(F.sum(payload_bytes(F.col("payload"))).alias("bytes"))


@query("S4", """SELECT topic, "partition", max("offset") + 1 AS end_offset FROM topic_log GROUP BY ALL""", X.TOPIC_SQL)
def end_offsets(spark, sf_dir):
    return lag.end_offsets(X.topic_log(spark, sf_dir))


@query(
    "A4",
    f"""SELECT topic, "partition", min("offset") AS start_offset FROM topic_log
    WHERE "timestamp" >= TIMESTAMP '{SPLIT_AT}' GROUP BY ALL""",
    X.TOPIC_SQL,
)
def batch_start_offsets(spark, sf_dir):
    return lag.start_offsets(X.topic_log(spark, sf_dir).filter(F.col("timestamp") >= _at(SPLIT_AT)))


def _landed_before(spark, sf_dir):
    """Landing log up to a moment; one partition of one topic never landed."""
    log = X.topic_log(spark, sf_dir).filter(F.col("timestamp") < _at(SPLIT_AT))
    log = log.filter(~((F.col("topic") == "team.error") & (F.col("partition") == 3)))
    return lag.end_offsets(log)


_COMMITTED = f"""landed AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM topic_log
  WHERE "timestamp" < TIMESTAMP '{SPLIT_AT}' AND NOT (topic = 'team.error' AND "partition" = 3) GROUP BY ALL)"""


@query(
    "S5 K6",
    """SELECT p.topic, p."partition", coalesce(l.end_offset, 0) AS committed_offset
    FROM (SELECT DISTINCT topic, "partition" FROM topic_log) p LEFT JOIN landed l USING (topic, "partition")""",
    X.TOPIC_SQL + ",\n" + _COMMITTED,
)
def committed_offsets(spark, sf_dir):
    return lag.committed_offsets(X.topic_log(spark, sf_dir), _landed_before(spark, sf_dir))


def _progress(spark, sf_dir):
    log = X.topic_log(spark, sf_dir)
    batch = log.filter((F.col("timestamp") >= _at(SPLIT_AT)) & (F.col("timestamp") < _at(OPEN_UNTIL)))
    # One partition's watermark is unknown and one has no consumed position yet.
    ends = lag.end_offsets(log).filter("NOT (topic = 'team.view' AND partition = 0)")
    seen = lag.end_offsets(batch).withColumnRenamed("end_offset", "position")
    seen = seen.filter("NOT (topic = 'team.click' AND partition = 1)")
    return lag.lag_progress(lag.start_offsets(batch), ends, seen, threshold=0.4)


_PROGRESS = f"""batch AS (SELECT topic, "partition", min("offset") AS start_offset, max("offset") + 1 AS seen FROM topic_log
  WHERE "timestamp" >= TIMESTAMP '{SPLIT_AT}' AND "timestamp" < TIMESTAMP '{OPEN_UNTIL}' GROUP BY ALL),
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM topic_log
  GROUP BY ALL HAVING NOT (topic = 'team.view' AND "partition" = 0)),
progress AS (
  SELECT topic, "partition", start_offset, end_offset, pos AS "position",
    CASE WHEN end_offset > start_offset THEN CAST(pos - start_offset AS DOUBLE) / (end_offset - start_offset) END AS progress
  FROM (SELECT *, CASE WHEN topic = 'team.click' AND "partition" = 1 THEN start_offset ELSE seen END AS pos
        FROM batch JOIN ends USING (topic, "partition")))"""


@query(
    "J6 F10 T3",
    """SELECT topic, "partition", start_offset, end_offset, "position", progress, coalesce(progress > 0.4, false) AS flush FROM progress""",
    X.TOPIC_SQL + ",\n" + _PROGRESS,
)
def lag_progress(spark, sf_dir):
    return _progress(spark, sf_dir)


@query(
    "F10 T3",
    """SELECT topic, bool_or(coalesce(progress > 0.4, false)) AS flush, max(progress) AS progress FROM progress GROUP BY topic""",
    X.TOPIC_SQL + ",\n" + _PROGRESS,
)
def flush_by_progress(spark, sf_dir):
    return lag.topics_to_flush(_progress(spark, sf_dir))


@query(
    "S2 T1 T2 T4",
    f"""SELECT topic, most AS max_offsets, greatest(1, CAST(floor(most * 0.5) AS BIGINT)) AS min_offsets,
      CAST(ceil(1.0 * records / most) AS BIGINT) AS micro_batches
    FROM (SELECT topic, count(*) AS records,
      greatest(1, CAST(floor(65536 * CAST(count(*) AS DOUBLE) / sum({X.CLEAN_BYTES_SQL})) AS BIGINT)) AS most
      FROM topic_log GROUP BY topic)""",
    X.TOPIC_SQL,
)
def trigger_limits(spark, sf_dir):
    """Offsets per trigger that keep a micro-batch within its byte budget."""
    sizes = X.sized_topic(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("records"), F.sum("bytes").alias("bytes"))
    return limits_per_topic(sizes, F.lit(65536).cast("double"), F.lit(0.5))


_LETTERS = f"""letters AS (
  SELECT topic AS original_topic, "partition" AS original_partition, "offset" AS original_offset, 'k' || "offset" AS original_key,
    '{{"from":"' || topic || '"}}' AS original_headers, to_base64(encode("value")) AS original_payload,
    CASE WHEN violations LIKE '$:%' THEN 'DESERIALIZATION' ELSE 'VALIDATION' END AS failure_stage,
    violations AS failure_reason, "timestamp" AS failure_time, CAST(NULL AS INTEGER) AS schema_version,
    CAST(NULL AS VARCHAR) AS failure_stack_trace, CAST(NULL AS INTEGER) AS schema_id,
    topic AS pipeline_name, 'team' AS team_name, topic AS topic, "value" AS payload
  FROM judged WHERE violations IS NOT NULL)"""


def _letters(spark, sf_dir):
    refused = validate.rejected(_checked(spark, sf_dir)).withColumns(
        {"key": F.concat(F.lit("k"), F.col("offset")), "headers": F.create_map(F.lit("from"), F.col("topic"))}
    )
    return quarantine.dead_letters(refused, F.col("timestamp"), F.col("topic"), F.substring_index("topic", ".", 1))


@query("D10", "SELECT * EXCLUDE (topic, payload), team_name || '.' || topic || '.dlq' AS letter_topic FROM letters", X.JUDGED_SQL + ",\n" + _LETTERS)
def dead_letters(spark, sf_dir):
    letters = _letters(spark, sf_dir)
    return letters.withColumn("original_headers", F.to_json("original_headers")).withColumn(
        "letter_topic", quarantine.dead_letter_topic(F.col("team_name"), F.col("original_topic"))
    )


@query(
    "D12",
    f"""SELECT original_topic AS topic, original_partition AS "partition", original_offset AS "offset", original_key AS "key",
      payload AS "value", topic AS origin,
      '{FAILED_AT}' AS replay_time, failure_reason AS original_failure
    FROM letters WHERE failure_stage = 'VALIDATION' AND failure_time > TIMESTAMP '{SPLIT_AT}'""",
    X.JUDGED_SQL + ",\n" + _LETTERS,
)
def replayed_letters(spark, sf_dir):
    replayed = quarantine.replay(_letters(spark, sf_dir), quarantine.STAGE_VALIDATE, _at(SPLIT_AT), _at(FAILED_AT))
    return replayed.withColumns(
        {
            "replay_time": F.col("headers")[quarantine.HEADER_TIME],
            "origin": F.col("headers")["from"],
            "original_failure": F.col("headers")[quarantine.HEADER_FAILURE],
        }
    ).drop("headers")


@query(
    "D12 S1",
    f"""SELECT original_offset AS "offset", upper(md5(CAST(original_offset AS VARCHAR))) AS "key", payload AS "value",
      upper(md5(topic)) AS origin FROM letters WHERE failure_stage = 'VALIDATION' AND failure_time > TIMESTAMP '{SPLIT_AT}'""",
    X.JUDGED_SQL + ",\n" + _LETTERS,
)
def replayed_bytes(spark, sf_dir):
    """Keys and headers that are no text come back as the bytes that they were."""
    headers = F.array(F.struct(F.lit("from").alias("key"), F.unhex(F.md5("topic")).alias("value")))
    refused = validate.rejected(_checked(spark, sf_dir)).withColumns(
        {"key": F.unhex(F.md5(F.col("offset").cast("string"))), "headers": quarantine.header_map(headers)}
    )
    letters = quarantine.dead_letters(refused, F.col("timestamp"), F.col("topic"), F.substring_index("topic", ".", 1))
    replayed = quarantine.replay(letters, quarantine.STAGE_VALIDATE, _at(SPLIT_AT), _at(FAILED_AT), binary=True)
    origin = F.filter("headers", lambda h: h["key"] == "from")[0]["value"]
    return replayed.select("offset", F.hex("key").alias("key"), F.col("value").cast("string").alias("value"), F.hex(origin).alias("origin"))


@query(
    "D9",
    """SELECT event_type, count(*) AS records, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS total
    FROM topic_log WHERE amount > 10 GROUP BY event_type""",
    X.TOPIC_SQL,
)
def transformed_batch(spark, sf_dir):
    batch = validate.conform(decode_json(X.topic_log(spark, sf_dir)), X.EVENT_SCHEMA)
    return transform.transform_batch(
        batch,
        """SELECT event_type, count(*) AS records,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS total
        FROM input WHERE value > 10 GROUP BY event_type""",
    )
