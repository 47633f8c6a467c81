"""Dead letters: what was refused, where it came from, and how it is replayed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stage names and the headers that a replayed record carries.
STAGE_DECODE = "DESERIALIZATION"
STAGE_VALIDATE = "VALIDATION"
STAGE_TRANSFORM = "TRANSFORMATION"
HEADER_TIME = "dlq.replay.time"
HEADER_FAILURE = "dlq.original.failure"


# Marks text that stands for bytes that are no text, or for text that begins so itself.
BASE64 = "base64:"


def as_text(value: Column) -> Column:
    """Bytes as text, from which ``as_bytes`` gets them back whatever they are."""
    data = value.cast("binary")
    text = data.cast("string")
    coded = F.concat(F.lit(BASE64), F.translate(F.base64(data), "\r\n", ""))
    return F.when(F.is_valid_utf8(text) & ~text.startswith(BASE64), text).when(data.isNotNull(), coded)


def as_bytes(text: Column) -> Column:
    coded = F.substring(text, len(BASE64) + 1, 2**31 - 1)
    return F.when(text.startswith(BASE64), F.unbase64(coded)).otherwise(text.cast("binary"))


def header_map(headers: Column) -> Column:
    """Headers ``array<struct<key, value>>`` as a map of texts (``as_text``); of equal names the last counts."""
    last = F.filter(
        headers, lambda x, i: ~F.exists(F.slice(headers, i + 2, F.size(headers)), lambda later: later["key"] == x["key"])
    )
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["key"], as_text(x["value"]))))


def header_array(headers: Column) -> Column:
    """What ``header_map`` was made from, but for repeated names: ``array<struct<key, value: binary>>``."""
    return F.transform(F.map_entries(headers), lambda e: F.struct(e["key"].alias("key"), as_bytes(e["value"]).alias("value")))


def reason_text(violations: Column) -> Column:
    return F.array_join(F.transform(violations, lambda v: F.concat_ws(":", v["column"], v["rule"])), ",")


def dead_letters(
    rejected: DataFrame, failed_at: Column, pipeline: Column, team: Column, schema_version: Column | None = None
) -> DataFrame:
    """One row per refused record, with its payload kept as base64.

    ``value`` is text or binary; its bytes are kept as they came, whether they
    are text or not, and so are those of a binary ``key`` (``as_text``). ``key``, ``headers``, ``schema_id`` and ``failure_stack_trace``
    are kept where the records have them and are null where they do not; a refusal
    by rule has no stack trace of its own. A ``failure_stage`` of the records' own goes before that of their rules.
    """
    undecodable = F.col("payload_error").isNotNull()
    stage = F.when(undecodable, STAGE_DECODE).otherwise(STAGE_VALIDATE)

    def carried(name: str, kind: str):
        return (F.col(name) if name in rejected.columns else F.lit(None)).cast(kind)

    return rejected.select(
        F.col("topic").alias("original_topic"),
        F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"),
        (as_text(F.col("key")) if dict(rejected.dtypes).get("key") == "binary" else carried("key", "string")).alias("original_key"),
        # Some sessions break base64 into lines of 76 characters.
        F.translate(F.base64(F.col("value").cast("binary")), "\r\n", "").alias("original_payload"),
        carried("headers", "map<string,string>").alias("original_headers"),
        F.coalesce(carried("failure_stage", "string"), stage).alias("failure_stage"),
        reason_text(F.col("violations")).alias("failure_reason"),
        carried("failure_stack_trace", "string").alias("failure_stack_trace"),
        failed_at.alias("failure_time"),
        carried("schema_id", "int").alias("schema_id"),
        (schema_version if schema_version is not None else F.lit(None)).cast("int").alias("schema_version"),
        pipeline.alias("pipeline_name"),
        team.alias("team_name"),
    )


def dead_letter_topic(team: Column, topic: Column) -> Column:
    return F.concat(team, F.lit("."), topic, F.lit(".dlq"))


def replay(letters: DataFrame, stage: str, since: Column, now: Column, binary: bool = False) -> DataFrame:
    """Original records of one failure stage, no older than ``since``, with two headers added to their own.

    ``binary`` gives ``key`` and ``value`` as the bytes that came, which need not be text, and
    headers as an array with bytes, as a Kafka writer takes them.
    """
    original = F.unbase64("original_payload")
    added = F.create_map(F.lit(HEADER_TIME), now.cast("string"), F.lit(HEADER_FAILURE), F.col("failure_reason"))
    # A record that is replayed again gets the two anew.
    own = F.map_filter("original_headers", lambda name, _: ~name.isin(HEADER_TIME, HEADER_FAILURE))
    headers = F.when(F.col("original_headers").isNull(), added).otherwise(F.map_concat(own, added))
    return letters.filter((F.col("failure_stage") == stage) & (F.col("failure_time") > since)).select(
        F.col("original_topic").alias("topic"),
        F.col("original_partition").alias("partition"),
        F.col("original_offset").alias("offset"),
        (as_bytes(F.col("original_key")) if binary else F.col("original_key")).alias("key"),
        (original if binary else original.cast("string")).alias("value"),
        (header_array(headers) if binary else headers).alias("headers"),
    )
