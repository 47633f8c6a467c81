"""Topics as DataFrames ``(topic, partition, offset, timestamp, value)``; ``value`` is text or bytes.

Records of Kafka have a ``key`` and ``headers`` too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from quayside.config import TopicSettings
from quayside.operators.quarantine import header_map

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("value", T.StringType()),
    ]
)


def read_topic(spark: SparkSession, settings: TopicSettings, brokers: str) -> DataFrame:
    """Stream of one Kafka topic from its earliest record.

    The checkpoint of the query that consumes it takes the place of a consumer
    group: nothing is committed to the broker.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
    reader = reader.option("subscribe", settings.name).option("startingOffsets", "earliest")
    reader = reader.option("includeHeaders", "true")
    reader = reader.options(**kafka_limits(settings)).options(**settings.reader_options)
    try:
        raw = reader.load()
    except AnalysisException as missing:
        raise RuntimeError("the Kafka connector is not on the class path of this session") from missing
    return raw.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        # As bytes, so that what is no text can be kept as it came.
        "value",
        "key",
        header_map(F.col("headers")).alias("headers"),
    )


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None):
    """The same stream over JSON files, one record per line."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def kafka_limits(settings: TopicSettings) -> dict[str, str]:
    """Reader options that bound a micro-batch by bytes and by age."""
    most = max(1, settings.max_batch_bytes // max(1, settings.average_record_bytes))
    limits = {
        "maxOffsetsPerTrigger": str(most),
        "minOffsetsPerTrigger": str(max(1, int(most * settings.progress_threshold))),
        "maxTriggerDelay": f"{settings.max_flush_seconds}s",
    }
    if settings.min_read_tasks:
        limits["minPartitions"] = str(settings.min_read_tasks)
    return limits


def flush_trigger(settings: TopicSettings, bounded: bool) -> dict:
    """Trigger of a landing query: everything there is, or once per minimum interval."""
    return {"availableNow": True} if bounded else {"processingTime": f"{settings.min_flush_seconds} seconds"}


def limits_per_topic(sizes: DataFrame, max_batch_bytes: Column, progress_threshold: Column) -> DataFrame:
    """``kafka_limits`` from measured sizes: ``(topic, records, bytes)`` per topic."""
    most = F.greatest(F.lit(1), F.floor(max_batch_bytes * F.col("records") / F.col("bytes"))).cast("bigint")
    return sizes.select(
        "topic",
        most.alias("max_offsets"),
        F.greatest(F.lit(1), F.floor(most * progress_threshold)).cast("bigint").alias("min_offsets"),
        F.ceil(F.lit(1.0) * F.col("records") / most).cast("bigint").alias("micro_batches"),
    )


def decode_json(records: DataFrame, value: str = "value") -> DataFrame:
    """Add ``payload`` (variant) and ``payload_error`` (null when it is an object).

    Text after the closing brace is ignored and a repeated key keeps its last
    value. The root kind is read off the first character, which is enough once
    the text has parsed.
    """
    text = F.col(value).cast("string")
    return records.withColumn("payload", F.try_parse_json(text)).withColumn(
        "payload_error",
        F.when(text.isNull(), "null_value")
        .when(F.col("payload").isNull(), "not_json")
        .when(~text.rlike(r"^\s*\{"), "not_object"),
    )
