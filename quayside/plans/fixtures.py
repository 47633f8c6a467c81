"""Inputs of the operators, derived from the driver's tables.

Row-level expressions are written once, in SQL that Spark and DuckDB both read;
only what differs between the two is written twice. A topic's offset is the
event id: it rises within a partition and has gaps, as offsets of a compacted
topic do, so no ordering step is needed to make it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.json_schema import struct_type
from quayside.functions.lake_types import SIMPLE_TYPES
from quayside.functions.names import LAKE_DIRECTORY
from quayside.functions.sizes import record_bytes
from quayside.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- topics ---------------------------------------------------------------

# Most that one micro-batch reads: a landed batch is cached while it is split.
MICRO_BATCH_BYTES = 64 * 1024**3

EVENT_SCHEMA = struct_type(
    [
        ("event_id", "BIGINT", False),
        ("user_id", "BIGINT", False),
        ("event_type", "VARCHAR", False),
        ("value", "DOUBLE", False),
        ("props", "VARCHAR", True),
    ]
)

_PROPS_TEXT = """',"props":"' || replace(props, '"', chr(92) || '"') || '"'"""
_CLEAN = f"""'{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
    || '","value":' || value || {_PROPS_TEXT} || '}}'"""

# One planted fault for most of every twenty events.
_DIRTY = f"""CASE event_id % 20
    WHEN 4 THEN '{{"event_id":' || event_id || ',"user_id"'
    WHEN 5 THEN '[' || event_id || ']'
    WHEN 8 THEN NULL
    ELSE '{{"event_id":' || event_id
      || CASE event_id % 20
           WHEN 0 THEN ''
           WHEN 3 THEN ',"user_id":' || user_id || '.5'
           WHEN 9 THEN ',"user_id":18446744073709551616' || user_id
           WHEN 12 THEN ',"user_id":' || user_id || '.0'
           WHEN 14 THEN ',"user_id":"' || user_id || '"'
           ELSE ',"user_id":' || user_id END
      || CASE event_id % 20 WHEN 7 THEN ',"event_type":null' ELSE ',"event_type":"' || event_type || '"' END
      || CASE event_id % 20
           WHEN 1 THEN ',"value":"abc"'
           WHEN 2 THEN ',"value":1e999'
           WHEN 10 THEN ',"value":-1,"value":' || value
           ELSE ',"value":' || value END
      || CASE event_id % 20 WHEN 11 THEN ',"props":' || props WHEN 13 THEN '' ELSE {_PROPS_TEXT} END
      || CASE event_id % 20 WHEN 6 THEN ',"extra":true' ELSE '' END
      || '}}' END"""


def as_topic(events: DataFrame, dirty: bool = False) -> DataFrame:
    return events.select(
        F.expr("'team.' || event_type").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.expr(_DIRTY if dirty else _CLEAN).alias("value"),
    )


def topic_log(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return as_topic(table(spark, sf_dir, "events"), dirty)


def topic_stream(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """The same as a stream. The bracket makes the path a pattern, which lets a
    file stream read a table that is a single file."""
    events = table(spark, sf_dir, "events")
    reader = spark.readStream.schema(events.schema).option("maxBytesPerTrigger", MICRO_BATCH_BYTES)
    return as_topic(reader.parquet(f"{sf_dir}/events.parque[t]"), dirty)


def _topic_sql(name: str, text: str) -> str:
    return f"""{name} AS (
  SELECT 'team.' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         ts AS "timestamp", {text} AS "value", event_id, user_id, event_type, events."value" AS amount, props
  FROM events)"""


TOPIC_SQL = _topic_sql("topic_log", _CLEAN.replace("|| value", '|| events."value"'))
DIRTY_SQL = _topic_sql("topic_log", _DIRTY.replace("|| value", '|| events."value"'))
# What DuckDB needs to say why a payload is refused.
VIOLATION_SQL = """broken AS (
  SELECT *, CASE
    WHEN "value" IS NULL THEN '$:null_value'
    WHEN NOT json_valid("value") THEN '$:not_json'
    WHEN json_type("value") <> 'OBJECT' THEN '$:not_object'
    ELSE concat_ws(',', {checks}) END AS why FROM topic_log),
judged AS (SELECT *, nullif(why, '') AS violations FROM broken)"""


def _check(name: str, required: bool, rule: str) -> str:
    kind = f"""json_type("value", '$.{name}')"""
    absent = f"WHEN {kind} IS NULL THEN '{name}:missing' WHEN {kind} = 'NULL' THEN '{name}:null'"
    open_ = absent if required else f"WHEN {kind} IS NULL OR {kind} = 'NULL' THEN NULL"
    return f"CASE {open_} {rule} END"


def _integer_check(name: str) -> str:
    kind = f"""json_type("value", '$.{name}')"""
    number = f"""CAST(json_extract_string("value", '$.{name}') AS DOUBLE)"""
    return _check(
        name,
        True,
        f"""WHEN {kind} NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN '{name}:wrong_type'
        WHEN abs({number}) >= 9223372036854775808 THEN '{name}:out_of_range'
        WHEN floor({number}) <> {number} THEN '{name}:fraction'""",
    )


def _guarded(check: str) -> str:
    # DuckDB may evaluate the checks before it has tested the text.
    return check.replace('"value"', """CASE WHEN json_valid("value") THEN "value" END""")


_CHECKS = ",\n      ".join(
    [
        _integer_check("event_id"),
        _integer_check("user_id"),
        _check("event_type", True, """WHEN json_type("value", '$.event_type') <> 'VARCHAR' THEN 'event_type:wrong_type'"""),
        _check(
            "value",
            True,
            """WHEN json_type("value", '$.value') NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'value:wrong_type'
            WHEN isinf(CAST(json_extract_string("value", '$.value') AS DOUBLE)) THEN 'value:not_finite'""",
        ),
        _check("props", False, """WHEN json_type("value", '$.props') <> 'VARCHAR' THEN 'props:wrong_type'"""),
    ]
)
JUDGED_SQL = DIRTY_SQL + ",\n" + VIOLATION_SQL.format(checks=_guarded(_CHECKS))

# Size of a clean record: three numbers and two texts (the event texts are ASCII).
CLEAN_BYTES_SQL = "CAST(24 + 2 * length(event_type) + 24 + 2 * length(props) + 24 AS BIGINT)"


def sized_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sizes(table(spark, sf_dir, "events"))


def with_sizes(events: DataFrame) -> DataFrame:
    """Topic positions with record sizes, from the typed columns."""
    return events.select(
        F.expr("'team.' || event_type").alias("topic"),
        F.expr("CAST(user_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        record_bytes(EVENT_SCHEMA).alias("bytes"),
    )


def flush_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flush per topic and ten minutes."""
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    return (
        sized_topic(spark, sf_dir)
        .groupBy("topic", F.floor(at / 600_000_000).cast("bigint").alias("seq"))
        .agg(F.sum("bytes").alias("bytes"), ((F.max(at) - F.min(at)) / 1_000_000).alias("elapsed_seconds"))
    )


FLUSH_SQL = f"""{TOPIC_SQL},
flush_log AS (
  SELECT topic, CAST(floor(epoch_us("timestamp") / 600000000) AS BIGINT) AS seq,
         CAST(sum({CLEAN_BYTES_SQL}) AS BIGINT) AS bytes,
         (max(epoch_us("timestamp")) - min(epoch_us("timestamp"))) / 1000000 AS elapsed_seconds
  FROM topic_log GROUP BY 1, 2)"""


# Batches that landing makes of a topic: ten days each.
BATCH_OF = "CAST((day({ts}) - 1) / 10 AS INT)"
LANDING_SQL = f"""{TOPIC_SQL},
landing_log AS (
  SELECT topic, "partition", CAST((day("timestamp") - 1) // 10 AS BIGINT) AS batch_id, count(*) AS records,
         CAST(sum({CLEAN_BYTES_SQL}) AS BIGINT) AS bytes
  FROM topic_log GROUP BY 1, 2, 3)"""

# --- file catalog ---------------------------------------------------------

_CODE = """(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END * 2
    + CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END)"""
_MONTH = "CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT)"
_LAKE_TABLE = "'is' || l_suppkey || '__' || lower(l_returnflag || l_linestatus)"
_ROOT = f"'s3://' || is_name || '/{LAKE_DIRECTORY}/main/' || table_name || '/'"
# Two incarnations of each table; the newer one holds the files of even snapshots.
# Every seventh snapshot's files and all files of some suppliers are retired.
_TABLE_ID = f"CAST((l_suppkey * 6 + {_CODE}) * 2 + CASE WHEN snapshot_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT)"
_FILE = """'part-' || snapshot_id || '.parquet'"""
_FILE_COLUMNS = f"""is_name, table_name, table_id, snapshot_id, record_count,
    CASE WHEN snapshot_id % 4 = 0 THEN {_FILE} ELSE {_ROOT} || {_FILE} END AS path,
    snapshot_id % 4 = 0 AS path_is_relative, record_count * 100 AS file_size_bytes,
    CASE WHEN snapshot_id % 7 = 0 OR k % 17 = 5 THEN snapshot_id + 1 END AS end_snapshot"""
_FILE_QUERY = f"""SELECT {_FILE_COLUMNS} FROM (
  SELECT l_suppkey AS k, 'is' || l_suppkey AS is_name, {_LAKE_TABLE} AS table_name, snapshot_id, {_TABLE_ID} AS table_id,
         count(*) AS record_count
  FROM (SELECT l_suppkey, l_returnflag, l_linestatus, {_MONTH} AS snapshot_id FROM {{source}}) AS items
  GROUP BY l_suppkey, l_returnflag, l_linestatus, snapshot_id) AS per_file"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per lake table and month of shipping; tables grow with suppliers."""
    return spark.sql(_FILE_QUERY.format(source="{lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, as a catalog keeps it, for plans that read it several times."""
    return cut_lineage(files(spark, sf_dir), "files")


def tables_of(catalog_files: DataFrame) -> DataFrame:
    return catalog_files.select("table_id", "table_name").distinct()


def full_paths(catalog_files: DataFrame) -> DataFrame:
    return catalog_files.withColumn("path", F.expr(f"CASE WHEN path_is_relative THEN {_ROOT} || path ELSE path END"))


def registered(catalog_files: DataFrame) -> DataFrame:
    """State of the target: every third snapshot was registered before."""
    return full_paths(catalog_files.filter("snapshot_id % 3 = 0")).select(
        "table_name", "path", "record_count", "file_size_bytes"
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(F.expr(_MONTH).alias("snapshot_id")).agg(F.min("l_shipdate").alias("commit_time"))


_STATE_QUERY = """SELECT table_name,
    CASE WHEN k % 5 = 0 THEN NULL ELSE k % 80 END AS last_exported_snapshot,
    CASE WHEN k % 5 = 0 THEN NULL ELSE TIMESTAMP{ntz} '2001-01-01 00:00:00' END AS last_export_time,
    k % 11 <> 3 AS export_enabled, k % 13 = 4 AS export_blocked,
    CASE WHEN k % 13 = 4 THEN 'schema conflict' END AS export_blocked_reason
  FROM (SELECT DISTINCT table_name, CAST(split_part(substr(is_name, 3), '_', 1) AS BIGINT) AS k FROM {files}) AS named
  WHERE k % 9 <> 0"""


def export_state(catalog_files: DataFrame) -> DataFrame:
    """Export progress by supplier; every ninth supplier's tables have none yet."""
    return catalog_files.sparkSession.sql(_STATE_QUERY.replace("{ntz}", "_NTZ"), files=catalog_files)


FILES_SQL = f"""files AS ({_FILE_QUERY.format(source="lineitem")}),
tables AS (SELECT DISTINCT table_id, table_name FROM files),
full_files AS (SELECT * REPLACE (CASE WHEN path_is_relative THEN {_ROOT} || path ELSE path END AS path) FROM files),
newest AS (SELECT table_name, max(table_id) AS table_id FROM tables GROUP BY table_name),
live AS (SELECT f.table_name, f.table_id, f.path, f.record_count, f.file_size_bytes, f.snapshot_id
         FROM full_files f
         WHERE f.end_snapshot IS NULL AND f.table_id = (SELECT n.table_id FROM newest n WHERE n.table_name = f.table_name)),
registered AS (SELECT table_name, path, record_count, file_size_bytes FROM full_files WHERE snapshot_id % 3 = 0),
snapshots AS (SELECT {_MONTH} AS snapshot_id, min(l_shipdate) AS commit_time FROM lineitem GROUP BY 1),
export_state AS ({_STATE_QUERY.format(ntz="", files="files")})"""

# --- schema registry ------------------------------------------------------

_SCHEMA_TEXT = """'{"type":"object"' || CASE WHEN k % 10 = 8 THEN '' ELSE
    ',"properties":{"id":{"type":"integer"},"name":{"type":"string"},"amount":{"type":"'
    || CASE WHEN version = 1 THEN 'integer' ELSE 'number' END || '"}'
    || CASE WHEN version = 1 THEN ',"legacy":{"type":"boolean"}'
            ELSE ',"added_v' || version || '":{"type":["null","string"]}' END
    || CASE k % 10
         WHEN 1 THEN ',"note":{"type":["string","null"]}'
         WHEN 2 THEN ',"' || c_name || '":{"type":"string"}'
         WHEN 3 THEN ',"Order":{"type":"string"}'
         WHEN 4 THEN ',"x":{"type":["string","integer"]}'
         WHEN 5 THEN ',"x":{"description":"d"}'
         WHEN 6 THEN ',"x":{"type":"date"}'
         WHEN 7 THEN ',"tags":{"type":"array"},"attrs":{"type":"object"}'
         WHEN 9 THEN ',"ID":{"type":"string"},"y":{"type":5}'
         ELSE '' END
    || CASE WHEN k % 7 = 0 THEN ',"flag":{"type":"' || CASE WHEN version = 1 THEN 'boolean' ELSE 'string' END || '"}'
            ELSE '' END
    || '},"required":["id","name","note"]' END || '}'"""
_REGISTRY_COLUMNS = {
    "group_id": "'is' || c_nationkey",
    "artifact_id": "'c' || k",
    "version": "CAST(version AS INTEGER)",
    "schema_json": _SCHEMA_TEXT,
}
_RULE_QUERY = """SELECT 'is' || c_nationkey AS group_id, 'c' || c_custkey AS artifact_id,
    CASE c_custkey % 4 WHEN 1 THEN 'BACKWARD' WHEN 2 THEN 'FULL' END AS mode
  FROM {customer} WHERE c_custkey % 4 <> 0
  UNION ALL SELECT NULL, NULL, 'BACKWARD'"""
_AVRO_TEXT = """'{"type":"record","name":"r","fields":[{"name":"id","type":"long"},{"name":"price","type":"'
    || CASE k % 2 WHEN 0 THEN 'double' ELSE 'int' END || '"}'
    || CASE k % 6
         WHEN 1 THEN ',{"name":"u","type":["null","string"]}'
         WHEN 2 THEN ',{"name":"a","type":"string","aliases":["old_a","older_a"]}'
         WHEN 3 THEN ',{"name":"c","type":{"type":"record","name":"q"}}'
         WHEN 4 THEN ',{"name":"b","type":"bytes"}'
         WHEN 5 THEN ',{"name":"w","type":["int","string","null"]}'
         ELSE '' END || ']}'"""
_AVRO_COLUMNS = {
    "group_id": "'size' || p_size",
    "artifact_id": "'p' || k",
    "version": "1",
    "schema_json": _AVRO_TEXT,
}


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One artifact per customer with one to three versions; some are faulty."""
    return (
        table(spark, sf_dir, "customer")
        .selectExpr("c_nationkey", "c_name", "c_custkey AS k", "explode(sequence(1L, 1 + c_custkey % 3)) AS version")
        .select(*_each(_REGISTRY_COLUMNS))
    )


def _each(columns: dict[str, str]):
    return [F.expr(text).alias(name) for name, text in columns.items()]


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility rules: three customers of four have one, and a global one."""
    return spark.sql(_RULE_QUERY, customer=table(spark, sf_dir, "customer"))


def avro_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_size", "p_partkey AS k").select(*_each(_AVRO_COLUMNS))


def _columns_sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


REGISTRY_SQL = f"""registry AS (SELECT {_columns_sql(_REGISTRY_COLUMNS)}
  FROM (SELECT c_nationkey, c_name, c_custkey AS k, unnest(range(1, 2 + c_custkey % 3)) AS version FROM customer) AS each_version),
rules AS ({_RULE_QUERY.replace("{customer}", "customer")}),
latest AS (SELECT group_id, artifact_id, max(version) AS version, arg_max(schema_json, version) AS schema_json
           FROM registry GROUP BY 1, 2)"""
AVRO_SQL = f"""avro AS (SELECT {_columns_sql(_AVRO_COLUMNS)} FROM (SELECT p_size, p_partkey AS k FROM part) AS each_part)"""

# --- types ----------------------------------------------------------------

_TYPE_NAMES = [name for name, _, _ in SIMPLE_TYPES] + [
    "UHUGEINT",
    "GEOMETRY",
    "decimal(10,2)",
    "NUMERIC(12, 4)",
    "DECIMAL(39,2)",
    "STRUCT(a INT)",
    "MAP(VARCHAR, INT)",
    "INTEGER[3]",
]
_TYPE_QUERY = f"""SELECT 'p' || p_partkey AS table_name,
    CASE WHEN p_partkey % 10 = 9 THEN 'DECIMAL(' || (5 + p_size % 30) || ',' || p_size % 5 || ')'
         ELSE split_part('{"|".join(_TYPE_NAMES)}', '|', CAST(1 + p_partkey % {len(_TYPE_NAMES)} AS INTEGER)) END
    || repeat('[]', CAST(floor(p_partkey / {len(_TYPE_NAMES)}.0) % 3 AS INTEGER)) AS type FROM {{part}}"""


def type_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored column per part, its type name taken in turn."""
    return spark.sql(_TYPE_QUERY, part=table(spark, sf_dir, "part"))


TYPES_SQL = f"type_names AS ({_TYPE_QUERY.replace('{part}', 'part')})"


def lake_table_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.expr(TABLE_TEXT).alias("table"))


# Table settings with no dot, one dot and two dots.
TABLE_TEXT = """CASE c_custkey % 3 WHEN 0 THEN 'nat' || c_nationkey || '.cust' || c_custkey
    WHEN 1 THEN 'nat' || c_nationkey || '.' || lower(c_mktsegment) || '.cust' || c_custkey
    ELSE 'cust' || c_custkey END"""
