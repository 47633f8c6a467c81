"""Queries over the schema registry, types and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import names
from quayside.functions.json_schema import RESERVED_WORDS, columns_of, columns_of_avro, name_error
from quayside.functions.lake_types import SIMPLE_TYPES, map_lake_types, name_mapping
from quayside.operators import evolve, export, register
from quayside.plans import fixtures as X
from quayside.plans.registered import query
from quayside.session import fresh_dir
from quayside.sources import registry as R
from quayside.sources.catalog import target_presence

KEYS = R.ARTIFACT
_RESERVED = ", ".join(f"'{w}'" for w in RESERVED_WORDS)


def _columns_sql(source: str, name: str) -> str:
    return f"""{name}_raw AS (
  SELECT r.group_id, r.artifact_id, r.version, e.key AS name, e.value AS node,
    CAST(row_number() OVER (PARTITION BY r.group_id, r.artifact_id, r.version ORDER BY e.id) - 1 AS INTEGER) AS pos,
    json_type(e.value, '$.type') AS kind,
    list_filter(CASE WHEN json_type(e.value, '$.type') = 'ARRAY' THEN CAST(json_extract(e.value, '$.type') AS VARCHAR[])
                     ELSE [json_extract_string(e.value, '$.type')] END, lambda x: x IS NOT NULL AND x <> 'null') AS members,
    count(*) OVER (PARTITION BY r.group_id, r.artifact_id, r.version, lower(e.key)) AS repeats,
    CAST(coalesce(json_extract(r.schema_json, '$.required'), '[]') AS VARCHAR[]) AS required
  FROM {source} r, json_each(r.schema_json, '$.properties') e),
{name}_judged AS (
  SELECT *, CASE
    WHEN NOT regexp_full_match(name, '[a-zA-Z0-9_]+') THEN 'bad_name'
    WHEN lower(name) IN ({_RESERVED}) THEN 'reserved_word'
    WHEN repeats > 1 THEN 'duplicate_name'
    WHEN kind IS NULL THEN 'missing_type'
    WHEN kind NOT IN ('VARCHAR', 'ARRAY') THEN 'unsupported_type_node'
    WHEN kind = 'ARRAY' AND len(members) <> 1 THEN 'multiple_types'
    WHEN members[1] NOT IN ('string', 'number', 'integer', 'boolean', 'object', 'array') THEN 'unsupported_type' END AS error
  FROM {name}_raw),
{name} AS (
  SELECT group_id, artifact_id, version, pos, name,
    CASE WHEN error IS NULL THEN CASE members[1] WHEN 'number' THEN 'DOUBLE' WHEN 'integer' THEN 'BIGINT'
      WHEN 'boolean' THEN 'BOOLEAN' ELSE 'VARCHAR' END END AS type,
    CASE WHEN error IS NULL THEN kind = 'ARRAY' OR NOT list_contains(required, name) END AS nullable,
    CASE WHEN error IS NULL AND members[1] IN ('object', 'array') THEN 'nested_as_text' END AS warning, error
  FROM {name}_judged
  UNION ALL
  SELECT group_id, artifact_id, version, NULL, NULL, NULL, NULL, NULL, 'missing_properties'
  FROM {source} WHERE json_extract(schema_json, '$.properties') IS NULL)"""


_ALL = X.REGISTRY_SQL + ",\n" + _columns_sql("registry", "cols")
_NEWEST = X.REGISTRY_SQL + ",\n" + _columns_sql("latest", "cols")
_MODES = """modes AS (
  SELECT a.group_id, a.artifact_id, coalesce(r.mode, CASE WHEN r.artifact_id IS NULL
    THEN (SELECT max(mode) FROM rules WHERE artifact_id IS NULL) END, 'NONE') AS mode
  FROM (SELECT DISTINCT group_id, artifact_id FROM registry) a
  LEFT JOIN rules r ON r.group_id = a.group_id AND r.artifact_id = a.artifact_id)"""


@query("S6", "SELECT * FROM latest", X.REGISTRY_SQL)
def latest_schemas(spark, sf_dir):
    return R.latest_schemas(X.registry(spark, sf_dir))


@query("F1", "SELECT * FROM cols", _ALL)
def declared_columns(spark, sf_dir):
    return columns_of(X.registry(spark, sf_dir))


@query("P6 P7", """SELECT group_id, artifact_id, version, name, error FROM cols WHERE error IN ('bad_name', 'reserved_word')""", _ALL)
def refused_names(spark, sf_dir):
    columns = columns_of(X.registry(spark, sf_dir))
    return columns.select("group_id", "artifact_id", "version", "name", name_error(F.col("name")).alias("error")).filter(
        "error IS NOT NULL"
    )


@query("F1 P6 P7", """SELECT group_id, artifact_id, version, coalesce(name, '$') AS name, error FROM cols WHERE error IS NOT NULL""", _ALL)
def schema_faults(spark, sf_dir):
    return R.schema_faults(X.registry(spark, sf_dir))


@query("J2", "SELECT * FROM modes", X.REGISTRY_SQL + ",\n" + _MODES)
def effective_modes(spark, sf_dir):
    return R.effective_mode(X.registry(spark, sf_dir), X.rules(spark, sf_dir))


@query("P8", "SELECT * FROM modes WHERE mode <> 'BACKWARD'", X.REGISTRY_SQL + ",\n" + _MODES)
def ungoverned_artifacts(spark, sf_dir):
    return R.ungoverned(X.registry(spark, sf_dir), X.rules(spark, sf_dir))


_LANDABLE = """landable AS (SELECT group_id, artifact_id, version, pos, name, type, nullable FROM cols
  WHERE (group_id, artifact_id) NOT IN (SELECT (group_id, artifact_id) FROM cols WHERE error IS NOT NULL)
    AND (group_id, artifact_id) IN (SELECT (group_id, artifact_id) FROM modes WHERE mode = 'BACKWARD'))"""


@query("F1 P8 S6 T5", "SELECT * FROM landable", f"{_NEWEST},\n{_MODES},\n{_LANDABLE}")
def landable_columns(spark, sf_dir):
    return R.landable_columns(X.registry(spark, sf_dir), X.rules(spark, sf_dir))


def _sound(columns):
    return columns.filter("error IS NULL")


def _sides(spark, sf_dir):
    """Stored columns (first versions) and declared ones (newest versions)."""
    every = X.registry(spark, sf_dir)
    return _sound(columns_of(every.filter("version = 1"))), _sound(columns_of(R.latest_schemas(every)))


_SIDES = (
    X.REGISTRY_SQL
    + ",\nfirst_versions AS (SELECT * FROM registry WHERE version = 1),\n"
    + _columns_sql("first_versions", "old_cols")
    + ",\n"
    + _columns_sql("latest", "new_cols")
    + """,
diff AS (SELECT * FROM (
  SELECT coalesce(o.group_id, n.group_id) AS group_id, coalesce(o.artifact_id, n.artifact_id) AS artifact_id,
    coalesce(o.name, n.name) AS name, CASE
      WHEN o.type IS NULL THEN 'added' WHEN n.type IS NULL THEN 'removed' WHEN o.type = n.type THEN NULL
      WHEN o.type = 'BIGINT' AND n.type = 'DOUBLE' THEN 'widened' ELSE 'conflict' END AS change,
    o.type AS old_type, n.type AS new_type
  FROM (SELECT * FROM old_cols WHERE error IS NULL) o FULL JOIN (SELECT * FROM new_cols WHERE error IS NULL) n
    ON o.group_id = n.group_id AND o.artifact_id = n.artifact_id AND o.name = n.name) WHERE change IS NOT NULL)"""
)


@query("J3 S7", "SELECT * FROM diff", _SIDES)
def schema_changes(spark, sf_dir):
    return evolve.schema_diff(*_sides(spark, sf_dir), KEYS)


@query(
    "J4 X1",
    """SELECT group_id, artifact_id, name, CASE change WHEN 'added' THEN 'gone' ELSE 'new' END AS drift
    FROM diff WHERE change IN ('added', 'removed')""",
    _SIDES,
)
def column_drift(spark, sf_dir):
    return evolve.column_drift(*_sides(spark, sf_dir), KEYS)


_CONFLICTS = """conflicts AS (SELECT group_id, artifact_id, count(*) AS conflicts,
  min('conflict ' || name || ' ' || old_type || '->' || new_type) AS reason FROM diff WHERE change = 'conflict' GROUP BY ALL)"""


@query("J3 D13", "SELECT * FROM conflicts", f"{_SIDES},\n{_CONFLICTS}")
def evolution_conflicts(spark, sf_dir):
    return evolve.conflicts(evolve.schema_diff(*_sides(spark, sf_dir), KEYS), KEYS)


@query(
    "D13",
    """SELECT artifact_id AS table_name, CAST(version AS BIGINT) AS last_exported_snapshot,
      TIMESTAMP '2001-01-01 00:00:00' AS last_export_time, true AS export_enabled,
      reason IS NOT NULL AS export_blocked, reason AS export_blocked_reason
    FROM latest LEFT JOIN conflicts USING (group_id, artifact_id)""",
    f"{_SIDES},\n{_CONFLICTS}",
)
def blocked_exports(spark, sf_dir):
    state = R.latest_schemas(X.registry(spark, sf_dir)).select(
        F.col("artifact_id").alias("table_name"),
        F.col("version").cast("bigint").alias("last_exported_snapshot"),
        F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("last_export_time"),
        F.lit(True).alias("export_enabled"),
        F.lit(False).alias("export_blocked"),
        F.lit(None).cast("string").alias("export_blocked_reason"),
    )
    bad = evolve.conflicts(evolve.schema_diff(*_sides(spark, sf_dir), KEYS), KEYS)
    return export.block_exports(state, bad.select(F.col("artifact_id").alias("table_name"), "reason"))


_AVRO = X.AVRO_SQL + """,
avro_raw AS (
  SELECT a.group_id, a.artifact_id, a.version, CAST(e.key AS INTEGER) AS pos,
    json_extract_string(e.value, '$.name') AS name, json_type(e.value, '$.type') AS kind,
    list_filter(CASE WHEN json_type(e.value, '$.type') = 'ARRAY' THEN CAST(json_extract(e.value, '$.type') AS VARCHAR[])
      ELSE [json_extract_string(e.value, '$.type')] END, lambda x: x <> 'null') AS members,
    nullif(array_to_string(CAST(json_extract(e.value, '$.aliases') AS VARCHAR[]), ','), '') AS renamed_from
  FROM avro a, json_each(a.schema_json, '$.fields') e),
avro_judged AS (SELECT *, CASE
    WHEN kind NOT IN ('VARCHAR', 'ARRAY') THEN 'complex_type'
    WHEN kind = 'ARRAY' AND len(members) <> 1 THEN 'multiple_types'
    WHEN members[1] NOT IN ('string', 'int', 'long', 'float', 'double', 'boolean') THEN 'unsupported_type' END AS error
  FROM avro_raw),
avro_cols AS (SELECT group_id, artifact_id, version, pos, name,
    CASE WHEN error IS NULL THEN CASE members[1] WHEN 'string' THEN 'VARCHAR' WHEN 'boolean' THEN 'BOOLEAN'
      WHEN 'int' THEN 'BIGINT' WHEN 'long' THEN 'BIGINT' ELSE 'DOUBLE' END END AS type,
    CASE WHEN error IS NULL THEN kind = 'ARRAY' END AS nullable, renamed_from, error FROM avro_judged)"""


@query("F3", "SELECT * FROM avro_cols", _AVRO)
def avro_columns(spark, sf_dir):
    return columns_of_avro(X.avro_registry(spark, sf_dir))


# Stored tables of the Avro artifacts: an id, a whole-number price and a column
# that the schemas no longer have, whose id differs by table.
def _stored_fields(spark, sf_dir):
    parts = X.avro_registry(spark, sf_dir).select(*KEYS)
    old_id = F.length("artifact_id") + 7
    stored = F.array(
        *[
            F.struct(i.alias("field_id"), F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(r).alias("required"))
            for i, n, t, r in [(F.lit(1), "id", "BIGINT", True), (F.lit(2), "price", "BIGINT", True), (old_id, "old", "VARCHAR", False)]
        ]
    )
    return parts.select(*KEYS, F.inline(stored))


_STORED = """stored AS (SELECT a.group_id, a.artifact_id, CAST(CASE s.name WHEN 'old' THEN 7 + length(a.artifact_id) ELSE s.field_id END AS INTEGER)
  AS field_id, s.name, s.type, s.required FROM avro a, (VALUES
  (1, 'id', 'BIGINT', true), (2, 'price', 'BIGINT', true), (7, 'old', 'VARCHAR', false)) s(field_id, name, type, required))"""


@query("D7", """SELECT group_id, artifact_id, name, 'rename' AS change, CAST(NULL AS VARCHAR) AS old_type, type AS new_type
    FROM avro_cols WHERE error IS NULL AND renamed_from IS NOT NULL""", _AVRO)
def renamed_columns(spark, sf_dir):
    declared = _sound(columns_of_avro(X.avro_registry(spark, sf_dir)))
    diff = evolve.schema_diff(_stored_fields(spark, sf_dir), declared, KEYS, aliases="renamed_from")
    return diff.filter("change = 'rename'")


@query("A12", "SELECT group_id, artifact_id, max(field_id) AS highest_field_id FROM stored GROUP BY ALL", f"{X.AVRO_SQL},\n{_STORED}")
def highest_field_ids(spark, sf_dir):
    return evolve.highest_field_id(_stored_fields(spark, sf_dir), KEYS)


_SYNCED = """SELECT s.group_id, s.artifact_id, s.field_id, s.name,
      CASE WHEN s.name = 'price' AND c.type = 'DOUBLE' THEN 'DOUBLE' ELSE s.type END AS type, s.required
    FROM stored s LEFT JOIN sound c ON s.group_id = c.group_id AND s.artifact_id = c.artifact_id AND s.name = c.name
    UNION ALL
    SELECT group_id, artifact_id, CAST(7 + length(artifact_id) + row_number() OVER (PARTITION BY group_id, artifact_id ORDER BY pos) AS INTEGER),
      name, type, NOT nullable FROM sound WHERE name NOT IN ('id', 'price', 'old')"""


@query(
    "K7 K3 A12",
    _SYNCED,
    f"{_AVRO},\n{_STORED},\nsound AS (SELECT * FROM avro_cols WHERE error IS NULL)",
)
def synced_fields(spark, sf_dir):
    declared = _sound(columns_of_avro(X.avro_registry(spark, sf_dir)))
    return evolve.sync_fields(_stored_fields(spark, sf_dir), declared, KEYS)


@query(
    "K5 K7 F4 J3",
    f"""SELECT group_id, artifact_id, '[' || string_agg('{{"field-id":' || field_id || ',"names":["' || name || '"]}}', ',' ORDER BY field_id) || ']'
      AS name_mapping, max(field_id) AS last_field_id FROM ({_SYNCED}) GROUP BY ALL""",
    f"{_AVRO},\n{_STORED},\nsound AS (SELECT * FROM avro_cols WHERE error IS NULL)",
)
def stored_targets(spark, sf_dir):
    """Targets stored with their fields, synced to the declared ones as new versions, twice, and read back."""
    path, stored = fresh_dir(spark, "targets"), _stored_fields(spark, sf_dir)
    register.write_targets(stored, KEYS, path)
    declared = _sound(columns_of_avro(X.avro_registry(spark, sf_dir)))
    for _ in range(2):
        register.sync_targets(declared, KEYS, path)
    return register.described_targets(register.read_targets(spark, path), KEYS).drop("schema_json")


@query(
    "F4 K5",
    """SELECT group_id, artifact_id, '[' || string_agg('{"field-id":' || (pos + 1) || ',"names":["' || name || '"]}', ',' ORDER BY pos) || ']'
      AS name_mapping, max(pos + 1) AS last_field_id FROM landable GROUP BY ALL""",
    f"{_NEWEST},\n{_MODES},\n{_LANDABLE}",
)
def name_mappings(spark, sf_dir):
    return name_mapping(R.landable_columns(X.registry(spark, sf_dir), X.rules(spark, sf_dir)), KEYS)


@query(
    "K5 F2 F4",
    """SELECT group_id, artifact_id, max(pos + 1) AS last_field_id,
      '[' || string_agg('{"field-id":' || (pos + 1) || ',"names":["' || name || '"]}', ',' ORDER BY pos) || ']' AS name_mapping,
      '[' || string_agg('{"id":' || (pos + 1) || ',"name":"' || name || '","type":"'
        || CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'long' ELSE lower(type) END
        || '","required":' || (NOT nullable) || '}', ',' ORDER BY pos) || ']' AS schema_json
    FROM landable GROUP BY ALL""",
    f"{_NEWEST},\n{_MODES},\n{_LANDABLE}",
)
def created_tables(spark, sf_dir):
    return register.created_tables(R.landable_columns(X.registry(spark, sf_dir), X.rules(spark, sf_dir)), KEYS)


@query(
    "S13 K5",
    """SELECT 'c' || c_custkey AS table_name, CASE WHEN 'c' || c_custkey IN (SELECT artifact_id FROM landable)
      THEN 'load' ELSE 'create' END AS action FROM customer""",
    f"{_NEWEST},\n{_MODES},\n{_LANDABLE}",
)
def target_tables(spark, sf_dir):
    every = X.registry(spark, sf_dir).select(F.col("artifact_id").alias("table_name"))
    known = R.landable_columns(X.registry(spark, sf_dir), X.rules(spark, sf_dir))
    return target_presence(every, known.select(F.col("artifact_id").alias("table_name")))


_SIMPLE_SQL = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in SIMPLE_TYPES)


@query(
    "F2 S10",
    r"""SELECT table_name, type, repeat('list<', depth) || element || repeat('>', depth) AS target_type,
      repeat('array<', depth) || spark_element || repeat('>', depth) AS spark_type, warning
    FROM (SELECT table_name, type, depth,
        CASE WHEN decimal AND digits <= 38 THEN 'decimal(' || digits || ',' || places || ')'
             ELSE coalesce(s.target, 'string') END AS element,
        CASE WHEN decimal AND digits <= 38 THEN 'decimal(' || digits || ',' || places || ')'
             ELSE coalesce(s.spark, 'string') END AS spark_element,
        CASE WHEN base LIKE 'STRUCT(%' OR base LIKE 'MAP(%' THEN 'nested_as_text'
             WHEN base = 'UHUGEINT' OR (decimal AND digits > 38) THEN 'too_wide_as_text'
             WHEN NOT decimal AND s.target IS NULL THEN 'unknown_as_text' END AS warning
      FROM (SELECT *, regexp_full_match(base, '(DECIMAL|NUMERIC)\(\d+,\s*\d+\)') AS decimal,
              TRY_CAST(regexp_extract(base, '\((\d+),', 1) AS INTEGER) AS digits,
              regexp_extract(base, ',\s*(\d+)\)', 1) AS places
            FROM (SELECT table_name, type, upper(regexp_replace(type, '(\[\])+$', '')) AS base,
                    CAST((length(type) - length(regexp_replace(type, '(\[\])+$', ''))) / 2 AS INTEGER) AS depth
                  FROM type_names)) t
      LEFT JOIN (VALUES """
    + _SIMPLE_SQL
    + ") s(name, target, spark) ON s.name = t.base)",
    X.TYPES_SQL,
)
def mapped_types(spark, sf_dir):
    return map_lake_types(X.type_names(spark, sf_dir))


@query(
    "F6",
    """SELECT "table", CASE WHEN strpos("table", '.') > 0 THEN substr("table", 1, strpos("table", '.') - 1) ELSE "table" END AS is_name,
      CASE WHEN strpos("table", '.') > 0 THEN substr("table", strpos("table", '.') + 1) ELSE "table" END AS table_name,
      CASE WHEN strpos("table", '.') > 0 THEN substr("table", 1, strpos("table", '.') - 1) ELSE "table" END || '__'
        || replace(CASE WHEN strpos("table", '.') > 0 THEN substr("table", strpos("table", '.') + 1) ELSE "table" END, '.', '__') AS lake_name
    FROM texts""",
    f'texts AS (SELECT {X.TABLE_TEXT} AS "table" FROM customer)',
)
def lake_names(spark, sf_dir):
    text = F.col("table")
    return X.lake_table_texts(spark, sf_dir).select(
        "table",
        names.is_name(text).alias("is_name"),
        names.table_name(text).alias("table_name"),
        names.lake_name(text).alias("lake_name"),
    )
