import json

import pytest
from pyspark.sql import functions as F

from quayside.functions import names
from quayside.functions.json_schema import columns_of, columns_of_avro, struct_type, struct_type_of
from quayside.functions.lake_types import map_lake_types, name_mapping
from quayside.functions.sizes import payload_bytes, record_bytes


@pytest.mark.parametrize(
    "text, owner, table, lake",
    [
        ("team.orders", "team", "orders", "team__orders"),
        ("team.eu.orders", "team", "eu.orders", "team__eu__orders"),
        ("orders", "orders", "orders", "orders__orders"),
    ],
)
def test_names(spark, text, owner, table, lake):
    df = spark.createDataFrame([(text,)], "t string")
    c = F.col("t")
    assert tuple(df.select(names.is_name(c), names.table_name(c), names.lake_name(c)).first()) == (owner, table, lake)


def test_paths(spark):
    df = spark.createDataFrame([("a.parquet", True), ("s3://x/a.parquet", False)], "path string, rel boolean")
    root = names.table_root(F.lit("team"), F.lit("team__orders"))
    got = [r[0] for r in df.select(names.resolve_path(F.col("path"), F.col("rel"), root)).collect()]
    assert got == ["s3://team/ducklake/main/team__orders/a.parquet", "s3://x/a.parquet"]


def test_sizes_count_utf16_units(spark):
    df = spark.createDataFrame([("ab", 1), ("\U0001f600", None), (None, 2), ("", 3)], "t string, n int")
    got = [r[0] for r in df.select(record_bytes(df.schema)).collect()]
    assert got == [2 * 2 + 24 + 8, 2 * 2 + 24 + 8, 8 + 8, 24 + 8]


def test_payload_size_covers_undeclared_keys(spark):
    df = spark.createDataFrame([('{"a":1,"b":"xy","c":null,"d":[1,2]}',), ("{}",)], "v string")
    got = [r[0] for r in df.select(payload_bytes(F.try_parse_json("v"))).collect()]
    assert got == [8 + (2 * 2 + 24) + 8 + 8, 0]


def registry(spark, *schemas):
    rows = [("g", f"a{i}", 1, s if isinstance(s, str) else json.dumps(s)) for i, s in enumerate(schemas)]
    return spark.createDataFrame(rows, "group_id string, artifact_id string, version int, schema_json string")


CASES = [
    ({"type": "string"}, True, "VARCHAR", False, None),
    ({"type": "number"}, True, "DOUBLE", False, None),
    ({"type": "integer"}, False, "BIGINT", True, None),
    ({"type": "boolean"}, True, "BOOLEAN", False, None),
    ({"type": "object"}, True, "VARCHAR", False, None),
    ({"type": "array"}, True, "VARCHAR", False, None),
    ({"type": ["string", "null"]}, True, "VARCHAR", True, None),
    ({"type": ["null", "number"]}, True, "DOUBLE", True, None),
    ({"type": ["integer"]}, True, "BIGINT", True, None),
    ({"type": ["string", "integer"]}, True, None, None, "multiple_types"),
    ({"type": ["null"]}, True, None, None, "multiple_types"),
    ({"type": "null"}, True, None, None, "unsupported_type"),
    ({"type": "date"}, True, None, None, "unsupported_type"),
    ({"type": 5}, True, None, None, "unsupported_type_node"),
    ({"type": None}, True, None, None, "unsupported_type_node"),
    ({"type": {"a": 1}}, True, None, None, "unsupported_type_node"),
    ({}, True, None, None, "missing_type"),
]


def test_json_schema_types(spark):
    schemas = [{"properties": {"c": node}, "required": ["c"] if need else []} for node, need, *_ in CASES]
    got = {r["artifact_id"]: r for r in columns_of(registry(spark, *schemas)).collect()}
    for i, (_, _, lake, nullable, error) in enumerate(CASES):
        r = got[f"a{i}"]
        assert (r["type"], r["nullable"], r["error"]) == (lake, nullable, error), CASES[i]


def test_json_schema_names_and_order(spark):
    wanted = {"z": None, "a_1": None, "bad-name": "bad_name", "Select": "reserved_word", "": "bad_name"}
    schema = {"properties": {n: {"type": "string"} for n in wanted}}
    got = columns_of(registry(spark, schema)).orderBy("pos").collect()
    assert [(r["name"], r["error"]) for r in got] == list(wanted.items())


def test_json_schema_faults(spark):
    got = columns_of(registry(spark, {"type": "object"}, {"properties": {"a": {"type": "string"}, "A": {"type": "string"}}}))
    assert sorted((r["artifact_id"], r["error"]) for r in got.collect()) == [
        ("a0", "missing_properties"),
        ("a1", "duplicate_name"),
        ("a1", "duplicate_name"),
    ]


def test_schemas_of_one_small_file_are_parsed_by_many_tasks(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    made = registry(spark, *[{"properties": {"a": {"type": "string"}}}] * 40).coalesce(1)
    avro = made.withColumn("schema_json", F.lit('{"fields":[{"name":"a","type":"string"}]}'))
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        for found in (columns_of(made), columns_of_avro(avro)):
            got = found.select("artifact_id", F.spark_partition_id().alias("task")).collect()
            assert len(got) == 40 and len({r["task"] for r in got}) > 1
    finally:
        spark.conf.set(name, before)


def test_nested_columns_may_be_refused(spark):
    schema = {"properties": {"a": {"type": "array"}}}
    assert columns_of(registry(spark, schema)).first()["warning"] == "nested_as_text"
    assert columns_of(registry(spark, schema), nested="reject").first()["error"] == "nested_type"


def test_struct_type_of(spark):
    schema = {"properties": {"id": {"type": "integer"}, "note": {"type": "string"}}, "required": ["id"]}
    columns = columns_of(registry(spark, schema, {"properties": {"x": {}}}))
    assert struct_type_of(columns, "g", "a0") == struct_type([("id", "BIGINT", False), ("note", "VARCHAR", True)])
    with pytest.raises(ValueError, match="missing_type"):
        struct_type_of(columns, "g", "a1")
    with pytest.raises(ValueError, match="not registered"):
        struct_type_of(columns, "g", "none")


def test_avro_columns(spark):
    fields = [
        ({"name": "a", "type": "int"}, ("BIGINT", False, None, None)),
        ({"name": "b", "type": ["null", "float"]}, ("DOUBLE", True, None, None)),
        ({"name": "c", "type": ["string", "null"], "aliases": ["x", "y"]}, ("VARCHAR", True, "x,y", None)),
        ({"name": "d", "type": "bytes"}, (None, None, None, "unsupported_type")),
        ({"name": "e", "type": ["int", "string"]}, (None, None, None, "multiple_types")),
        ({"name": "f", "type": {"type": "record"}}, (None, None, None, "complex_type")),
        ({"name": "g", "type": ["null", {"type": "array"}]}, (None, None, None, "unsupported_type")),
    ]
    got = columns_of_avro(registry(spark, {"fields": [f for f, _ in fields]})).orderBy("pos").collect()
    assert [(r["type"], r["nullable"], r["renamed_from"], r["error"]) for r in got] == [e for _, e in fields]


@pytest.mark.parametrize(
    "lake, target, spark_type, warning",
    [
        ("DECIMAL(10,2)", "decimal(10,2)", "decimal(10,2)", None),
        ("numeric(10, 2)", "decimal(10,2)", "decimal(10,2)", None),
        ("DECIMAL", "decimal(38,10)", "decimal(38,10)", None),
        ("DECIMAL(10,2)[]", "list<decimal(10,2)>", "array<decimal(10,2)>", None),
        ("INTEGER[][]", "list<list<int>>", "array<array<int>>", None),
        ("STRUCT(a INT)[]", "list<string>", "array<string>", "nested_as_text"),
        ("STRUCT(a INT[])", "string", "string", "nested_as_text"),
        ("INTEGER[3]", "string", "string", "unknown_as_text"),
        ("UBIGINT", "decimal(20,0)", "decimal(20,0)", None),
        ("UHUGEINT", "string", "string", "too_wide_as_text"),
        ("DECIMAL(39,0)", "string", "string", "too_wide_as_text"),
        ("timestamp with time zone", "timestamptz", "timestamp", None),
        (" TIME ", "time", "string", None),
        ("GEOMETRY", "string", "string", "unknown_as_text"),
    ],
)
def test_lake_types(spark, lake, target, spark_type, warning):
    r = map_lake_types(spark.createDataFrame([(lake,)], "type string")).first()
    assert (r["target_type"], r["spark_type"], r["warning"]) == (target, spark_type, warning)


def test_name_mapping(spark):
    columns = spark.createDataFrame([("t", 1, "b"), ("t", 0, "a"), ("u", 0, "x")], "table_name string, pos int, name string")
    got = {r["table_name"]: (json.loads(r["name_mapping"]), r["last_field_id"]) for r in name_mapping(columns, ["table_name"]).collect()}
    assert got["t"] == ([{"field-id": 1, "names": ["a"]}, {"field-id": 2, "names": ["b"]}], 2)
    assert got["u"] == ([{"field-id": 1, "names": ["x"]}], 1)
