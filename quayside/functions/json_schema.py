"""JSON Schema and Avro texts turned into column definitions, all artifacts in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that a column may not be called, compared in lower case.
RESERVED_WORDS = (
    "select", "from", "where", "table", "column", "index", "order", "group",
    "by", "having", "limit", "offset", "join", "inner", "outer", "left",
    "right", "full", "cross", "on", "as", "and", "or", "not", "null",
    "true", "false", "in", "is", "like", "between", "case", "when", "then",
    "else", "end", "insert", "update", "delete", "create", "drop", "alter",
    "with", "union", "intersect", "except", "all", "distinct", "top",
    "primary", "key", "foreign", "references", "unique", "check", "default",
    "constraint", "view", "database", "schema", "use", "show", "describe",
)
NAME_PATTERN = "^[a-zA-Z0-9_]+$"

# JSON Schema type to lake type.
JSON_TYPES = {
    "string": "VARCHAR",
    "number": "DOUBLE",
    "integer": "BIGINT",
    "boolean": "BOOLEAN",
    "object": "VARCHAR",
    "array": "VARCHAR",
}
NESTED_TYPES = ("object", "array")

# Avro type to lake type.
AVRO_TYPES = {
    "string": "VARCHAR",
    "int": "BIGINT",
    "long": "BIGINT",
    "float": "DOUBLE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

SPARK_TYPES = {
    "VARCHAR": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
}


def name_error(name: Column) -> Column:
    """``bad_name``, ``reserved_word`` or null."""
    return F.when(~name.rlike(NAME_PATTERN), "bad_name").when(F.lower(name).isin(*RESERVED_WORDS), "reserved_word")


def _settled(df: DataFrame, error: Column) -> DataFrame:
    """Add ``error`` by a one-element explode: filters on it are not pushed below,
    where every type node would be parsed a second time."""
    return df.select("*", F.explode(F.array(error)).alias("error"))


def _lookup(table: dict[str, str], key: Column) -> Column:
    mapped = F.lit(None).cast("string")
    for source, target in table.items():
        mapped = F.when(key == source, F.lit(target)).otherwise(mapped)
    return mapped


def _dealt(registry: DataFrame) -> DataFrame:
    """Schema texts dealt over all tasks: they are made from, or stored in, files too small to be read in parts, and take long to parse."""
    return registry.repartition("group_id", "artifact_id", "version")


def _type_parts(df: DataFrame, text: Column) -> DataFrame:
    """Add ``kind`` (absent, text, list, other) and ``members`` of a type node."""
    node = F.try_variant_get(F.try_parse_json(text), "$.type", "variant")
    shape = F.schema_of_variant(F.col("_node"))
    return (
        df.withColumn("_node", node)
        .withColumn(
            "kind",
            F.when(F.col("_node").isNull(), "absent")
            .when(shape == "STRING", "text")
            .when(shape.startswith("ARRAY"), "list")
            .otherwise("other"),
        )
        .withColumn(
            "members",
            F.when(F.col("kind") == "text", F.array(F.try_variant_get("_node", "$", "string"))).when(
                F.col("kind") == "list", F.try_variant_get("_node", "$", "array<string>")
            ),
        )
        .withColumn("members", F.filter("members", lambda m: m.isNotNull() & (m != "null")))
        .drop("_node")
    )


def columns_of(registry: DataFrame, nested: str = "text") -> DataFrame:
    """One row per declared column of every artifact version, in property order.

    Output: ``group_id, artifact_id, version, pos, name, type, nullable,
    warning, error``. A schema without ``properties`` gives one row with a null
    position. Two names that differ in case only are an error, because Spark
    resolves names without regard to case. ``nested='reject'`` refuses object
    and array columns instead of keeping them as JSON text.
    """
    shape = "properties map<string,string>, required array<string>"
    fields = (
        _dealt(registry)
        .withColumn("_s", F.from_json("schema_json", shape))
        .withColumn("_names", F.transform(F.map_keys("_s.properties"), F.lower))
        .select(
            "group_id",
            "artifact_id",
            "version",
            "_names",
            F.coalesce(F.col("_s.required"), F.array().cast("array<string>")).alias("_required"),
            F.posexplode_outer("_s.properties").alias("pos", "name", "_text"),
        )
    )
    typed = _type_parts(fields, F.col("_text"))
    first = F.get("members", F.lit(0))
    listed = F.col("kind") == "list"
    repeats = F.size(F.filter("_names", lambda n: n == F.lower(F.col("name"))))
    rejected_nested = first.isin(*NESTED_TYPES) if nested == "reject" else F.lit(False)
    # When the artifact has no properties the exploded name is null.
    error = (
        F.when(F.col("name").isNull(), "missing_properties")
        .when(name_error(F.col("name")).isNotNull(), name_error(F.col("name")))
        .when(repeats > 1, "duplicate_name")
        .when(F.col("kind") == "absent", "missing_type")
        .when(F.col("kind") == "other", "unsupported_type_node")
        .when(listed & (F.size("members") != 1), "multiple_types")
        .when(_lookup(JSON_TYPES, first).isNull(), "unsupported_type")
        .when(rejected_nested, "nested_type")
    )
    return (
        _settled(typed, error)
        .withColumn("_ok", F.col("error").isNull())
        .select(
            "group_id",
            "artifact_id",
            "version",
            "pos",
            "name",
            F.when(F.col("_ok"), _lookup(JSON_TYPES, first)).alias("type"),
            F.when(F.col("_ok"), listed | ~F.array_contains("_required", F.col("name"))).alias("nullable"),
            F.when(F.col("_ok") & first.isin(*NESTED_TYPES), "nested_as_text").alias("warning"),
            "error",
        )
    )


def columns_of_avro(registry: DataFrame) -> DataFrame:
    """The same for Avro record schemas; ``renamed_from`` lists a field's aliases."""
    fields = _dealt(registry).select(
        "group_id",
        "artifact_id",
        "version",
        F.posexplode(F.from_json("schema_json", "fields array<string>").getField("fields")).alias("pos", "_text"),
    ).withColumns(
        {
            "name": F.get_json_object("_text", "$.name"),
            "renamed_from": F.array_join(F.from_json("_text", "aliases array<string>").getField("aliases"), ","),
        }
    )
    typed = _type_parts(fields, F.col("_text"))
    first = F.get("members", F.lit(0))
    error = (
        F.when(F.col("kind").isin("absent", "other"), "complex_type")
        .when((F.col("kind") == "list") & (F.size("members") != 1), "multiple_types")
        .when(_lookup(AVRO_TYPES, first).isNull(), "unsupported_type")
    )
    return _settled(typed, error).select(
        "group_id",
        "artifact_id",
        "version",
        "pos",
        "name",
        F.when(F.col("error").isNull(), _lookup(AVRO_TYPES, first)).alias("type"),
        F.when(F.col("error").isNull(), F.col("kind") == "list").alias("nullable"),
        F.when(F.col("renamed_from") != "", F.col("renamed_from")).alias("renamed_from"),
        "error",
    )


def struct_type_of(columns: DataFrame, group_id: str, artifact_id: str) -> T.StructType:
    """The declared schema of one artifact. Collects one row per column of it."""
    rows = (
        columns.filter((F.col("group_id") == group_id) & (F.col("artifact_id") == artifact_id)).orderBy("pos").collect()
    )
    faults = [f"{r['name']}: {r['error']}" for r in rows if r["error"]]
    if not rows or faults:
        raise ValueError(f"schema {group_id}/{artifact_id}: {', '.join(faults) or 'not registered'}")
    return struct_type([(r["name"], r["type"], r["nullable"], r["warning"] == "nested_as_text") for r in rows])


def struct_type(columns: list[tuple]) -> T.StructType:
    """``(name, lake type, nullable[, nested])`` tuples as a Spark schema."""
    fields = []
    for name, lake_type, nullable, *rest in columns:
        nested = {"nested": True} if rest and rest[0] else {}
        fields.append(T.StructField(name, SPARK_TYPES[lake_type], nullable, nested))
    return T.StructType(fields)
