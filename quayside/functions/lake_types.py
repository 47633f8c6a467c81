"""Lake column types mapped to the types of a registered table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lake type name, registered type, Spark type.
SIMPLE_TYPES = (
    ("VARCHAR", "string", "string"),
    ("TEXT", "string", "string"),
    ("STRING", "string", "string"),
    ("JSON", "string", "string"),
    ("INTERVAL", "string", "string"),
    ("UUID", "uuid", "string"),
    ("BIGINT", "long", "bigint"),
    ("INT8", "long", "bigint"),
    ("LONG", "long", "bigint"),
    ("UBIGINT", "decimal(20,0)", "decimal(20,0)"),
    ("UINTEGER", "long", "bigint"),
    ("HUGEINT", "decimal(38,0)", "decimal(38,0)"),
    ("INTEGER", "int", "int"),
    ("INT", "int", "int"),
    ("INT4", "int", "int"),
    ("SIGNED", "int", "int"),
    ("SMALLINT", "int", "int"),
    ("INT2", "int", "int"),
    ("SHORT", "int", "int"),
    ("USMALLINT", "int", "int"),
    ("TINYINT", "int", "int"),
    ("INT1", "int", "int"),
    ("UTINYINT", "int", "int"),
    ("DOUBLE", "double", "double"),
    ("FLOAT8", "double", "double"),
    ("FLOAT", "float", "float"),
    ("FLOAT4", "float", "float"),
    ("REAL", "float", "float"),
    ("BOOLEAN", "boolean", "boolean"),
    ("BOOL", "boolean", "boolean"),
    ("LOGICAL", "boolean", "boolean"),
    ("DATE", "date", "date"),
    ("TIMESTAMP", "timestamp", "timestamp_ntz"),
    ("DATETIME", "timestamp", "timestamp_ntz"),
    ("TIMESTAMP_S", "timestamp", "timestamp_ntz"),
    ("TIMESTAMP_MS", "timestamp", "timestamp_ntz"),
    ("TIMESTAMP_NS", "timestamp", "timestamp_ntz"),
    ("TIMESTAMP WITH TIME ZONE", "timestamptz", "timestamp"),
    ("TIMESTAMPTZ", "timestamptz", "timestamp"),
    ("TIMESTAMP_TZ", "timestamptz", "timestamp"),
    ("TIME", "time", "string"),
    ("BLOB", "binary", "binary"),
    ("BYTEA", "binary", "binary"),
    ("BINARY", "binary", "binary"),
    ("VARBINARY", "binary", "binary"),
    ("DECIMAL", "decimal(38,10)", "decimal(38,10)"),
    ("NUMERIC", "decimal(38,10)", "decimal(38,10)"),
)

# Types that no lossless target exists for: kept as text, with a warning.
TEXT_FALLBACKS = ("UHUGEINT",)
DECIMAL = r"^(?:DECIMAL|NUMERIC)\((\d+),\s*(\d+)\)$"


def _simple(base: Column, position: int) -> Column:
    pairs = [F.lit(x) for entry in SIMPLE_TYPES for x in (entry[0], entry[position])]
    return F.try_element_at(F.create_map(*pairs), base)


def map_lake_types(columns: DataFrame, type_column: str = "type") -> DataFrame:
    """Add ``target_type``, ``spark_type`` and ``warning`` to a columns table.

    List brackets are taken off first, so that a list of decimals stays a list;
    each pair wraps the element type once.
    """
    raw = F.trim(F.col(type_column))
    base = F.trim(F.upper(F.regexp_replace(raw, r"(\[\])+$", "")))
    depth = ((F.length(raw) - F.length(F.regexp_replace(raw, r"(\[\])+$", ""))) / F.lit(2)).cast("int")
    b = F.col("_base")
    decimal = F.concat(
        F.lit("decimal("), F.regexp_extract(b, DECIMAL, 1), F.lit(","), F.regexp_extract(b, DECIMAL, 2), F.lit(")")
    )
    nested = b.startswith("STRUCT(") | b.startswith("MAP(")
    out_of_range = F.regexp_extract(b, DECIMAL, 1).try_cast("int") > 38

    def element(position: int) -> Column:
        return (
            F.when(b.rlike(DECIMAL) & ~out_of_range, decimal)
            .when(nested | b.rlike(DECIMAL), "string")
            .otherwise(F.coalesce(_simple(b, position), F.lit("string")))
        )

    def wrap(opening: str, inner: Column) -> Column:
        return F.concat(F.repeat(F.lit(opening), F.col("_depth")), inner, F.repeat(F.lit(">"), F.col("_depth")))

    warning = (
        F.when(nested, "nested_as_text")
        .when(b.isin(*TEXT_FALLBACKS) | (b.rlike(DECIMAL) & out_of_range), "too_wide_as_text")
        .when(~b.rlike(DECIMAL) & _simple(b, 1).isNull(), "unknown_as_text")
    )
    return (
        columns.withColumns({"_base": base, "_depth": depth})
        .withColumns(
            {
                "target_type": wrap("list<", element(1)),
                "spark_type": wrap("array<", element(2)),
                "warning": warning,
            }
        )
        .drop("_base", "_depth")
    )


def field_id() -> Column:
    """Ids run from 1 in column order."""
    return (F.col("pos") + 1).cast("int")


def mapping_json(id_: Column | None = None) -> Column:
    """Aggregate: JSON that ties the column names of a table to their ids, by default their positions.

    The group is a table's column list, so it is as wide as a schema and never
    grows with the data.
    """
    entry = F.struct((field_id() if id_ is None else id_).alias("field_id"), F.array("name").alias("names"))
    return F.to_json(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.struct(e["field_id"].alias("field-id"), e["names"].alias("names")),
        )
    )


def schema_json(id_: Column | None = None) -> Column:
    """Aggregate: the fields of a table as JSON, from ``map_lake_types`` output."""
    required = (~F.col("nullable")).alias("required")
    entry = F.struct((field_id() if id_ is None else id_).alias("id"), "name", F.col("target_type").alias("type"), required)
    return F.to_json(F.array_sort(F.collect_list(entry)))


def name_mapping(columns: DataFrame, keys: list[str]) -> DataFrame:
    """``name_mapping`` and ``last_field_id``, one row per table."""
    return columns.groupBy(*keys).agg(mapping_json().alias("name_mapping"), F.max(field_id()).alias("last_field_id"))
