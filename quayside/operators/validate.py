"""Checks of decoded records against a declared schema, and the typed projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATIONS = "array<struct<column:string,rule:string>>"
# Fixed value: 2 to the power of 63, first whole number beyond a BIGINT.
TWO_63 = 2.0**63


class InvalidRecords(Exception):
    """Raised under ``on_invalid='stop'``; the message says which rules failed."""


def _path(name: str) -> str:
    return f"$['{name}']"


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")


def _whole_number_rule(node: Column, kind: Column) -> Column:
    """``2.0`` and ``1e2`` are whole numbers. Decimal kinds name their scale, so
    a fraction shows in the kind; exponents arrive as doubles. NaN sorts above
    every number."""
    number = F.try_variant_get(node, "$", "double")
    return (
        F.when(kind == "BIGINT", F.lit(None))
        .when(
            kind.startswith("DECIMAL"),
            F.when(~kind.endswith(",0)"), "fraction").when(
                F.try_variant_get(node, "$", "bigint").isNull(), "out_of_range"
            ),
        )
        .when(
            kind == "DOUBLE",
            F.when((number >= TWO_63) | (number < -TWO_63), "out_of_range").when(F.floor(number) != number, "fraction"),
        )
        .otherwise("wrong_type")
    )


def _finite_rule(node: Column, kind: Column) -> Column:
    """Whole numbers and decimals are finite by construction."""
    number = F.try_variant_get(node, "$", "double")
    return (
        F.when((kind == "BIGINT") | kind.startswith("DECIMAL"), F.lit(None))
        .when(kind == "DOUBLE", F.when(~(F.abs(number) < float("inf")), "not_finite"))
        .otherwise("wrong_type")
    )


def _type_rule(field: T.StructField, node: Column, kind: Column) -> Column:
    if isinstance(field.dataType, T.LongType):
        return _whole_number_rule(node, kind)
    if isinstance(field.dataType, T.DoubleType):
        return _finite_rule(node, kind)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(kind != "BOOLEAN", "wrong_type")
    if field.metadata.get("nested"):
        return F.when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), "wrong_type")
    return F.when(kind != "STRING", "wrong_type")


def _coerced_rule(field: T.StructField, node: Column, kind: Column) -> Column:
    """Lenient reading: text that casts is accepted, numbers keep their strict rule."""
    text = F.try_variant_get(node, "$", "string")
    cast = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.DoubleType):
        read = F.when(cast.isNull(), "wrong_type").when(F.isnan(cast) | (F.abs(cast) == float("inf")), "not_finite")
    else:
        read = F.when(cast.isNull(), "wrong_type")
    if isinstance(field.dataType, (T.LongType, T.DoubleType)):
        return F.when(_is_number(kind), _type_rule(field, node, kind)).otherwise(read)
    return read


def validate(decoded: DataFrame, schema: T.StructType, coerce: bool = False) -> DataFrame:
    """Add ``violations``: every broken rule of every column, empty when none.

    Rules: ``missing`` and ``null`` for required columns, ``wrong_type``,
    ``fraction``, ``out_of_range``, ``not_finite``. A payload that cannot be
    read at all gives one violation of column ``$``. All row-local: no shuffle.
    """
    names = [f.name for f in schema.fields]
    typed = decoded.withColumn(
        "_nodes", F.struct(*[F.try_variant_get("payload", _path(n), "variant").alias(n) for n in names])
    ).withColumn("_kinds", F.struct(*[F.schema_of_variant(F.col("_nodes")[n]).alias(n) for n in names]))
    rules = []
    for field in schema.fields:
        node, kind = F.col("_nodes")[field.name], F.col("_kinds")[field.name]
        by_type = _coerced_rule(field, node, kind) if coerce else _type_rule(field, node, kind)
        absent = F.lit(None) if field.nullable else F.lit("missing")
        null = F.lit(None) if field.nullable else F.lit("null")
        rules.append(F.when(node.isNull(), absent).when(kind == "VOID", null).otherwise(by_type).alias(field.name))
    ruled = typed.withColumn("_rules", F.struct(*rules))

    def violation(name: str, rule: Column) -> Column:
        return F.when(rule.isNotNull(), F.struct(F.lit(name).alias("column"), rule.alias("rule")))

    each = F.array(*[violation(n, F.col("_rules")[n]) for n in names]).cast(VIOLATIONS)
    nothing = F.array().cast(VIOLATIONS)
    violations = (
        F.when(F.col("payload_error").isNotNull(), F.array(violation("$", F.col("payload_error"))).cast(VIOLATIONS))
        .when(F.coalesce(*[F.col("_rules")[n] for n in names]).isNull(), nothing)
        # Drops the nulls; unlike a lambda it stays inside generated code.
        .otherwise(F.array_except(each, F.array(F.lit(None)).cast(VIOLATIONS)))
    )
    # A one-element explode, because filters on its output are not pushed below
    # it: a pushed filter would parse and check every record a second time.
    return ruled.select(*decoded.columns, F.explode(F.array(violations)).alias("violations"))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("violations") == 0)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("violations") > 0)


def typed_columns(schema: T.StructType, coerce: bool = False) -> list[Column]:
    """The declared columns read from ``payload`` by name; a missing key gives null."""

    def typed(field: T.StructField) -> Column:
        read = F.try_variant_get("payload", _path(field.name), field.dataType.simpleString())
        if not coerce:
            return read
        text = F.try_variant_get("payload", _path(field.name), "string").try_cast(field.dataType)
        return F.coalesce(read, text) if isinstance(field.dataType, (T.LongType, T.DoubleType)) else text

    return [typed(f).alias(f.name) for f in schema.fields]


def conform(decoded: DataFrame, schema: T.StructType, keep: list[str] | None = None, coerce: bool = False) -> DataFrame:
    """Project to the declared columns, after the columns to keep."""
    return decoded.select(*(keep or []), *typed_columns(schema, coerce))


def unknown_keys(decoded: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Keys that the schema does not declare, counted per topic."""
    declared = F.array(*[F.lit(f.name) for f in schema.fields])
    return (
        decoded.filter(F.col("payload_error").isNull())
        .select("topic", F.explode(F.array_except(F.json_object_keys(F.col(value).cast("string")), declared)).alias("key"))
        .groupBy("topic", "key")
        .agg(F.count("*").alias("records"))
    )


def rule_counts(validated: DataFrame) -> DataFrame:
    """Violations per topic, column and rule."""
    return (
        validated.select("topic", F.inline("violations"))
        .groupBy("topic", "column", "rule")
        .agg(F.count("*").alias("violations"))
    )


def summary(validated: DataFrame, size: Column) -> DataFrame:
    """Per topic: records, accepted, rejected and estimated bytes, in one pass."""
    good = F.size("violations") == 0
    return validated.groupBy("topic").agg(
        F.count("*").alias("records"),
        F.count_if(good).alias("accepted"),
        F.count_if(~good).alias("rejected"),
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("bytes"),
    )
