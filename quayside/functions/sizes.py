"""Size estimates of records, as used for flush budgets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cost of a text beside its characters, and of any other value.
TEXT_OVERHEAD = 24
OTHER_VALUE = 8


def text_bytes(text: Column) -> Column:
    """Two bytes per UTF-16 unit plus the overhead.

    ``length`` would count a surrogate pair once, hence the encoding.
    """
    return (F.octet_length(F.encode(text, "UTF-16BE")) + F.lit(TEXT_OVERHEAD)).cast("bigint")


def record_bytes(schema: T.StructType) -> Column:
    """Estimate over typed columns. A null costs as much as a number."""
    total = F.lit(0).cast("bigint")
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            total = total + F.when(c.isNull(), F.lit(OTHER_VALUE)).otherwise(text_bytes(c))
        elif isinstance(field.dataType, T.BinaryType):
            total = total + F.coalesce(F.octet_length(c), F.lit(OTHER_VALUE))
        else:
            total = total + F.lit(OTHER_VALUE)
    return total.cast("bigint")


def payload_bytes(payload: Column) -> Column:
    """Estimate over every key of a decoded record, declared or not."""
    values = F.map_values(F.try_variant_get(payload, "$", "map<string,variant>"))

    def cost(value: Column) -> Column:
        return F.when(
            F.schema_of_variant(value) == "STRING", text_bytes(F.try_variant_get(value, "$", "string"))
        ).otherwise(F.lit(OTHER_VALUE).cast("bigint"))

    return F.aggregate(F.transform(values, cost), F.lit(0).cast("bigint"), lambda total, one: total + one)
