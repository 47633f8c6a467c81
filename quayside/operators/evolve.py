"""Schema differences of all tables at once, and which of them are safe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the only permitted change of type.
WIDENING = ("BIGINT", "DOUBLE")


def _change(old_type: Column, new_type: Column) -> Column:
    return (
        F.when(old_type.isNull(), "added")
        .when(new_type.isNull(), "removed")
        .when(old_type == new_type, F.lit(None))
        .when((old_type == WIDENING[0]) & (new_type == WIDENING[1]), "widened")
        .otherwise("conflict")
    )


def _alike(keys: list[str]) -> Column:
    """Whether a table has another name that differs in case only. Each name is one row; a window spans the spellings of one name."""
    return F.count("*").over(Window.partitionBy(*keys, F.lower("name"))) > 1


def schema_diff(current: DataFrame, declared: DataFrame, keys: list[str], aliases: str | None = None) -> DataFrame:
    """Changes per table and column: ``added, widened, removed, conflict, rename``.

    Both inputs hold ``keys``, ``name`` and ``type``. Names are matched exactly; a name that would be
    added beside one that differs from it in case only is a conflict, as readers could not tell the two apart.
    ``aliases`` names a column of ``declared`` whose non-empty value marks a
    rename, which is refused whatever the types say.
    """
    renamed = F.coalesce(F.col(aliases) != "", F.lit(False)) if aliases else F.lit(False)
    left = current.select(*keys, "name", F.col("type").alias("old_type"))
    right = declared.select(*keys, "name", F.col("type").alias("new_type"), renamed.alias("_renamed"))
    change = F.when(F.col("_renamed"), "rename").otherwise(_change(F.col("old_type"), F.col("new_type")))
    clash = (F.col("change") == "added") & F.col("_alike")
    return (
        left.join(right, [*keys, "name"], "full")
        .select(*keys, "name", change.alias("change"), "old_type", "new_type", _alike(keys).alias("_alike"))
        .filter(F.col("change").isNotNull())
        .withColumn("change", F.when(clash, "conflict").otherwise(F.col("change")))
        .drop("_alike")
    )


def conflicts(diff: DataFrame, keys: list[str]) -> DataFrame:
    """Tables that cannot evolve, with one reason text each."""
    bad = F.col("change").isin("conflict", "rename")
    text = F.concat_ws(" ", "change", "name", F.concat_ws("->", "old_type", "new_type"))
    return (
        diff.filter(bad)
        .groupBy(*keys)
        .agg(F.count("*").alias("conflicts"), F.min(text).alias("reason"))
    )


def column_drift(here: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """Names that only one side has: ``new`` or ``gone``, or ``case`` where another spelling of the name is there."""
    a = here.select(*keys, "name").distinct().withColumn("_here", F.lit(True))
    b = there.select(*keys, "name").distinct().withColumn("_there", F.lit(True))
    return (
        a.join(b, [*keys, "name"], "full")
        .withColumn("_alike", _alike(keys))
        .filter(F.col("_here").isNull() | F.col("_there").isNull())
        .select(*keys, "name", F.when(F.col("_alike"), "case").when(F.col("_there").isNull(), "new").otherwise("gone").alias("drift"))
    )


def highest_field_id(fields: DataFrame, keys: list[str]) -> DataFrame:
    return fields.groupBy(*keys).agg(F.coalesce(F.max("field_id"), F.lit(0)).alias("highest_field_id"))


def sync_fields(fields: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Fields of registered tables after the safe changes, ids kept and extended.

    ``fields``: ``keys, field_id, name, type, required``. Tables with a conflict, or with a new name that differs
    from another in case only, stay as they are, tables that are not registered are left out, and removed
    columns stay. A window spans the columns of one table, so it is as wide as a
    schema.
    """
    table = Window.partitionBy(*keys)
    both = fields.withColumnRenamed("type", "_old").join(
        declared.select(*keys, "name", "pos", F.col("type").alias("_new"), "nullable"), [*keys, "name"], "full"
    )
    change = F.when(F.col("field_id").isNull() & _alike(keys), "conflict").otherwise(_change(F.col("_old"), F.col("_new")))
    marked = both.withColumn("_change", change).withColumns(
        {
            "_blocked": F.max(F.coalesce(F.col("_change") == "conflict", F.lit(False))).over(table),
            "_highest": F.max("field_id").over(table),
            "_n": F.row_number().over(Window.partitionBy(*keys, F.col("field_id").isNull()).orderBy("pos")),
        }
    )
    stored, blocked = F.col("field_id").isNotNull(), F.col("_blocked")
    # A table without any stored field is not registered.
    return marked.filter(stored | (~blocked & F.col("_highest").isNotNull())).select(
        *keys,
        F.coalesce(F.col("field_id"), F.col("_highest") + F.col("_n")).cast("int").alias("field_id"),
        "name",
        F.when((F.col("_change") == "widened") & ~blocked, F.col("_new")).otherwise(F.coalesce("_old", "_new")).alias("type"),
        F.coalesce(F.col("required"), ~F.col("nullable")).alias("required"),
    )


class SchemaConflict(Exception):
    """A change of schema that is not an added column or a widening."""


def evolve_struct(current: T.StructType | None, declared: T.StructType) -> T.StructType:
    """The table schema after landing ``declared``: the rule above for one table.

    Added columns are nullable even when required, removed ones stay. Names that
    differ in case only are a conflict: readers could not tell them apart.
    """
    known = {n.lower(): n for n in current.names} if current else {}
    seen: dict[str, str] = {}
    for name in declared.names:
        other = seen.setdefault(name.lower(), known.get(name.lower(), name))
        if other != name:
            raise SchemaConflict(f"column '{name}': differs from '{other}' in case only")
    if current is None:
        return declared
    wanted = {f.name: f for f in declared.fields}
    fields = []
    for old in current.fields:
        new = wanted.get(old.name)
        if new is None:
            fields.append(T.StructField(old.name, old.dataType, True, old.metadata))
        elif new.dataType == old.dataType:
            fields.append(old)
        elif isinstance(old.dataType, T.LongType) and isinstance(new.dataType, T.DoubleType):
            fields.append(T.StructField(old.name, new.dataType, old.nullable, old.metadata))
        else:
            raise SchemaConflict(
                f"column '{old.name}': {old.dataType.simpleString()} to {new.dataType.simpleString()} is not a widening"
            )
    old_names = set(current.names)
    fields += [T.StructField(f.name, f.dataType, True, f.metadata) for f in declared.fields if f.name not in old_names]
    return T.StructType(fields)


# Fixed value: the key under which Spark writes a column's id to Parquet files.
FIELD_ID = "parquet.field.id"


def with_field_ids(schema: T.StructType, last: int = 0) -> tuple[T.StructType, int]:
    """The schema with ids for the fields that have none, from ``last`` on, and the last id given."""
    fields = []
    for f in schema.fields:
        if FIELD_ID not in f.metadata:
            last += 1
            f = T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, FIELD_ID: last})
        fields.append(f)
    return T.StructType(fields), last


def renamed(schema: T.StructType, old: str, new: str) -> T.StructType:
    """The schema with a column under a new name and its old id."""
    if old not in schema.names:
        raise SchemaConflict(f"column '{old}': there is none to rename")
    for name in schema.names:
        if name != old and name.lower() == new.lower():
            raise SchemaConflict(f"column '{new}': the name is taken by '{name}'")
    return T.StructType([T.StructField(new if f.name == old else f.name, f.dataType, f.nullable, f.metadata) for f in schema.fields])


def by_field_id(rows: DataFrame, stored: T.StructType, wanted: T.StructType) -> DataFrame:
    """``rows``, which have the names of ``stored``, as ``wanted``: columns are matched by their id, widened where
    the types differ and null where absent."""
    names = {f.metadata.get(FIELD_ID, f.name): f.name for f in stored.fields}
    columns = []
    for f in wanted.fields:
        name = names.get(f.metadata.get(FIELD_ID, f.name))
        columns.append((F.lit(None) if name is None else F.col(f"`{name}`")).cast(f.dataType).alias(f.name))
    return rows.select(*columns)
