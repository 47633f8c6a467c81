"""Registration of files in a target catalog, without reading their data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.lake_types import field_id, map_lake_types, mapping_json, schema_json
from quayside.operators.evolve import sync_fields
from quayside.sources import commits

# Registrations behind which the rows are put together.
FOLD_EVERY = 64
FILE = ["table_name", "path"]


def new_files(live: DataFrame, registered: DataFrame) -> DataFrame:
    """Live files that are not registered yet. Running it again gives nothing."""
    return live.join(registered.select(*FILE), FILE, "left_anti").select(*FILE, "record_count", "file_size_bytes")


def stale_registrations(live: DataFrame, registered: DataFrame) -> DataFrame:
    """Registered files that the lake has retired: their rows would count twice."""
    return registered.join(live.select(*FILE), FILE, "left_anti").select(*FILE, "record_count", "file_size_bytes")


def register(live: DataFrame, registered: DataFrame, path: str) -> str:
    """Append the new files' metadata below ``path``, a plain table.

    A write that was cut off may be repeated: what it left counts as registered,
    the rest is appended. Two registrations of one target must not run at once;
    ``register_files`` has neither limit.
    """
    new_files(live, registered).write.mode("append").parquet(path)
    return path


REGISTERED = "table_name string, path string, record_count bigint, file_size_bytes bigint"


def _registered(spark: SparkSession, path: str, history: commits.History) -> DataFrame:
    folders = [history.fold["folder"]] if history.fold else []
    folders += [entry["folder"] for entry in history.tail]
    if not folders:
        return spark.createDataFrame([], REGISTERED)
    return spark.read.schema(REGISTERED).parquet(*[f"{path}/rows/{f}" for f in folders])


def read_registrations(spark: SparkSession, path: str) -> DataFrame:
    """All files that committed registrations have listed below ``path``."""
    return _registered(spark, path, commits.read_history(spark, path))


def register_files(live: DataFrame, path: str, tries: int = commits.TRIES) -> int | None:
    """Register the live files that are not registered yet; returns the number of the commit, None if there were none.

    The rows are written aside and one commit makes them valid, so that a registration that was cut off is
    invisible. One that another has overtaken looks again at what is registered, and leaves out what the other
    has listed. Every FOLD_EVERY commits all rows are put in one folder.
    """
    spark = live.sparkSession
    for _ in range(tries):
        base, folder = commits.read_history(spark, path), uuid.uuid4().hex
        new_files(live, _registered(spark, path, base)).write.parquet(f"{path}/rows/{folder}")
        if spark.read.schema(REGISTERED).parquet(f"{path}/rows/{folder}").isEmpty():
            return None

        def build(history: commits.History, base=base, folder=folder) -> dict | None:
            return {"folder": folder} if history.last == base.last else None

        number = commits.commit(spark, path, build)
        if number is not None:
            if len(base.tail) + 1 >= FOLD_EVERY:
                _fold(spark, path)
            return number
    raise commits.CommitConflict(f"{path} has changed {tries} times meanwhile")


def _fold(spark: SparkSession, path: str) -> None:
    history, folder = commits.read_history(spark, path), uuid.uuid4().hex
    _registered(spark, path, history).write.parquet(f"{path}/rows/{folder}")
    commits.save_fold(spark, path, history.last, {"folder": folder})


def registration_report(live: DataFrame, registered: DataFrame) -> DataFrame:
    """Per table: files and rows to register, and files skipped as known."""
    known = registered.select(*FILE).distinct().withColumn("_known", F.lit(True))
    fresh = F.col("_known").isNull()
    return (
        live.join(known, FILE, "left")
        .groupBy("table_name")
        .agg(
            F.count_if(fresh).alias("new_files"),
            F.coalesce(F.sum(F.when(fresh, F.col("record_count"))), F.lit(0)).cast("bigint").alias("new_rows"),
            F.count_if(~fresh).alias("skipped_files"),
        )
    )


def register_in_iceberg(spark: SparkSession, catalog: str, table: str, path: str) -> DataFrame:
    """The same against an Iceberg catalog, where the session has one configured."""
    if not spark.conf.get(f"spark.sql.catalog.{catalog}", None):
        raise RuntimeError(f"no catalog '{catalog}' in this session: set spark.sql.catalog.{catalog}")
    quoted = {"table": table, "source": "`parquet`.`" + path.replace("`", "``") + "`"}
    quoted = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in quoted.items()}
    name = catalog.replace("`", "``")
    return spark.sql(f"CALL `{name}`.system.add_files(table => '{quoted['table']}', source_table => '{quoted['source']}')")


def created_tables(columns: DataFrame, keys: list[str]) -> DataFrame:
    """Rows for target tables that are created: their fields and name mapping as JSON."""
    return (
        map_lake_types(columns)
        .groupBy(*keys)
        .agg(
            schema_json().alias("schema_json"),
            mapping_json().alias("name_mapping"),
            F.max(field_id()).alias("last_field_id"),
        )
    )


# --- stored targets ------------------------------------------------------------

FIELDS = "array<struct<field_id: int, name: string, type: string, required: boolean>>"


def _in_rows(fields: DataFrame, keys: list[str]) -> DataFrame:
    """One row per table; a group is a table's columns."""
    entry = F.struct(F.col("field_id").cast("int").alias("field_id"), "name", "type", "required")
    return fields.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).cast(FIELDS).alias("fields"))


def _commit_targets(spark: SparkSession, path: str, rows: Callable[[DataFrame | None], DataFrame]) -> int | None:
    """Commit the rows that ``rows`` makes of the stored ones, looking again if another commit came first; None without rows."""
    for _ in range(commits.TRIES):
        base, folder = commits.read_history(spark, path), uuid.uuid4().hex
        rows(_targets(spark, path, base)).write.parquet(f"{path}/rows/{folder}")
        if spark.read.parquet(f"{path}/rows/{folder}").isEmpty():
            return None
        number = commits.commit(spark, path, lambda h, b=base, f=folder: {"folder": f} if h.last == b.last else None)
        if number is not None:
            return number
    raise commits.CommitConflict(f"{path} has changed {commits.TRIES} times meanwhile")


def _targets(spark: SparkSession, path: str, history: commits.History) -> DataFrame | None:
    """Each table's newest row and its ``version``, the number of the commit."""
    parts = [spark.read.parquet(f"{path}/rows/{e['folder']}").withColumn("version", F.lit(e["number"]).cast("bigint")) for e in history.tail]
    if not parts:
        return None
    every = reduce(DataFrame.unionByName, parts)
    keys = [c for c in every.columns if c not in ("fields", "version")]
    return every.groupBy(*keys).agg(F.max_by("fields", "version").alias("fields"), F.max("version").alias("version"))


def read_targets(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored target tables: keys, ``fields`` and ``version``; None before the first."""
    return _targets(spark, path, commits.read_history(spark, path))


def store_targets(columns: DataFrame, keys: list[str], path: str) -> int | None:
    """Create the tables of ``columns`` that are not stored yet, ids in column order."""
    return write_targets(columns.withColumns({"field_id": field_id(), "required": ~F.col("nullable")}), keys, path)


def write_targets(fields: DataFrame, keys: list[str], path: str) -> int | None:
    """Store tables that have ids already: ``keys, field_id, name, type, required``."""
    made = _in_rows(fields, keys)
    return _commit_targets(fields.sparkSession, path, lambda known: made if known is None else made.join(known, keys, "left_anti"))


def sync_targets(declared: DataFrame, keys: list[str], path: str) -> int | None:
    """Store a new version of each target whose fields change safely; the others keep the one they have."""

    def changed(known: DataFrame | None) -> DataFrame:
        if known is None:
            raise ValueError(f"no target is stored at {path}")
        fields = known.select(*keys, F.inline("fields"))
        synced = _in_rows(sync_fields(fields, declared, keys), keys)
        return synced.join(known.select(*keys, F.col("fields").alias("_old")), keys).filter("fields <> _old").drop("_old")

    return _commit_targets(declared.sparkSession, path, changed)


def described_targets(targets: DataFrame, keys: list[str]) -> DataFrame:
    """Schema and name mapping of stored targets as JSON, by their field ids."""
    columns = targets.select(*keys, F.inline("fields")).withColumn("nullable", ~F.col("required"))
    ids = F.col("field_id")
    return (
        map_lake_types(columns)
        .groupBy(*keys)
        .agg(schema_json(ids).alias("schema_json"), mapping_json(ids).alias("name_mapping"), F.max("field_id").alias("last_field_id"))
    )


def reconcile(produced: DataFrame, landed: DataFrame, registered: DataFrame, key: str = "topic") -> DataFrame:
    """Row counts along the way and where they differ; inputs are ``(key, rows)``."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.sum("rows").cast("bigint").alias(name))

    joined = (
        side(produced, "produced").join(side(landed, "landed"), key, "full").join(side(registered, "registered"), key, "full")
    )
    filled = joined.na.fill(0, ["produced", "landed", "registered"])
    return filled.withColumns(
        {
            "not_landed": F.col("produced") - F.col("landed"),
            "not_registered": F.col("landed") - F.col("registered"),
        }
    )
