"""File catalog tables: live files, tables, columns and snapshots.

``files``: table_id, table_name, path, path_is_relative, record_count,
file_size_bytes, snapshot_id, end_snapshot. ``tables``: table_id, table_name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from quayside.functions.names import resolve_path


def is_live() -> Column:
    return F.col("end_snapshot").isNull()


def list_tables(tables: DataFrame) -> DataFrame:
    return tables.select("table_name").distinct()


def newest_incarnation(tables: DataFrame) -> DataFrame:
    return tables.groupBy("table_name").agg(F.max("table_id").alias("table_id"))


def live_files(files: DataFrame, tables: DataFrame, root: Column | None = None) -> DataFrame:
    """Live files of the newest incarnation of every table, in one job.

    Files carry the table's id, which is unique, so the name is taken from
    ``tables`` and the join is an equi-join on the id alone.
    """
    newest = newest_incarnation(tables)
    live = files.filter(is_live()).drop("table_name").join(newest, "table_id")
    if root is not None:
        live = live.withColumn("path", resolve_path(F.col("path"), F.col("path_is_relative"), root))
    return live.select("table_name", "table_id", "path", "record_count", "file_size_bytes", "snapshot_id")


def file_totals(live: DataFrame, tables: DataFrame) -> DataFrame:
    """Files, rows and bytes per table; a table without files gives zeros."""
    totals = live.groupBy("table_name").agg(
        F.count("*").alias("_files"), F.sum("record_count").alias("_rows"), F.sum("file_size_bytes").alias("_bytes")
    )
    return (
        list_tables(tables)
        .join(totals, "table_name", "left")
        .select(
            "table_name",
            F.coalesce("_files", F.lit(0)).cast("bigint").alias("files"),
            F.coalesce("_rows", F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce("_bytes", F.lit(0)).cast("bigint").alias("bytes"),
        )
    )


def empty_tables(live: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables without live files: registration skips them."""
    return list_tables(tables).join(live.select("table_name"), "table_name", "left_anti")


def file_count(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    return snapshots.agg(F.coalesce(F.max("snapshot_id"), F.lit(0)).cast("bigint").alias("snapshot_id"))


def recent_snapshots(snapshots: DataFrame, count: int = 5) -> DataFrame:
    """A top-k report, newest first."""
    return snapshots.orderBy(F.desc("snapshot_id")).limit(count)


def recent_changes(changes: DataFrame, count: int = 10) -> DataFrame:
    """Changes made by the newest snapshots: a top-k report."""
    return changes.orderBy(F.desc("snapshot_id")).limit(count)


def target_presence(tables: DataFrame, registered_tables: DataFrame) -> DataFrame:
    """Which tables exist in the target and which have to be created."""
    known = registered_tables.select("table_name").distinct().withColumn("_known", F.lit(True))
    return (
        list_tables(tables)
        .join(known, "table_name", "left")
        .select("table_name", F.when(F.col("_known"), "load").otherwise("create").alias("action"))
    )


# Spark type to lake type, for describing what is stored.
LAKE_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "binary": "BLOB",
}


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when there is no such path or no data file in it.

    A folder without files is what a first write leaves that did not end. Any
    other failure is raised.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def describe(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema stored at ``path``, or None when nothing is there."""
    stored = read_if_there(spark, path)
    return None if stored is None else stored.schema


def describe_columns(spark: SparkSession, table_name: str, schema: T.StructType) -> DataFrame:
    """A schema as a columns table ``(table_name, pos, name, type, nullable)``."""
    rows = [
        (table_name, pos, f.name, LAKE_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()), f.nullable)
        for pos, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, "table_name string, pos int, name string, type string, nullable boolean")
