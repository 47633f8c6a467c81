"""Reading files of several schema versions together, and rewriting them larger."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import EXPORT_BYTES
from quayside.session import settings

MAX_PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Partition values that a task writes side by side: its rows need not be sorted in memory by their value,
# unless it meets more values than that.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "64"}
# File sizes alone decide what one task reads: no price for opening a file, no
# share for each core.
BY_SIZE = {
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.files.minPartitionNum": "1",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name: widened where the types differ, null where absent."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def union_versions(parts: Iterable[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by name of files with different columns; missing ones become null.

    With a target schema each part is cast first: Spark will not read an INT64
    file as DOUBLE by itself.
    """
    shaped = [cast_to(p, schema) if schema else p for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)


def lossy_widenings(df: DataFrame, column: str) -> DataFrame:
    """Rows whose BIGINT loses digits when read as DOUBLE (beyond 2 to the power 53)."""
    value = F.col(column)
    back = value.cast("double").cast("decimal(38,0)")
    return df.filter(back != value.cast("decimal(38,0)"))


def compact(df: DataFrame, path: str, target_bytes: int = EXPORT_BYTES, partition_by: str | None = None) -> None:
    """Rewrite ``df`` below ``path`` as files of about ``target_bytes``.

    Without partitioning nothing is shuffled: the scan packs small files into
    tasks of the target size and each task writes one file. With a partition
    column the rows are rebalanced on it, which merges small partitions and
    splits a hot one; a task writes its few partitions side by side, without a sort.
    """
    spark = df.sparkSession
    size = str(target_bytes)
    with settings(spark, {MAX_PARTITION_BYTES: size, ADVISORY_BYTES: size, **BY_SIZE, **WRITERS}):
        if partition_by:
            df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)


def file_rows(spark: SparkSession, *paths: str, **options: str) -> DataFrame:
    """``path, record_count, file_size_bytes`` of the Parquet files below ``paths``.

    No column is read, so only footers are opened. The schema names none, so that no file is opened to infer one.
    """
    files = spark.read.options(**options).schema("_none boolean").parquet(*paths)
    return (
        files.groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").cast("bigint").alias("file_size_bytes")
        )
        .agg(F.count("*").alias("record_count"))
        .select("path", "record_count", "file_size_bytes")
    )


def damage_report(spark: SparkSession, paths: list[str], manifest: DataFrame) -> DataFrame:
    """Listed files that are not as the manifest has them, told from their lengths and footers; no rows are read.

    ``damage``: ``missing``, ``unreadable`` (the footer, as of a file that was cut off), ``size``
    (another length than listed) or ``rows`` (another count than listed). ``paths`` are the folders of the files.
    """
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    sizes = there.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").cast("bigint").alias("size_found"))
    footers = file_rows(spark, *paths, ignoreCorruptFiles="true", recursiveFileLookup="true")
    found = sizes.join(footers.select("path", F.col("record_count").alias("rows_found")), "path", "left")
    damage = (
        F.when(F.col("size_found").isNull(), "missing")
        .when(F.col("rows_found").isNull(), "unreadable")
        .when(F.col("size_found") != F.col("file_size_bytes"), "size")
        .when(F.col("rows_found") != F.col("record_count"), "rows")
    )
    return (
        manifest.select("path", "record_count", "file_size_bytes")
        .join(found, "path", "left")
        .withColumn("damage", damage)
        .filter("damage IS NOT NULL")
        .select("path", "damage", "record_count", "rows_found", "file_size_bytes", "size_found")
    )


def read_skipping_corrupt(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the readable files; a broken file is skipped."""
    return spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)


def short_files(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of which fewer rows were read than the manifest promises.

    ``rows`` still carries the hidden file metadata of its read.
    """
    read = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("_read"))
    return (
        manifest.select("path", "record_count")
        .join(read, "path", "left")
        .withColumn("rows_read", F.coalesce("_read", F.lit(0)).cast("bigint"))
        .filter(F.col("rows_read") < F.col("record_count"))
        .select("path", "record_count", "rows_read")
    )
