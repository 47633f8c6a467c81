"""Table names and file paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the directory that holds a lake's files inside its bucket.
LAKE_DIRECTORY = "ducklake"


def is_name(table: Column) -> Column:
    """Text before the first dot, or the whole text if there is none."""
    return F.substring_index(table, ".", 1)


def table_name(table: Column) -> Column:
    """Text after the first dot, or the whole text if there is none."""
    return F.when(F.contains(table, F.lit(".")), F.substr(table, F.instr(table, ".") + F.lit(1))).otherwise(table)


def lake_name(table: Column) -> Column:
    return F.concat(is_name(table), F.lit("__"), F.replace(table_name(table), F.lit("."), F.lit("__")))


def table_root(owner: Column, lake_table: Column) -> Column:
    """Folder under which the relative files of one lake table live."""
    return F.concat(F.lit("s3://"), owner, F.lit(f"/{LAKE_DIRECTORY}/main/"), lake_table, F.lit("/"))


def resolve_path(path: Column, path_is_relative: Column, root: Column) -> Column:
    return F.when(path_is_relative, F.concat(root, path)).otherwise(path)
