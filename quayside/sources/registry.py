"""Schema registry as a table ``(group_id, artifact_id, version, schema_json)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.json_schema import columns_of

ARTIFACT = ["group_id", "artifact_id"]
# Fixed value: the only compatibility mode that may be landed.
REQUIRED_MODE = "BACKWARD"


def latest_schemas(registry: DataFrame) -> DataFrame:
    """The newest version of every artifact, by partial aggregation."""
    newest = F.max(F.struct("version", "schema_json"))
    return (
        registry.groupBy(*ARTIFACT)
        .agg(newest.alias("_n"))
        .select(*ARTIFACT, F.col("_n.version").alias("version"), F.col("_n.schema_json").alias("schema_json"))
    )


def effective_mode(artifacts: DataFrame, rules: DataFrame) -> DataFrame:
    """Compatibility mode: the artifact's rule, else the global one, else ``NONE``.

    ``rules`` is ``(group_id, artifact_id, mode)``; the global rule has null
    keys. A rule that exists without a mode counts as ``NONE``.
    """
    own = rules.filter(F.col("artifact_id").isNotNull()).select(
        *ARTIFACT, F.coalesce("mode", F.lit("NONE")).alias("_own")
    )
    fallback = rules.filter(F.col("artifact_id").isNull()).select(F.max("mode")).scalar()
    return (
        artifacts.select(*ARTIFACT)
        .distinct()
        .join(own, ARTIFACT, "left")
        .select(*ARTIFACT, F.coalesce("_own", fallback, F.lit("NONE")).alias("mode"))
    )


def ungoverned(artifacts: DataFrame, rules: DataFrame) -> DataFrame:
    """Artifacts whose mode keeps them from being landed."""
    return effective_mode(artifacts, rules).filter(F.col("mode") != REQUIRED_MODE)


def schema_faults(registry: DataFrame, nested: str = "text") -> DataFrame:
    """Every reason why a column of an artifact is refused."""
    return (
        columns_of(registry, nested)
        .filter(F.col("error").isNotNull())
        .select(*ARTIFACT, "version", F.coalesce("name", F.lit("$")).alias("name"), "error")
    )


def landable_columns(registry: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns of the newest schemas that are governed and free of faults.

    The window spans the columns of one schema.
    """
    artifact = Window.partitionBy(*ARTIFACT)
    columns = columns_of(latest_schemas(registry)).withColumn("_faults", F.count("error").over(artifact))
    return (
        columns.filter(F.col("_faults") == 0)
        .join(ungoverned(registry, rules), ARTIFACT, "left_anti")
        .select(*ARTIFACT, "version", "pos", "name", "type", "nullable")
    )
