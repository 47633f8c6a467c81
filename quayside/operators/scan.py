"""Running totals along an ordered position without one task per key.

A window over a whole key would sort all rows of a hot key in one task. Here
the position is cut into chunks: totals per chunk are pre-aggregated, scanned,
and joined back, and the row-level window stays inside one chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 65536


def whole(position: Column, size: int) -> Column:
    """Integer division, exact where a double would round."""
    return F.call_function("div", position, F.lit(size))


def running_before(
    df: DataFrame, keys: list[str], position: str, totals: dict[str, tuple[str, str]], chunk: int = CHUNK, levels: int = 1
) -> DataFrame:
    """Add the running total over all earlier rows of the same key.

    ``totals`` maps a new column to ``(kind, source)`` with kind ``sum`` (0 at
    the start) or ``max`` (null at the start). ``position`` is a whole number,
    unique within a key; gaps are fine. Every level divides the rows of the last,
    unchunked scan by up to ``chunk``.
    """
    block = f"_block{levels}"
    partition = [*keys, block] if levels else keys
    earlier = Window.partitionBy(*partition).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)

    def total(kind: str, source: str) -> Column:
        return F.sum(source) if kind == "sum" else F.max(source)

    local = {out: total(kind, source).over(earlier) for out, (kind, source) in totals.items()}
    if not levels:
        zero = {out: F.coalesce(c, F.lit(0)) if totals[out][0] == "sum" else c for out, c in local.items()}
        return df.withColumns(zero)

    chunked = df.withColumn(block, whole(F.col(position), chunk))
    sums = chunked.groupBy(*partition).agg(*[total(kind, source).alias(f"_s_{out}") for out, (kind, source) in totals.items()])
    carried = running_before(
        sums, keys, block, {f"_c_{out}": (kind, f"_s_{out}") for out, (kind, _) in totals.items()}, chunk, levels - 1
    ).select(*partition, *[f"_c_{out}" for out in totals])

    joined = chunked.join(carried, partition)
    combined = {
        out: F.coalesce(local[out], F.lit(0)) + F.col(f"_c_{out}")
        if kind == "sum"
        else F.greatest(local[out], F.col(f"_c_{out}"))
        for out, (kind, _) in totals.items()
    }
    return joined.withColumns(combined).drop(block, *[f"_c_{out}" for out in totals])
