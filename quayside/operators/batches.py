"""Cutting a topic's ordered records into flush batches by bytes and by age.

A batch closes after the record that brings it to ``max_bytes``, and before a
record that arrives ``max_age`` or more after the batch's first record. Where a
batch starts therefore depends on where the one before it ended, which makes
the cut sequential within a partition of a topic. To keep a hot partition off
a single task, the records are cut into cells a few batches wide:

1. each cell works out, for every record that a batch may start at, where the
   next batch would start (its halo holds the rows needed beyond the cell);
2. these jumps are composed over 64 cells at a time, level by level;
3. from each partition's first record the true starts are read off, down the
   same levels.

Every task holds one cell or 64 short jump lists, whatever the size of the key.
Arrival times that run backwards are read as the latest time seen so far.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.scan import CHUNK, running_before, whole
from quayside.session import cut_lineage

# Least width of a cell in batches: halos then add about a quarter of the rows.
# Small batches share a cell of up to CELL_BYTES, so a cell's rows stay bounded
# by its bytes and its age is only a second bound.
CELL_BATCHES = 4
CELL_AGES = 256
CELL_BYTES = 32 * 1024 * 1024
FAN = 64
# Cells after its own into which the last batch of a cell can reach: one more
# step of bytes, one more of age, and the first row after both.
REACH = 3
END = -1


def _clocked(records: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """Rows with the bytes before them and a clock that never runs backwards."""
    base = records.select(
        *keys,
        F.col("offset").alias("pos"),
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias("_at"),
        F.col("bytes").cast("bigint").alias("bytes"),
    )
    totals = {"before": ("sum", "bytes"), "_latest": ("max", "_at")}
    return running_before(base, keys, "pos", totals, chunk).select(
        *keys, "pos", "before", F.coalesce(F.greatest("_at", "_latest"), F.lit(0)).alias("clock"), "bytes"
    )


def _cells(rows: DataFrame, keys: list[str], max_bytes: int, age: int) -> DataFrame:
    """Rows with their cell number, copied into the earlier cells that need them.

    ``cell`` is where the copy works, ``home`` where the row belongs.
    """
    grid = [*keys, "_b", "_t"]
    placed = rows.withColumns(
        {
            "_b": whole(F.col("before"), max(CELL_BATCHES * max_bytes, CELL_BYTES)),
            "_t": whole(F.col("clock"), CELL_AGES * age),
        }
    )
    ordered = Window.partitionBy(*keys).orderBy("_b", "_t")
    numbered = (
        placed.groupBy(*grid)
        .agg(F.max("before").alias("_lb"), F.max("clock").alias("_lc"))
        .withColumns(
            {
                "home": (F.row_number().over(ordered) - 1).cast("bigint"),
                "_lb1": F.lag("_lb", 1).over(ordered),
                "_lc1": F.lag("_lc", 1).over(ordered),
                "_lb2": F.lag("_lb", 2).over(ordered),
                "_lc2": F.lag("_lc", 2).over(ordered),
            }
        )
    )
    inside = Window.partitionBy(*grid).orderBy("pos")
    marked = placed.join(numbered, grid).withColumns(
        {"_pb": F.lag("before").over(inside), "_pc": F.lag("clock").over(inside)}
    )
    first = F.col("_pb").isNull()

    def reached(last_before: str, last_clock: str):
        # The row before this one could still belong to a batch begun back there.
        return (F.col("_pb") < F.col(last_before) + max_bytes) & (F.col("_pc") < F.col(last_clock) + age)

    home = F.col("home")
    wanted = F.array_compact(
        F.array(
            home,
            F.when((home >= 1) & (first | reached("_lb1", "_lc1")), home - 1),
            F.when((home >= 2) & (first | reached("_lb2", "_lc2")), home - 2),
            F.when((home >= REACH) & first, home - REACH),
        )
    )
    return (
        marked.withColumn("_to", wanted)
        .withColumn("entry", (F.size("_to") > 1) | ((home == 0) & first))
        .select(*keys, F.explode("_to").alias("cell"), "home", "pos", "before", "clock", "bytes", "entry")
    )


def _next_starts(pdf: pd.DataFrame, own: int, max_bytes: int, age: int) -> np.ndarray:
    """Index of the next batch's first row for a batch begun at each own row."""
    before, clock = pdf["before"].to_numpy(), pdf["clock"].to_numpy()
    by_bytes = np.searchsorted(before, before[:own] + max_bytes, side="left")
    by_age = np.searchsorted(clock, clock[:own] + age, side="left")
    return np.minimum(by_bytes, by_age)


def _follow(step: np.ndarray, inside: int) -> np.ndarray:
    """Follow ``step`` from every index until it leaves ``[0, inside)``."""
    while inside and (step[:inside] < inside).any():
        step = step[step]
    return step


def _jumps(keys: list[str], max_bytes: int, age: int):
    """Per cell: from each possible entry to the first start beyond the cell."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", ignore_index=True)
        own = int((pdf["home"] == pdf["cell"]).sum())
        step = np.concatenate([_next_starts(pdf, own, max_bytes, age), np.arange(own, len(pdf) + 1)])
        leaves = _follow(step, own)[:own]
        pos = np.append(pdf["pos"].to_numpy(), END)
        home = np.append(pdf["home"].to_numpy(), END)
        picked = np.flatnonzero(pdf["entry"].to_numpy()[:own])
        out = pdf.iloc[picked][keys].copy()
        out["cell"] = pdf["home"].to_numpy()[picked]
        out["enter"] = pos[picked]
        out["exit_cell"] = home[leaves[picked]]
        out["exit"] = pos[leaves[picked]]
        return out

    return run


def _compose(keys: list[str]):
    """Per group of cells: the same jumps over the whole group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("enter", ignore_index=True)
        size, group = len(pdf), int(pdf["_group"].iloc[0])
        stays = (pdf["exit_cell"].to_numpy() != END) & (pdf["exit_cell"].to_numpy() // FAN == group)
        target = np.searchsorted(pdf["enter"].to_numpy(), pdf["exit"].to_numpy())
        # Index of the following jump, or the own index shifted out of range.
        step = np.concatenate([np.where(stays, target, np.arange(size) + size), np.arange(size, 2 * size)])
        last = _follow(step, size)[:size] - size
        out = pdf[keys].copy()
        out["cell"] = group
        out["enter"] = pdf["enter"]
        leaving = pdf["exit_cell"].to_numpy()[last]
        out["exit_cell"] = np.where(leaving == END, END, leaving // FAN)
        out["exit"] = pdf["exit"].to_numpy()[last]
        return out[(pdf["cell"] % FAN < REACH).to_numpy()]

    return run


def _walk(keys: list[str]):
    """Per group of cells and its true entry: the true entries of its cells."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["_group"].iloc[0])
        jump = {r.enter: (r.cell, r.exit_cell, r.exit) for r in pdf.itertuples(index=False)}
        at, visited = int(pdf["_start"].iloc[0]), []
        while at in jump:
            cell, exit_cell, leave = jump[at]
            visited.append((cell, at))
            if exit_cell == END or exit_cell // FAN != group:
                break
            at = leave
        out = pd.DataFrame(visited, columns=["cell", "start"])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "cell", "start"]]

    return run


def _parts(keys: list[str], max_bytes: int, age: int):
    """Per cell: totals of the pieces of batches in it.

    Rows ahead of the cell's first start belong to a batch begun earlier; their
    piece has no ``batch_start``.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        start = pdf["start"].iloc[0]
        pdf = pdf.sort_values("pos", ignore_index=True)
        own = int((pdf["home"] == pdf["cell"]).sum())
        nxt = _next_starts(pdf, own, max_bytes, age)
        pos = pdf["pos"].to_numpy()[:own]
        begins = []
        if not pd.isna(start):
            at = int(np.searchsorted(pos, int(start)))
            while at < own:
                begins.append(at)
                at = int(nxt[at])
        edges = np.array(([] if begins and begins[0] == 0 else [0]) + begins)
        ends = np.append(edges[1:], own) - 1
        clock = pdf["clock"].to_numpy()
        out = pd.DataFrame({k: [pdf[k].iloc[0]] * len(edges) for k in keys})
        out["pos"] = pos[edges]
        out["batch_start"] = pd.array(
            [int(pos[e]) if e in set(begins) else None for e in edges], dtype="Int64"
        )
        out["last_offset"] = pos[ends]
        out["records"] = ends - edges + 1
        out["bytes"] = np.add.reduceat(pdf["bytes"].to_numpy()[:own], edges)
        out["first_at"], out["last_at"] = clock[edges], clock[ends]
        out["open"] = [bool(e in set(begins) and nxt[e] >= len(pdf)) for e in edges]
        return out

    return run


def cut_batches(
    records: DataFrame,
    max_bytes: int,
    max_age_seconds: float,
    keys: tuple[str, ...] = ("topic", "partition"),
    chunk: int = CHUNK,
) -> DataFrame:
    """Flush batches of ``(keys, offset, timestamp, bytes)``.

    Output per batch: ``batch_start`` (its first offset), ``last_offset``,
    ``records``, ``bytes``, ``first_at``, ``last_at`` and ``closed_by``
    (``bytes``, ``age``, or ``open`` for the batch still filling).
    """
    by, age = list(keys), int(max_age_seconds * 1_000_000)
    kinds = {f.name: f.dataType for f in records.schema.fields}
    key_fields = [T.StructField(k, kinds[k]) for k in by]

    def shape(**columns: T.DataType) -> T.StructType:
        return T.StructType(key_fields + [T.StructField(n, t) for n, t in columns.items()])

    long = T.LongType()
    jump_shape = shape(cell=long, enter=long, exit_cell=long, exit=long)
    # The clock is read for the grid and for the rows, so it is stored; the records are read once.
    rows = cut_lineage(_cells(cut_lineage(_clocked(records, by, chunk), "clocked"), by, max_bytes, age))

    levels = [cut_lineage(rows.groupBy(*by, "cell").applyInPandas(_jumps(by, max_bytes, age), jump_shape))]
    while (levels[-1].agg(F.max("cell")).first()[0] or 0) > 0:
        grouped = levels[-1].withColumn("_group", whole(F.col("cell"), FAN))
        levels.append(cut_lineage(grouped.groupBy(*by, "_group").applyInPandas(_compose(by), jump_shape)))

    # The top level has one group per key: its first record starts the first batch.
    true = levels[-1].groupBy(*by, "cell").agg(F.min("enter").alias("start"))
    for level in reversed(levels[:-1]):
        above = true.withColumnsRenamed({"cell": "_group", "start": "_start"})
        children = level.withColumn("_group", whole(F.col("cell"), FAN)).join(above, [*by, "_group"])
        true = children.groupBy(*by, "_group").applyInPandas(_walk(by), shape(cell=long, start=long))

    part_shape = shape(
        pos=long, batch_start=long, last_offset=long, records=long, bytes=long, first_at=long, last_at=long, open=T.BooleanType()
    )
    # Read for the totals of chunks and for the rows.
    parts = cut_lineage(
        rows.join(true, [*by, "cell"], "left").groupBy(*by, "cell").applyInPandas(_parts(by, max_bytes, age), part_shape), "parts"
    )
    owned = running_before(parts, by, "pos", {"_earlier": ("max", "batch_start")}, chunk)
    return (
        owned.withColumn("batch_start", F.coalesce("batch_start", "_earlier"))
        .groupBy(*by, "batch_start")
        .agg(
            F.max("last_offset").alias("last_offset"),
            F.sum("records").alias("records"),
            F.sum("bytes").alias("bytes"),
            F.timestamp_micros(F.min("first_at")).cast("timestamp_ntz").alias("first_at"),
            F.timestamp_micros(F.max("last_at")).cast("timestamp_ntz").alias("last_at"),
            F.max("open").alias("_open"),
        )
        .withColumn(
            "closed_by", F.when(F.col("bytes") >= max_bytes, "bytes").when(F.col("_open"), "open").otherwise("age")
        )
        .drop("_open")
    )
