import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import batches
from quayside.operators.scan import running_before
from quayside.streaming import flush

EPOCH = datetime(2024, 1, 1)
SHAPE = "topic string, partition int, offset bigint, timestamp timestamp_ntz, bytes bigint"


def greedy(records, max_bytes, max_age):
    """The rule, one record at a time."""
    out, filling, clock = [], None, None
    for offset, at, size in sorted(records):
        clock = at if clock is None else max(clock, at)
        if filling and (clock - filling[4]).total_seconds() >= max_age:
            out.append((*filling, "age"))
            filling = None
        if not filling:
            filling = (offset, offset, 0, 0, clock, clock)
        filling = (filling[0], offset, filling[2] + 1, filling[3] + size, filling[4], clock)
        if filling[3] >= max_bytes:
            out.append((*filling, "bytes"))
            filling = None
    return out + ([(*filling, "open")] if filling else [])


def make(seed, keys=3, n=250, giants=True):
    """Keys of very different size, bursts, gaps, giant records, late times."""
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        at, offset = EPOCH, rng.randrange(3)
        for _ in range(n if k == 0 else rng.randrange(1, 40)):
            at += timedelta(seconds=rng.choice([0, 0, 1, 5, 30, 400 if rng.random() < 0.05 else 2]))
            late = timedelta(seconds=rng.choice([0, 0, 0, 20]))
            size = rng.choice([8, 40, 100]) if not giants or rng.random() > 0.03 else 5000
            rows.append(("t", k, offset, at - late, size))
            offset += rng.choice([1, 1, 2, 9])
    return rows


def expected(rows, max_bytes, max_age):
    keys = {(r[0], r[1]) for r in rows}
    return sorted(
        (*key, *batch) for key in keys for batch in greedy([r[2:] for r in rows if (r[0], r[1]) == key], max_bytes, max_age)
    )


COLUMNS = ["topic", "partition", "batch_start", "last_offset", "records", "bytes", "first_at", "last_at", "closed_by"]


@pytest.mark.parametrize(
    "seed, max_bytes, max_age, fan, width",
    [(1, 500, 60, 4, 1), (2, 300, 10**6, 4, 1), (3, 10**9, 30, 4, 1), (4, 1, 1, 4, 3), (5, 900, 300, 64, 4), (6, 10**9, 10**6, 4, 1)],
)
def test_cut_matches_the_rule(spark, monkeypatch, seed, max_bytes, max_age, fan, width):
    monkeypatch.setattr(batches, "FAN", fan)
    monkeypatch.setattr(batches, "CELL_BATCHES", width)
    monkeypatch.setattr(batches, "CELL_AGES", width)
    monkeypatch.setattr(batches, "CELL_BYTES", 1)
    rows = make(seed)
    df = spark.createDataFrame(rows, SHAPE).repartition(3)
    got = batches.cut_batches(df, max_bytes, max_age, chunk=16)
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == expected(rows, max_bytes, max_age)


def test_cut_of_nothing(spark):
    assert batches.cut_batches(spark.createDataFrame([], SHAPE), 10, 10).count() == 0


@pytest.mark.parametrize("levels, chunk", [(0, 4), (1, 4), (2, 3)])
def test_running_before(spark, levels, chunk):
    rng = random.Random(7)
    rows = [(k, p * 3, rng.randrange(100)) for k in "ab" for p in range(60)]
    df = spark.createDataFrame(rows, "k string, pos bigint, v bigint")
    got = running_before(df, ["k"], "pos", {"total": ("sum", "v"), "top": ("max", "v")}, chunk, levels)
    for r in got.collect():
        before = [v for k, p, v in rows if k == r["k"] and p < r["pos"]]
        assert (r["total"], r["top"]) == (sum(before), max(before, default=None))


def test_stream_gives_the_closed_batches(spark, tmp_path):
    rows = make(11, n=120)
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    # Four files of rising offsets, one per micro-batch, over two runs.
    rows.sort(key=lambda r: r[2])
    step = len(rows) // 4 + 1
    for run in (0, 2):
        for part in (run, run + 1):
            piece = spark.createDataFrame(rows[part * step : (part + 1) * step], SHAPE)
            piece.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(source)
        closed = flush.cut_micro_batches(stream, 700, 120, out, checkpoint)
    got = sorted(tuple(r) for r in closed.select(*COLUMNS).collect())
    assert got == [b for b in expected(rows, 700, 120) if b[-1] != "open"]


def test_batches_cover_every_record_once(spark):
    rows = make(21, n=300)
    df = spark.createDataFrame(rows, SHAPE)
    total = batches.cut_batches(df, 800, 90).agg(F.sum("records"), F.sum("bytes")).first()
    assert tuple(total) == (len(rows), sum(r[4] for r in rows))
