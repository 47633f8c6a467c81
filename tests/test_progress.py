"""Continuous topics, reports of streams, limits from the log, incremental roll-ups."""

import time

import pytest
from pyspark.sql import functions as F

from quayside.config import TopicSettings
from quayside.operators import telemetry
from quayside.sources.topics import read_topic_files
from quayside.streaming import landing, progress
from tests.test_landing import SETTINGS, V0, ids, put, records


def test_a_failing_topic_is_reported_while_another_runs_on(spark, tmp_path):
    jobs, told = [], []
    for topic, text in [("good", '{"id":%d,"v":%d}'), ("bad", "broken")]:
        source, target = str(tmp_path / topic), str(tmp_path / f"{topic}-out")
        put(spark, source, 0, 5, text=text, topic=topic)
        settings = TopicSettings(name=topic, table=f"team.{topic}", min_flush_seconds=1)
        jobs.append(landing.LandingJob(settings, read_topic_files(spark, source), lambda: V0, target, f"{target}-cp", "stop", bounded=False))
    log = progress.ProgressLog(spark, str(tmp_path / "reports"))
    spark.streams.addListener(log)
    later, deadline = [], time.monotonic() + 120

    def until():
        if told and not later:
            # The bad topic is over; records that come now are still landed.
            put(spark, str(tmp_path / "good"), 5, 9, text='{"id":%d,"v":%d}', topic="good")
            later.append(1)
        done = later and landing.committed(spark, jobs[0].target).last >= 1
        return done or time.monotonic() > deadline

    try:
        got = {tuple(r) for r in landing.land_topics(spark, jobs, told=lambda *row: told.append(row), until=until).collect()}
    finally:
        spark.streams.removeListener(log)
    assert told[0] == ("bad", "stopped", "invalid_records: $ not_json")
    assert got == {told[0], ("good", "ended", None)}
    assert ids(spark, jobs[0].target) == list(range(9))
    for _ in range(60):
        try:
            ended = progress.read_ended(spark, str(tmp_path / "reports")).collect()
        except Exception:
            ended = []
        if len(ended) == 2:
            break
        time.sleep(0.5)
    assert sorted((r["query"].split("-")[1], r["failure"] is None) for r in ended) == [("bad", False), ("good", True)]
    reports = progress.read_progress(spark, str(tmp_path / "reports"))
    good = reports.filter("query LIKE 'land-good%' AND input_rows > 0").orderBy("batch_id").collect()
    assert [r["input_rows"] for r in good] == [5, 4] and all(r["trigger_ms"] > 0 and "logOffset" in r["end_offsets"] for r in good)
    assert progress.live_offsets(reports).count() == 0


def test_live_offsets_of_the_last_report(spark, rows):
    reports = [
        ("q", "r", 0, "2024-01-01T00:00:00.000Z", 5, 1, 0, None, '{"t":{"0":5,"1":2}}', '{"t":{"0":9,"1":2}}'),
        ("q", "r", 1, "2024-01-01T00:00:30.000Z", 2, 1, 0, '{"t":{"0":5,"1":2}}', '{"t":{"0":7,"1":2}}', '{"t":{"0":9,"1":4,"2":1}}'),
        ("p", "s", 0, "2024-01-01T00:00:00.000Z", 2, 1, 0, None, '{"u":{"0":3}}', None),
        ("f", "x", 0, "2024-01-01T00:00:00.000Z", 2, 1, 0, None, '{"logOffset":3}', None),
    ]
    df = spark.createDataFrame(reports, progress.PROGRESS)
    assert rows(progress.live_offsets(df)) == [("p", "u", 0, 3, 3, 0), ("q", "t", 0, 7, 9, 2), ("q", "t", 1, 2, 4, 2)]


def test_rollups_equal_the_full_computation_after_every_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FOLD_EVERY", 3)
    target = str(tmp_path / "out")
    assert landing.topic_rollup(spark, target).count() == 0
    for n in range(8):
        batch = records(spark, n * 5, n * 5 + 1 + n % 3, topic="a")
        if n % 2:
            batch = batch.unionByName(records(spark, n * 5, n * 5 + 2, topic="b", text="broken" if n == 3 else '{"id":%d,"v":%d}'))
        landing.land_batch(batch, n, target, V0)
        log = landing.read_part(spark, target, "log")
        got = {r["topic"]: r for r in landing.topic_rollup(spark, target).collect()}
        full = {r["topic"]: r for r in telemetry.throughput_ema(landing.flush_log(log)).collect()}
        sizes = {r["topic"]: r for r in telemetry.batch_sizes(log).collect()}
        counts = {r["topic"]: r["records"] for r in telemetry.consumed(log).collect()}
        assert got.keys() == full.keys() == sizes.keys()
        for topic, r in got.items():
            assert r["rate"]["z"] == pytest.approx(full[topic]["bytes_per_second"], rel=1e-9)
            assert (r["batches"], r["bytes"], r["largest_bytes"]) == tuple(sizes[topic])[1:4] and r["records"] == counts[topic] == r["accepted"] + r["rejected"]
            assert r["batches"] == full[topic]["flushes"]
    assert landing.committed(spark, target).folded_to == 5


def test_limits_of_the_next_run_follow_from_the_log(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    settings = TopicSettings(name="t", table="team.t", max_batch_bytes=10_000)
    assert progress.admitted(spark, target, settings, 4_000, active=2).max_batch_bytes == 2_000
    put(spark, source, 0, 50)
    put(spark, source, 50, 100)
    used = progress.land_admitted(
        spark, lambda s: read_topic_files(spark, source, max_bytes=s.max_batch_bytes), target, f"{target}-cp", lambda: V0, settings, 3_000,
        rounds=2, between=lambda n, _: put(spark, source, 100, 150) if n else None,
    )
    assert ids(spark, target) == list(range(150)) and landing.committed(spark, target).last == 2
    sizes = landing.read_part(spark, target, "log").agg(F.sum("bytes") / F.sum("records")).first()[0]
    assert used[0].max_batch_bytes == used[1].max_batch_bytes == 3_000 and used[1].average_record_bytes == pytest.approx(sizes, abs=3)
    assert SETTINGS.min_flush_seconds <= used[1].min_flush_seconds <= SETTINGS.max_flush_seconds
