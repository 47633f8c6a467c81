import pytest
from pyspark.sql import functions as F

from quayside.config import TopicSettings
from quayside.functions.json_schema import struct_type
from quayside.operators.evolve import SchemaConflict
from quayside.operators.telemetry import throughput_ema
from quayside.operators.validate import InvalidRecords, accepted, conform, validate
from quayside.sources.catalog import live_files
from quayside.sources.topics import TOPIC_SCHEMA, decode_json, flush_trigger, header_map, kafka_limits, read_topic, read_topic_files
from quayside.streaming import landing

V0 = struct_type([("id", "BIGINT", False), ("v", "BIGINT", True), ("gone", "VARCHAR", True)])
V1 = struct_type([("id", "BIGINT", False), ("v", "DOUBLE", True), ("extra", "VARCHAR", False)])
SETTINGS = TopicSettings(name="t", table="team.t")


def records(spark, start, stop, text='{"id":%d,"v":%d,"gone":"g","extra":"e"}', topic="t"):
    rows = [(topic, i % 2, i, None, text % (i, i) if "%" in text else text) for i in range(start, stop)]
    return spark.createDataFrame(rows, TOPIC_SCHEMA)


def put(spark, path, *span, **kw):
    records(spark, *span, **kw).coalesce(1).write.mode("append").json(path)


def run(spark, source, target, schema=V0, on_invalid="quarantine"):
    stream = read_topic_files(spark, source, max_files=1)
    landing.land_stream(stream, target, f"{target}-cp", lambda: schema, SETTINGS, on_invalid=on_invalid).awaitTermination()


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out")


def ids(spark, target):
    return sorted(r["id"] for r in landing.read_table(spark, target).select("id").collect())


def test_stream_equals_batch_and_resumes(spark, paths):
    source, target = paths
    put(spark, source, 0, 10)
    put(spark, source, 10, 20, text="broken")
    put(spark, source, 20, 30)
    run(spark, source, target)
    run(spark, source, target)
    put(spark, source, 30, 35)
    run(spark, source, target)
    everything = spark.read.schema(TOPIC_SCHEMA).json(source)
    batch = conform(accepted(validate(decode_json(everything), V0)), V0)
    assert sorted(map(tuple, landing.read_table(spark, target).collect())) == sorted(map(tuple, batch.collect()))
    log = landing.read_part(spark, target, "log")
    assert tuple(log.agg(F.sum("records"), F.sum("accepted"), F.sum("rejected")).first()) == (35, 25, 10)
    assert landing.read_part(spark, target, "rejects").count() == 10
    assert landing.read_part(spark, target, "manifest").agg(F.sum("record_count")).first()[0] == 25


def test_crash_between_data_and_commit_lands_once(spark, paths, monkeypatch):
    source, target = paths
    put(spark, source, 0, 10)
    run(spark, source, target)
    put(spark, source, 10, 20)
    real = landing.file_rows

    def crash(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(landing, "file_rows", crash)
    with pytest.raises(Exception, match="lost"):
        run(spark, source, target)
    # The data of the second batch is there, but it is not committed.
    assert ids(spark, target) == list(range(10))
    monkeypatch.setattr(landing, "file_rows", real)
    # The schema has moved on when the batch is tried again.
    run(spark, source, target, schema=V1)
    run(spark, source, target, schema=V1)
    assert ids(spark, target) == list(range(20))
    assert [v for _, v in sorted((r["id"], r["v"]) for r in landing.read_table(spark, target).collect())] == [float(i) for i in range(20)]


def test_schema_evolves_before_a_flush(spark, paths):
    _, target = paths
    landing.land_batch(records(spark, 0, 3), 0, target, V0)
    landing.land_batch(records(spark, 3, 5), 1, target, V1)
    landing.land_batch(records(spark, 5, 6), 2, target, V1)
    version, schema = landing.current_schema(spark, target)
    assert version == 1
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields] == [
        ("id", "bigint", False),
        ("v", "double", True),
        ("gone", "string", True),
        ("extra", "string", True),
    ]
    got = {r["id"]: (r["v"], r["gone"], r["extra"]) for r in landing.read_table(spark, target).collect()}
    assert got[0] == (0.0, "g", None) and got[4] == (4.0, None, "e") and len(got) == 6


def test_conflicting_schema_stops_the_topic(spark, paths):
    _, target = paths
    landing.land_batch(records(spark, 0, 3), 0, target, V0)
    with pytest.raises(SchemaConflict):
        landing.land_batch(records(spark, 3, 5), 1, target, struct_type([("v", "VARCHAR", True)]))
    assert ids(spark, target) == [0, 1, 2]
    stop = landing.read_stops(spark, target).first()
    assert stop["batch_id"] == 1 and stop["reason"].startswith("schema_evolution_failed")


def test_stop_policy(spark, paths):
    source, target = paths
    put(spark, source, 0, 4)
    run(spark, source, target, on_invalid="stop")
    put(spark, source, 4, 5, text='{"v":1}')
    with pytest.raises(Exception, match=InvalidRecords.__name__):
        run(spark, source, target, on_invalid="stop")
    assert ids(spark, target) == [0, 1, 2, 3]
    assert landing.read_stops(spark, target).first()["reason"] == "invalid_records: id missing"


def test_batch_without_accepted_rows_is_committed(spark, paths):
    _, target = paths
    landing.land_batch(records(spark, 0, 3, text="broken"), 0, target, V0)
    assert ids(spark, target) == []
    assert landing.read_part(spark, target, "rejects").count() == 3
    assert landing.read_part(spark, target, "log").agg(F.sum("rejected")).first()[0] == 3


def test_topics_fail_alone(spark, tmp_path):
    jobs = []
    for topic, text in [("good", '{"id":%d,"v":%d}'), ("bad", "broken")]:
        source = str(tmp_path / topic)
        put(spark, source, 0, 5, text=text, topic=topic)
        target = str(tmp_path / f"{topic}-out")
        settings = TopicSettings(name=topic, table=f"team.{topic}")
        stream = read_topic_files(spark, source)
        jobs.append(landing.LandingJob(settings, stream, lambda: V0, target, f"{target}-cp", "stop"))
    got = {r["topic"]: (r["outcome"], r["reason"]) for r in landing.land_topics(spark, jobs).collect()}
    assert got == {"good": ("finished", None), "bad": ("stopped", "invalid_records: $ not_json")}
    assert ids(spark, jobs[0].target) == list(range(5))


def test_registered_rows_only(spark, paths):
    _, target = paths
    for n in range(3):
        landing.land_batch(records(spark, n * 4, n * 4 + 4), n, target, V0 if n < 2 else V1)
    listed = landing.read_part(spark, target, "manifest").filter(f"{landing.BATCH} <> 1")
    assert sorted(r["id"] for r in landing.read_registered(spark, target, listed).collect()) == [0, 1, 2, 3, 8, 9, 10, 11]


def test_triggers_and_reader_limits():
    assert flush_trigger(SETTINGS, bounded=True) == {"availableNow": True}
    assert flush_trigger(SETTINGS, bounded=False) == {"processingTime": "30 seconds"}
    assert kafka_limits(SETTINGS) == {"maxOffsetsPerTrigger": "65536", "minOffsetsPerTrigger": "32768", "maxTriggerDelay": "300s"}


def test_kafka_reader_names_what_is_missing(spark):
    with pytest.raises(RuntimeError, match="Kafka connector"):
        read_topic(spark, SETTINGS, "broker:9092")


def test_committed_batch_is_left_as_it_is(spark, paths, monkeypatch):
    _, target = paths
    landing.land_batch(records(spark, 0, 3), 0, target, V0)

    def fail(*_):
        raise AssertionError("a committed batch was landed again")

    monkeypatch.setattr(landing, "accepted", fail)
    landing.land_batch(records(spark, 0, 3), 0, target, V0)
    assert ids(spark, target) == [0, 1, 2]


def test_names_that_no_reader_could_tell_apart(spark, paths):
    _, target = paths
    landing.land_batch(records(spark, 0, 3), 0, target, V0)
    with pytest.raises(SchemaConflict, match="case only"):
        landing.land_batch(records(spark, 3, 5), 1, target, struct_type([("ID", "BIGINT", False)]))
    with pytest.raises(SchemaConflict, match="reserved"):
        landing.land_batch(records(spark, 3, 5), 1, target, struct_type([("landed_batch", "BIGINT", True)]))
    assert ids(spark, target) == [0, 1, 2]


def test_schema_folder_without_files_is_no_table(spark, paths):
    import os

    _, target = paths
    os.makedirs(f"{target}/schemas")
    assert landing.current_schema(spark, target) is None
    landing.land_batch(records(spark, 0, 3), 0, target, V0)
    assert ids(spark, target) == [0, 1, 2]


def test_a_stop_is_kept_once_and_tells_of_its_own_run(spark, paths):
    source, target = paths
    put(spark, source, 0, 1, text='{"v":1}')
    stream = read_topic_files(spark, source)
    job = landing.LandingJob(SETTINGS, stream, lambda: V0, target, f"{target}-cp", "stop")
    for _ in range(2):
        assert landing.land_topics(spark, [job]).first()["reason"] == "invalid_records: id missing"
    assert landing.read_stops(spark, target).count() == 1

    def down():
        raise OSError("registry down")

    lost = landing.LandingJob(SETTINGS, stream, down, target, f"{target}-cp", "stop")
    assert "registry down" in landing.land_topics(spark, [lost]).first()["reason"]


def test_a_topic_that_cannot_start_leaves_the_others(spark, paths):
    source, target = paths
    put(spark, source, 0, 5)
    good = landing.LandingJob(SETTINGS, read_topic_files(spark, source), lambda: V0, target, f"{target}-checkpoint")
    twice = landing.LandingJob(SETTINGS, read_topic_files(spark, source), lambda: V0, f"{target}2", f"{target}2-checkpoint")
    # A table that is no stream cannot be started.
    bad = landing.LandingJob(TopicSettings(name="bad", table="bad"), records(spark, 0, 1), lambda: V0, f"{target}3", f"{target}3-checkpoint")
    got = sorted((r["topic"], r["outcome"]) for r in landing.land_topics(spark, [bad, good, twice]).collect())
    assert got == [("bad", "not_started"), ("t", "finished"), ("t", "finished")]
    assert ids(spark, target) == ids(spark, f"{target}2") == list(range(5))


def test_catalog_rows_and_log_of_what_was_landed(spark, paths, rows):
    _, target = paths
    for n in range(3):
        landing.land_batch(records(spark, n * 4, n * 4 + 4), n, target, V0, table_name="team__t")
    manifest = landing.read_part(spark, target, "manifest")
    live = live_files(manifest, manifest.select("table_id", "table_name").distinct())
    assert rows(live.groupBy("table_name", "snapshot_id").agg(F.sum("record_count")), "*") == [("team__t", n, 4) for n in range(3)]
    log = landing.flush_log(landing.read_part(spark, target, "log"))
    assert rows(log, "topic", "seq") == [("t", n) for n in range(3)]
    assert log.filter("elapsed_seconds > 0 AND bytes > 0").count() == 3
    assert throughput_ema(log).first()["flushes"] == 3


def test_registered_rows_of_a_batch_in_part(spark, paths):
    """Of one batch only some files are registered: its rows are told apart by file, the others by batch."""
    _, target = paths
    for n in range(3):
        landing.land_batch(records(spark, n * 8, n * 8 + 8).repartition(4, "offset"), n, target, V0 if n < 2 else V1)
    manifest = landing.read_part(spark, target, "manifest")
    assert manifest.filter("snapshot_id = 1").count() > 1
    one = manifest.filter("snapshot_id = 1").orderBy("path").limit(1)
    listed = manifest.filter("snapshot_id <> 1").unionByName(one)
    got = sorted(r["id"] for r in landing.read_registered(spark, target, listed).collect())
    part = sorted(r["id"] for r in spark.read.parquet(one.first()["path"]).collect())
    assert part and got == sorted([*range(8), *part, *range(16, 24)])
    assert landing.read_registered(spark, target, manifest.filter("false")).count() == 0


def test_dead_letters_keep_key_and_headers(spark, paths):
    _, target = paths
    keyed = records(spark, 0, 2, text="broken").withColumns({"key": F.lit("k"), "headers": F.create_map(F.lit("a"), F.lit("b"))})
    landing.land_batch(keyed, 0, target, V0)
    letters = landing.read_part(spark, target, "rejects")
    names = "original_topic original_partition original_offset original_key original_payload original_headers failure_stage"
    names += " failure_reason failure_stack_trace failure_time schema_id schema_version pipeline_name team_name"
    assert [c for c in letters.columns if c != landing.BATCH] == names.split()
    assert {(r["original_key"], r["original_headers"]["a"]) for r in letters.collect()} == {("k", "b")}


def test_of_equal_headers_the_last_counts(spark):
    shape = "headers array<struct<key:string,value:binary>>"
    df = spark.createDataFrame([([("a", b"1"), ("b", b"2"), ("a", b"3")],), ([],), (None,)], shape)
    assert [r[0] for r in df.select(header_map(F.col("headers"))).collect()] == [{"b": "2", "a": "3"}, {}, None]
