"""Numbered commits, several writers of one table, transforms, folds and compaction."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from quayside.config import TopicSettings
from quayside.functions.json_schema import struct_type
from quayside.operators import register, telemetry, transform
from quayside.operators.evolve import SchemaConflict
from quayside.sources import commits
from quayside.sources.catalog import live_files
from quayside.sources.topics import read_topic_files
from quayside.streaming import landing
from tests.test_landing import SETTINGS, V0, V1, ids, put, records


def run(spark, source, target, checkpoint, schema=V0, settings=SETTINGS, **kw):
    stream = read_topic_files(spark, source, max_files=1)
    landing.land_stream(stream, target, checkpoint, lambda: schema, settings, **kw).awaitTermination()


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out")


def totals(spark, target):
    return tuple(landing.read_part(spark, target, "log").agg(*[F.sum(c) for c in ("records", "accepted", "rejected", "skipped")]).first())


# --- numbers ---


def test_each_number_is_taken_once(spark, tmp_path):
    path, taken = str(tmp_path / "t"), []

    def work(who):
        for n in range(6):
            taken.append((commits.commit(spark, path, lambda history: {"who": who, "n": n, "after": history.last}), who, n))

    threads = [threading.Thread(target=work, args=(w,)) for w in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _, _ in taken) == list(range(36))
    entries = commits.read_history(spark, path).tail
    assert [(e["number"], e["who"], e["n"]) for e in entries] == sorted(taken)
    assert all(e["after"] == e["number"] - 1 for e in entries)
    assert commits.commit(spark, path, lambda _: None) is None and commits.read_history(spark, path).last == 35


def test_a_file_is_created_once_where_names_cannot_be_linked(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.quay.link./t", f"file://{tmp_path}")
    path = "viewfs://quay/t/made/0.json"
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).mkdirs(spark._jvm.org.apache.hadoop.fs.Path("viewfs://quay/t/made"))
    assert commits.create_if_absent(spark, path, {"a": 1}) and not commits.create_if_absent(spark, path, {"a": 2})
    assert commits.read_json(spark, path) == {"a": 1}
    assert [n for n in os.listdir(tmp_path / "made") if n.endswith(".json")] == ["0.json"]


def test_three_thousand_commits_are_read_with_few_listings(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(3000):
        where = f"{path}/commits/segment={n // commits.SEGMENT}"
        os.makedirs(where, exist_ok=True)
        with open(f"{where}/{n}.json", "w") as f:
            f.write('{"writer": "w", "batch": %d, "schema_version": 0}' % n)
    commits.save_fold(spark, path, 2943, {"last_of": {"w": 2943}, "ranges": [[0, "w", 0, 2943]], "path": "p"})
    listed, read = [], []
    real_numbered, real_json = commits.numbered, commits.read_json
    monkeypatch.setattr(commits, "numbered", lambda *a: listed.append(a) or real_numbered(*a))
    monkeypatch.setattr(commits, "read_json", lambda *a: read.append(a) or real_json(*a))
    state = landing.committed(spark, path)
    assert state.last == 2999 and state.ranges == [[0, "w", 0, 2999]] and state.last_of == {"w": 2999}
    assert len(listed) <= 4 and len(read) == 57
    landing.committed(spark, path)
    # Entries never change: the second look reads the fold only.
    assert len(read) == 58


# --- writers ---


def test_a_second_checkpoint_lands_what_is_new(spark, paths):
    source, target = paths
    put(spark, source, 0, 3)
    run(spark, source, target, f"{target}-one")
    put(spark, source, 3, 8)
    run(spark, source, target, f"{target}-two")
    assert ids(spark, target) == list(range(8)) and totals(spark, target) == (8, 8, 0, 3)
    # The first one goes on where it was, and finds that it is done.
    run(spark, source, target, f"{target}-one")
    assert ids(spark, target) == list(range(8))


def test_a_lost_checkpoint_loses_and_repeats_nothing(spark, paths):
    source, target = paths
    for a in range(0, 12, 4):
        put(spark, source, a, a + 4, text='{"id":%d,"v":%d}' if a != 4 else "broken")
    run(spark, source, target, f"{target}-cp")
    os.rename(f"{target}-cp", f"{target}-lost")
    put(spark, source, 12, 15)
    run(spark, source, target, f"{target}-cp")
    assert ids(spark, target) == [0, 1, 2, 3, 8, 9, 10, 11, 12, 13, 14] and totals(spark, target) == (15, 11, 4, 12)
    assert landing.read_part(spark, target, "rejects").count() == 4
    continuity = landing.offset_continuity(landing.read_part(spark, target, "log"))
    assert continuity.filter("kind = 'overlap'").count() == 0


def test_offsets_that_begin_anew_are_new_records(spark, paths):
    source, target = paths
    put(spark, f"{source}-one", 0, 3)
    run(spark, f"{source}-one", target, f"{target}-one")
    put(spark, f"{source}-two", 0, 5, text='{"id":9%d,"v":%d}')
    run(spark, f"{source}-two", target, f"{target}-two")
    assert ids(spark, target) == [0, 1, 2, 90, 91, 92, 93, 94] and totals(spark, target) == (8, 8, 0, 0)
    overlaps = landing.offset_continuity(landing.read_part(spark, target, "log"))
    assert {r["kind"] for r in overlaps.collect()} == {"overlap"}


def test_two_topics_into_one_table_at_once(spark, tmp_path):
    target, jobs = str(tmp_path / "out"), []
    for k, topic in enumerate(("a", "b")):
        for part in range(2):
            put(spark, str(tmp_path / topic), 100 * k + 4 * part, 100 * k + 4 * part + 4, topic=topic)
        stream = read_topic_files(spark, str(tmp_path / topic), max_files=1)
        settings = TopicSettings(name=topic, table="team.t")
        jobs.append(landing.LandingJob(settings, stream, lambda k=k: (V0, V1)[k], target, f"{target}-{topic}"))
    got = sorted(tuple(r) for r in landing.land_topics(spark, jobs).collect())
    # One schema may have come first; the other is no safe change of it.
    assert [r[1] for r in got].count("finished") >= 1
    if all(r[1] == "finished" for r in got):
        assert ids(spark, target) == [*range(8), *range(100, 108)]
    manifest = landing.read_part(spark, target, "manifest")
    assert manifest.select("snapshot_id").distinct().count() == landing.committed(spark, target).last + 1


def test_two_topics_with_one_schema_into_one_table_at_once(spark, tmp_path):
    target, jobs = str(tmp_path / "out"), []
    for k, topic in enumerate(("a", "b")):
        for part in range(2):
            put(spark, str(tmp_path / topic), 100 * k + 4 * part, 100 * k + 4 * part + 4, topic=topic)
        stream = read_topic_files(spark, str(tmp_path / topic), max_files=1)
        jobs.append(landing.LandingJob(TopicSettings(name=topic, table="team.t"), stream, lambda: V0, target, f"{target}-{topic}"))
    assert {r["outcome"] for r in landing.land_topics(spark, jobs).collect()} == {"finished"}
    assert ids(spark, target) == [*range(8), *range(100, 108)] and totals(spark, target) == (16, 16, 0, 0)
    log = landing.read_part(spark, target, "log")
    assert {r["topic"]: r["flushes"] for r in telemetry.flushes(log).collect()} == {"a": 2, "b": 2}
    assert log.select("landed_by").distinct().count() == 2


# --- folds and compaction ---


def test_folds_change_nothing(spark, paths, monkeypatch, rows):
    _, target = paths
    other = f"{target}-plain"
    for n in range(7):
        shape, text = (V0, '{"id":%d,"v":%d}') if n < 4 else (V1, '{"id":%d,"v":%d,"extra":"e"}')
        batch = records(spark, n * 3, n * 3 + 3, text=text if n != 5 else "broken")
        for path, every in ((target, 2), (other, 100)):
            monkeypatch.setattr(landing, "FOLD_EVERY", every)
            landing.land_batch(batch, n, path, shape, table_name="t")
    state = landing.committed(spark, target)
    assert state.folded_to == 5 and len(state.tail) == 1 and state.ranges == landing.committed(spark, other).ranges
    assert ids(spark, target) == ids(spark, other) and totals(spark, target) == totals(spark, other) == (21, 18, 3, 0)
    for kind, names in (("log", ("topic", "partition", "start_offset", "batch_id")), ("manifest", ("snapshot_id", "end_snapshot", "record_count")), ("rejects", ("original_offset", landing.BATCH))):
        assert rows(landing.read_part(spark, target, kind), *names) == rows(landing.read_part(spark, other, kind), *names)
    # A batch that comes again is known from the fold.
    landing.land_batch(records(spark, 0, 9), 0, target, V1)
    assert landing.committed(spark, target).last == 6
    listed = landing.read_part(spark, target, "manifest").filter("snapshot_id IN (0, 6)")
    assert sorted(r["id"] for r in landing.read_registered(spark, target, listed).collect()) == [0, 1, 2, 18, 19, 20]


def test_compaction_is_one_change_of_the_catalog(spark, paths, monkeypatch):
    _, target = paths
    for n in range(5):
        landing.land_batch(records(spark, n * 4, n * 4 + 4).repartition(3), n, target, V0 if n < 3 else V1, table_name="t")
    before = landing.read_part(spark, target, "manifest").collect()
    seen, real = [], landing._commit

    def slow(*args):
        # The new files are written and not committed yet.
        seen.append(ids(spark, target))
        number = real(*args)
        seen.append(ids(spark, target))
        return number

    monkeypatch.setattr(landing, "_commit", slow)
    assert landing.compact_table(spark, target) == [5, 6]
    assert seen == [list(range(20))] * 4 and ids(spark, target) == list(range(20))
    manifest = landing.read_part(spark, target, "manifest")
    assert {r["path"]: r["end_snapshot"] for r in manifest.filter("snapshot_id < 5").collect()} == {r["path"]: 5 if r["snapshot_id"] < 3 else 6 for r in before}
    live = live_files(manifest, manifest.select("table_id", "table_name").distinct())
    assert live.count() == 2 and live.agg(F.sum("record_count")).first()[0] == 20
    assert sorted(r["id"] for r in landing.read_registered(spark, target, live).collect()) == list(range(20))
    assert totals(spark, target) == (20, 20, 0, 0)
    # What is large enough stays; what has landed since is put together with it only if both are small.
    assert landing.compact_table(spark, target, target_bytes=10) == []
    landing.land_batch(records(spark, 20, 24), 5, target, V1, table_name="t")
    monkeypatch.setattr(landing, "FOLD_EVERY", 1)
    assert landing.compact_table(spark, target) == [8]
    assert ids(spark, target) == list(range(24)) and landing.committed(spark, target).folded_to == 8
    assert landing.read_part(spark, target, "manifest").filter("end_snapshot IS NULL").count() == 2
    landing.land_batch(records(spark, 24, 25), 6, target, V1)
    assert ids(spark, target) == list(range(25))


def test_of_two_compactions_one_is_refused(spark, paths, monkeypatch):
    _, target = paths
    for n in range(3):
        landing.land_batch(records(spark, n * 4, n * 4 + 4), n, target, V0)
    real = landing.compact

    def meanwhile(rows, path, size):
        monkeypatch.setattr(landing, "compact", real)
        landing.compact_table(spark, target)
        real(rows, path, size)

    monkeypatch.setattr(landing, "compact", meanwhile)
    with pytest.raises(commits.CommitConflict):
        landing.compact_table(spark, target)
    assert ids(spark, target) == list(range(12)) and landing.committed(spark, target).last == 3


# --- transforms ---


def test_records_on_which_a_transform_fails_become_dead_letters(spark, paths):
    source, target = paths
    put(spark, source, 0, 40, text='{"id":%d,"v":%d,"gone":"7"}')
    put(spark, source, 40, 43, text='{"id":%d,"v":%d,"gone":"seven"}')
    put(spark, source, 43, 44, text='{"id":%d,"v":0,"gone":"7"}'.replace("%d", "%d%.0s"))
    put(spark, source, 44, 46, text="broken")
    put(spark, source, 46, 48, text='{"id":%d,"v":%d}')
    sql = "SELECT id, v * 2 AS v, CAST(CAST(gone AS INT) + 100 DIV v AS STRING) AS gone FROM input WHERE id <> 0"
    stream = read_topic_files(spark, source)
    landing.land_stream(stream, target, f"{target}-cp", lambda: V0, SETTINGS, transform=sql).awaitTermination()
    got = {r["id"]: (r["v"], r["gone"]) for r in landing.read_table(spark, target).collect()}
    assert got == {i: (2 * i, str(7 + 100 // i)) for i in range(1, 40)} | {46: (92, None), 47: (94, None)}
    letters = {r["original_offset"]: r for r in landing.read_part(spark, target, "rejects").collect()}
    assert {k: r["failure_stage"] for k, r in letters.items()} == {
        **dict.fromkeys((40, 41, 42, 43), "TRANSFORMATION"), **dict.fromkeys((44, 45), "DESERIALIZATION")
    }
    assert letters[40]["failure_reason"] == "$:transform CAST_INVALID_INPUT" and "seven" in letters[40]["failure_stack_trace"]
    assert letters[43]["failure_reason"] == "$:transform DIVIDE_BY_ZERO" and letters[44]["failure_stack_trace"] is None
    assert totals(spark, target) == (48, 42, 6, 0)


@pytest.mark.parametrize("sql, policy, why", [
    ("SELECT nothing FROM input", "quarantine", "UNRESOLVED_COLUMN"),
    ("SELECT id FROM input", "quarantine", "are declared"),
    ("SELECT id, v, CAST(CAST(gone AS INT) AS STRING) AS gone FROM input", "stop", "CAST_INVALID_INPUT"),
    ("SELECT id, v, CAST(CAST(gone AS INT) AS STRING) AS gone FROM input", "quarantine", "over 3 records fail"),
])
def test_a_transform_that_is_wrong_stops_the_topic(spark, paths, monkeypatch, sql, policy, why):
    monkeypatch.setattr(transform, "MOST_FAILURES", 3)
    source, target = paths
    put(spark, source, 0, 4)
    job = landing.LandingJob(SETTINGS, read_topic_files(spark, source), lambda: V0, target, f"{target}-cp", policy, transform=sql)
    (row,) = landing.land_topics(spark, [job]).collect()
    assert row["outcome"] == "stopped" and row["reason"].startswith("transform_failed: ") and why in row["reason"]
    assert landing.read_stops(spark, target).first()["reason"] == row["reason"] and landing.committed(spark, target).last == -1


# --- columns by id ---


def test_a_renamed_column_reads_its_old_files(spark, paths):
    import pyarrow.parquet as pq

    _, target = paths
    landing.land_batch(records(spark, 0, 3), 0, target, V0, table_name="t")
    assert landing.rename_column(spark, target, "v", "amount") == 1
    renamed = struct_type([("id", "BIGINT", False), ("amount", "DOUBLE", True), ("extra", "VARCHAR", False)])
    landing.land_batch(records(spark, 3, 5, text='{"id":%d,"amount":%d.5,"extra":"e"}'), 1, target, renamed, table_name="t")
    want = {i: (float(i), "g", None) for i in range(3)} | {i: (i + 0.5, None, "e") for i in (3, 4)}
    manifest = landing.read_part(spark, target, "manifest")
    for rows in (landing.read_table(spark, target), landing.read_registered(spark, target, manifest)):
        assert rows.columns == ["id", "amount", "gone", "extra"]
        assert {r["id"]: (r["amount"], r["gone"], r["extra"]) for r in rows.collect()} == want
    names = {}
    for r in manifest.collect():
        file = pq.ParquetFile(r["path"].removeprefix("file://"))
        for f in file.schema_arrow:
            names.setdefault(int(f.metadata[b"PARQUET:field_id"]), set()).add(f.name)
    assert names == {1: {"id"}, 2: {"v", "amount"}, 3: {"gone"}, 4: {"extra"}}
    # The files of an old version stay those of that version when they are put together.
    landing.land_batch(records(spark, 5, 6, text='{"id":%d,"amount":%d.5,"extra":"e"}'), 2, target, renamed, table_name="t")
    landing.compact_table(spark, target)
    assert {r["id"]: r["amount"] for r in landing.read_table(spark, target).collect()} == {k: v[0] for k, v in want.items()} | {5: 5.5}
    for old, new in (("none", "x"), ("id", "Extra"), ("id", "landed_batch")):
        with pytest.raises(SchemaConflict):
            landing.rename_column(spark, target, old, new)


def test_targets_are_stored_in_versions(spark, tmp_path, rows):
    path = str(tmp_path / "targets")
    shape = "t string, pos int, name string, type string, nullable boolean"
    first = spark.createDataFrame([("x", 0, "id", "BIGINT", False), ("x", 1, "v", "BIGINT", True), ("y", 0, "id", "BIGINT", False)], shape)
    assert register.store_targets(first, ["t"], path) == 0 and register.store_targets(first, ["t"], path) is None
    then = spark.createDataFrame([("x", 0, "w", "VARCHAR", True), ("x", 1, "v", "DOUBLE", True), ("y", 0, "id", "VARCHAR", False), ("z", 0, "a", "BIGINT", True)], shape)
    assert register.sync_targets(then, ["t"], path) == 1 and register.sync_targets(then, ["t"], path) is None
    assert register.store_targets(then, ["t"], path) == 2
    got = {r["t"]: (r["version"], [tuple(f) for f in r["fields"]]) for r in register.read_targets(spark, path).collect()}
    assert got == {
        "x": (1, [(1, "id", "BIGINT", True), (2, "v", "DOUBLE", False), (3, "w", "VARCHAR", False)]),
        "y": (0, [(1, "id", "BIGINT", True)]),
        "z": (2, [(1, "a", "BIGINT", False)]),
    }
    mapping = {r["t"]: r["name_mapping"] for r in register.described_targets(register.read_targets(spark, path), ["t"]).collect()}
    assert mapping["x"] == '[{"field-id":1,"names":["id"]},{"field-id":2,"names":["v"]},{"field-id":3,"names":["w"]}]'
