import random
import threading

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from quayside.operators import compact, evolve, export, lag, register, telemetry
from quayside.operators.evolve import SchemaConflict
from quayside.operators.transform import fresh_view, transform_batch
from quayside.sources import catalog, registry

FILES = "table_id bigint, table_name string, path string, path_is_relative boolean, record_count bigint, file_size_bytes bigint, snapshot_id bigint, end_snapshot bigint"


@pytest.fixture
def lake(spark):
    files = spark.createDataFrame(
        [
            (1, "a", "old.parquet", True, 5, 50, 1, None),
            (2, "a", "one.parquet", True, 10, 100, 2, None),
            (2, "a", "s3://x/two.parquet", False, 20, 200, 3, None),
            (2, "a", "dead.parquet", True, 40, 400, 2, 3),
            (3, "b", "one.parquet", True, 7, 70, 3, None),
            (4, "c", "dead.parquet", True, 9, 90, 1, 2),
        ],
        FILES,
    )
    return files, files.select("table_id", "table_name").distinct()


def live(lake):
    return catalog.live_files(*lake, F.concat(F.lit("s3://r/"), "table_name", F.lit("/")))


def test_live_files_of_newest_incarnation(lake, rows):
    assert rows(live(lake), "table_name", "path") == [
        ("a", "s3://r/a/one.parquet"),
        ("a", "s3://x/two.parquet"),
        ("b", "s3://r/b/one.parquet"),
    ]
    assert rows(catalog.file_totals(live(lake), lake[1])) == [("a", 2, 30, 300), ("b", 1, 7, 70), ("c", 0, 0, 0)]
    assert rows(catalog.empty_tables(live(lake), lake[1])) == [("c",)]


def test_registration_is_idempotent(spark, lake, rows, tmp_path):
    known = spark.createDataFrame(
        [("a", "s3://r/a/one.parquet", 10, 100), ("a", "s3://r/a/dead.parquet", 40, 400)],
        "table_name string, path string, record_count bigint, file_size_bytes bigint",
    )
    assert rows(register.new_files(live(lake), known), "table_name", "path") == [("a", "s3://x/two.parquet"), ("b", "s3://r/b/one.parquet")]
    assert rows(register.stale_registrations(live(lake), known), "path") == [("s3://r/a/dead.parquet",)]
    assert rows(register.registration_report(live(lake), known)) == [("a", 1, 20, 1), ("b", 1, 7, 0)]
    path = str(tmp_path / "registered")
    known.write.parquet(path)
    for _ in range(3):
        register.register(live(lake), spark.read.parquet(path), path)
    after = spark.read.parquet(path)
    assert after.count() == 4 and register.new_files(live(lake), after).count() == 0


def test_empty_catalog(spark):
    files = spark.createDataFrame([], FILES)
    assert catalog.latest_snapshot(spark.createDataFrame([], "snapshot_id bigint")).first()[0] == 0
    assert catalog.file_count(files).first()[0] == 0
    assert catalog.live_files(files, files.select("table_id", "table_name")).count() == 0


def test_absent_table_is_told_from_a_broken_one(spark, tmp_path):
    assert catalog.describe(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        catalog.describe(spark, str(tmp_path / "bad"))
    spark.range(3).write.parquet(str(tmp_path / "good"))
    stored = catalog.describe(spark, str(tmp_path / "good"))
    assert catalog.describe_columns(spark, "t", stored).first()["type"] == "BIGINT"


def test_target_presence(spark, lake, rows):
    assert rows(catalog.target_presence(lake[1], spark.createDataFrame([("a",)], "table_name string"))) == [
        ("a", "load"), ("b", "create"), ("c", "create"),
    ]


COLS = "t string, name string, type string"


def test_schema_diff(spark, rows):
    now = spark.createDataFrame([("x", "k", "BIGINT"), ("x", "w", "BIGINT"), ("x", "r", "VARCHAR"), ("y", "k", "DOUBLE")], COLS)
    want = spark.createDataFrame([("x", "k", "BIGINT"), ("x", "w", "DOUBLE"), ("x", "n", "BOOLEAN"), ("y", "k", "BIGINT"), ("x", "K", "BIGINT")], COLS)
    diff = evolve.schema_diff(now, want, ["t"])
    assert rows(diff, "t", "name", "change") == [
        ("x", "K", "conflict"), ("x", "n", "added"), ("x", "r", "removed"), ("x", "w", "widened"), ("y", "k", "conflict"),
    ]
    assert rows(evolve.conflicts(diff, ["t"])) == [("x", 1, "conflict K BIGINT"), ("y", 1, "conflict k DOUBLE->BIGINT")]
    assert rows(evolve.column_drift(now, want, ["t"])) == [("x", "K", "case"), ("x", "n", "gone"), ("x", "r", "new")]


def test_synced_fields_keep_their_ids(spark, rows):
    stored = spark.createDataFrame(
        [("x", 1, "a", "BIGINT", True), ("x", 5, "b", "VARCHAR", False), ("y", 1, "a", "BOOLEAN", True)],
        "t string, field_id int, name string, type string, required boolean",
    )
    declared = spark.createDataFrame(
        [("x", 0, "z", "VARCHAR", True), ("x", 1, "a", "DOUBLE", False), ("x", 2, "c", "BIGINT", False), ("y", 0, "a", "BIGINT", False), ("w", 0, "a", "BIGINT", False)],
        "t string, pos int, name string, type string, nullable boolean",
    )
    # y has a conflict and stays, w is not registered yet.
    assert rows(evolve.sync_fields(stored, declared, ["t"])) == [
        ("x", 1, "a", "DOUBLE", True), ("x", 5, "b", "VARCHAR", False), ("x", 6, "z", "VARCHAR", False), ("x", 7, "c", "BIGINT", True),
        ("y", 1, "a", "BOOLEAN", True),
    ]


def test_names_that_differ_in_case_only_are_refused_everywhere(spark, rows):
    now = spark.createDataFrame([("x", "userId", "BIGINT"), ("y", "a", "BIGINT")], COLS)
    want = spark.createDataFrame([("x", "userid", "BIGINT"), ("y", "a", "BIGINT"), ("y", "b", "BIGINT")], COLS)
    diff = evolve.schema_diff(now, want, ["t"])
    assert rows(diff, "t", "name", "change") == [("x", "userId", "removed"), ("x", "userid", "conflict"), ("y", "b", "added")]
    assert rows(evolve.column_drift(now, want, ["t"])) == [("x", "userId", "case"), ("x", "userid", "case"), ("y", "b", "gone")]
    stored = spark.createDataFrame([("x", 1, "userId", "BIGINT", True), ("y", 1, "a", "BIGINT", True)], "t string, field_id int, name string, type string, required boolean")
    declared = want.selectExpr("t", "0 AS pos", "name", "type", "true AS nullable")
    assert rows(evolve.sync_fields(stored, declared, ["t"]), "t", "field_id", "name") == [("x", 1, "userId"), ("y", 1, "a"), ("y", 2, "b")]


@pytest.mark.parametrize(
    "own, fallback, mode",
    [("BACKWARD", "FULL", "BACKWARD"), ("FULL", "BACKWARD", "FULL"), (None, "BACKWARD", "BACKWARD"), (None, None, "NONE"), ("", "BACKWARD", "NONE")],
)
def test_effective_mode(spark, own, fallback, mode):
    rules = [("g", "a", own or None)] if own is not None else []
    rules += [(None, None, fallback)] if fallback else []
    shape = "group_id string, artifact_id string, mode string"
    artifacts = spark.createDataFrame([("g", "a", 1, "{}")], "group_id string, artifact_id string, version int, schema_json string")
    assert registry.effective_mode(artifacts, spark.createDataFrame(rules, shape)).first()["mode"] == mode


def test_export_thresholds(spark, rows):
    files = spark.createDataFrame(
        [("big", "p1", 2, 1, 128), ("small", "p2", 2, 1, 127), ("old", "p3", 1, 1, 1), ("done", "p4", 2, 1, 999), ("off", "p5", 2, 1, 999), ("blocked", "p6", 2, 1, 999)],
        "table_name string, path string, snapshot_id bigint, record_count bigint, file_size_bytes bigint",
    )
    snapshots = spark.sql("SELECT 1L AS snapshot_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS commit_time UNION ALL SELECT 2L, TIMESTAMP_NTZ '2024-01-01 00:00:01'")
    state = spark.createDataFrame(
        [("done", 2, None, True, False, None), ("off", None, None, False, False, None), ("blocked", None, None, True, True, "why")],
        "table_name string, last_exported_snapshot bigint, last_export_time timestamp_ntz, export_enabled boolean, export_blocked boolean, export_blocked_reason string",
    )
    now = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    due = export.export_candidates(files, snapshots, state, now, min_bytes=128, max_age_minutes=60)
    assert rows(due, "table_name", "accumulated_bytes") == [("big", 128), ("old", 1)]
    assert rows(export.files_since(files, due), "path") == [("p1",), ("p3",)]
    after = export.record_export(state, due, now)
    assert rows(after, "table_name", "last_exported_snapshot") == [("big", 2), ("blocked", None), ("done", 2), ("off", None), ("old", 1)]
    assert rows(export.expirable_files(files, after), "path") == [("p1",), ("p3",), ("p4",)]
    blocked = export.block_exports(after, spark.createDataFrame([("big", "conflict")], "table_name string, reason string"))
    assert rows(blocked.filter("export_blocked"), "table_name", "export_blocked_reason") == [("big", "conflict"), ("blocked", "why")]


def test_compaction(spark, tmp_path, rows):
    source = str(tmp_path / "many")
    spark.range(0, 1000, numPartitions=40).withColumn("day", F.col("id") % 3).write.parquet(source)
    compact.compact(spark.read.parquet(source), str(tmp_path / "few"))
    files = compact.file_rows(spark, str(tmp_path / "few"))
    assert files.count() < 40 and files.agg(F.sum("record_count")).first()[0] == 1000
    compact.compact(spark.read.parquet(source), str(tmp_path / "days"), partition_by="day")
    assert compact.file_rows(spark, str(tmp_path / "days")).count() == 3
    assert spark.read.parquet(str(tmp_path / "days")).count() == 1000


def test_compaction_by_a_column_sorts_no_rows(spark, tmp_path, monkeypatch, rows):
    seen, write = [], DataFrameWriter.parquet

    def spy(self, path):
        seen.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        write(self, path)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    made = spark.range(0, 1000, numPartitions=4).withColumn("day", F.when(F.col("id") % 3 > 0, F.col("id") % 90))
    compact.compact(made, str(tmp_path / "days"), partition_by="day")
    assert seen[0] > 1
    assert rows(spark.read.parquet(str(tmp_path / "days")), "id", "day") == rows(made, "id", "day")


def test_compaction_meets_its_size(spark, tmp_path):
    source, out = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(0, 2_400_000, numPartitions=60).select(F.rand(5).alias("v")).write.parquet(source)
    total = compact.file_rows(spark, source).agg(F.sum("file_size_bytes")).first()[0]
    compact.compact(spark.read.parquet(source), out, target_bytes=total * 3 // 8)
    sizes = [r["file_size_bytes"] for r in compact.file_rows(spark, out).collect()]
    assert len(sizes) == 3 and max(sizes) < total * 3.3 / 8


def test_versions_are_united(spark, rows):
    old = spark.createDataFrame([(1, 5)], "k bigint, v bigint")
    new = spark.createDataFrame([(2, 1.5, "x")], "k bigint, v double, e string")
    assert rows(compact.union_versions([old, new], new.schema)) == [(1, 5.0, None), (2, 1.5, "x")]
    big = spark.createDataFrame([(2**53,), (2**53 + 1,), (2**63 - 1,), (7,)], "v bigint")
    assert rows(compact.lossy_widenings(big, "v")) == [(2**53 + 1,), (2**63 - 1,)]


def test_lag_edges(spark, rows):
    starts = spark.createDataFrame([("t", 0, 10), ("t", 1, 10), ("t", 2, 10), ("t", 3, 10), ("t", 4, 10)], "topic string, partition int, start_offset bigint")
    ends = spark.createDataFrame([("t", 0, 20), ("t", 1, 20), ("t", 2, 10), ("t", 3, 20)], "topic string, partition int, end_offset bigint")
    seen = spark.createDataFrame([("t", 0, 15), ("t", 1, 16), ("t", 2, 10)], "topic string, partition int, position bigint")
    got = lag.lag_progress(starts, ends, seen, threshold=0.5)
    # Half is not past the threshold; no lag, no progress; no position, no progress made.
    assert rows(got, "partition", "progress", "flush") == [(0, 0.5, False), (1, 0.6, True), (2, None, False), (3, 0.0, False)]


def ema(samples, alpha):
    estimate, history = 0.0, []
    for seq, size, seconds in samples:
        if seconds <= 0:
            continue
        sample = size / seconds
        estimate = sample if estimate == 0 else alpha * sample + (1 - alpha) * estimate
        history.append((seq, estimate))
    return estimate, history


@pytest.mark.parametrize("alpha, fold", [(0.3, 256), (0.3, 3), (1.0, 4), (0.01, 5)])
def test_throughput(spark, monkeypatch, alpha, fold):
    monkeypatch.setattr(telemetry, "FOLD", fold)
    rng = random.Random(5)
    log = {
        "busy": [(i * 2, rng.randrange(10**6), rng.choice([0.0, 0.5, 2.0, -1.0])) for i in range(150)],
        "idle": [(i, 0, 1.0) for i in range(4)],
        "late": [(0, 0, 1.0), (1, 0, 1.0), (2, 900, 3.0), (3, 0, 1.0), (4, 100, 1.0)],
        "none": [(0, 5, 0.0)],
    }
    df = spark.createDataFrame([(t, *s) for t, rows in log.items() for s in rows], "topic string, seq bigint, bytes bigint, elapsed_seconds double")
    for r in telemetry.throughput_ema(df, alpha).collect():
        assert r["bytes_per_second"] == pytest.approx(ema(log[r["topic"]], alpha)[0], rel=1e-9)
    got = {(r["topic"], r["seq"]): r["bytes_per_second"] for r in telemetry.ema_history(df, alpha).collect()}
    want = {(t, seq): e for t, rows in log.items() for seq, e in ema(rows, alpha)[1]}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_budgets(spark):
    rates = spark.createDataFrame([("fast", 1000.0), ("slow", 1.0), ("mid", 10.0), ("none", 0.0)], "topic string, bytes_per_second double")
    args = (4000, F.lit(4), F.lit(999), F.lit(30), F.lit(300))
    got = {r["topic"]: (r["max_batch_bytes"], r["interval_seconds"]) for r in telemetry.flush_budget(rates, *args).collect()}
    assert got == {"fast": (999, 30), "slow": (999, 300), "mid": (999, 99), "none": (999, 30)}
    patient = telemetry.flush_budget(rates, *args, unknown_rate="max").filter("topic = 'none'").first()
    assert patient["interval_seconds"] == 300


def test_transform_and_fresh_view(spark, rows):
    assert rows(transform_batch(spark.range(5), "SELECT max(id) AS top FROM input")) == [(4,)]
    landed = spark.sql("SELECT id, id AS snapshot_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS ts FROM range(10)")
    got = fresh_view(landed, landed.filter("id < 4"), F.lit("2024-01-01 06:00:00").cast("timestamp_ntz"), F.lit(3))
    assert rows(got, "id", "origin") == [(i, "history") for i in range(4)] + [(i, "landed") for i in range(6, 10)]


def test_state_is_written_in_versions(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    assert export.load_state(spark, path).count() == 0
    for n in (3, 8):
        done = spark.createDataFrame([("t", n)], "table_name string, current_snapshot bigint")
        at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        export.save_state(export.record_export(export.load_state(spark, path), done, at), path)
    assert rows(export.load_state(spark, path), "table_name", "last_exported_snapshot") == [("t", 8)]


def test_iceberg_needs_a_catalog(spark):
    with pytest.raises(RuntimeError, match="spark.sql.catalog.lake"):
        register.register_in_iceberg(spark, "lake", "db.t", "/x")


def test_files_that_land_later_wait_for_the_next_export(spark, rows):
    files = spark.createDataFrame(
        [("t", "p0", 0, 1, 9), ("t", "p1", 1, 1, 9), ("t", "p2", 2, 1, 9)],
        "table_name string, path string, snapshot_id bigint, record_count bigint, file_size_bytes bigint",
    )
    first = spark.createDataFrame([("t", None, 1)], "table_name string, last_exported_snapshot bigint, current_snapshot bigint")
    then = spark.createDataFrame([("t", 1, 2)], "table_name string, last_exported_snapshot bigint, current_snapshot bigint")
    assert rows(export.files_since(files, first), "path") == [("p0",), ("p1",)]
    assert rows(export.files_since(files, then), "path") == [("p2",)]


def test_export_job(spark, tmp_path, rows):
    """Files that land during a run wait for the next one, a conflicting table is blocked, the others go on."""
    shape = "table_name string, path string, snapshot_id bigint, record_count bigint, file_size_bytes bigint"
    files = spark.createDataFrame([("t", "p0", 0, 1, 9), ("t", "p1", 1, 1, 9), ("u", "q1", 1, 1, 9), ("v", "r1", 1, 1, 1)], shape)
    late = files.unionByName(spark.createDataFrame([("t", "p2", 2, 1, 9)], shape))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    snapshots = spark.createDataFrame([(n,) for n in range(3)], "snapshot_id bigint").withColumn("commit_time", at)
    state, seen = str(tmp_path / "state"), []

    def write(table, snapshot, chosen):
        if table == "u":
            raise SchemaConflict("x is text")
        seen.append((table, snapshot, [r["path"] for r in chosen.orderBy("path").collect()]))

    for known in (files, late, late):
        export.run_export(known, snapshots, state, at, write, min_bytes=5, max_age_minutes=60)
    assert seen == [("t", 1, ["p0", "p1"]), ("t", 2, ["p2"])]
    got = export.load_state(spark, state)
    assert rows(got, "table_name", "last_exported_snapshot", "export_blocked") == [("t", 2, False), ("u", None, True)]
    # A version without its pointer is not read.
    got.limit(0).write.parquet(f"{state}/version=9")
    assert export.load_state(spark, state).count() == 2


def test_a_cut_off_parquet_file_is_skipped_and_told(spark, tmp_path):
    path = tmp_path / "files"
    spark.range(1000).repartition(2).write.parquet(str(path))
    promised = [tuple(r) for r in compact.file_rows(spark, str(path)).collect()]
    manifest = spark.createDataFrame(promised, "path string, record_count bigint, file_size_bytes bigint")
    cut = sorted(path.glob("*.parquet"))[0]
    cut.write_bytes(cut.read_bytes()[:-100])
    got = compact.read_skipping_corrupt(spark, [str(path)], spark.range(1).schema)
    assert 0 < got.count() < 1000
    short = compact.short_files(got, manifest).collect()
    assert len(short) == 1 and short[0]["rows_read"] == 0 and short[0]["path"].endswith(cut.name)


def test_damage_is_told_from_lengths_and_footers(spark, tmp_path):
    path = tmp_path / "files"
    spark.range(1000).repartition(5).write.parquet(str(path))
    manifest = compact.file_rows(spark, str(path))
    promised = {r["path"].rsplit("/", 1)[1]: r["record_count"] for r in manifest.collect()}
    good, cut, gone, grown, fewer = sorted(path.glob("*.parquet"))
    manifest = spark.createDataFrame(
        [(r["path"], r["record_count"] + (r["path"].endswith(fewer.name)), r["file_size_bytes"]) for r in manifest.collect()],
        "path string, record_count bigint, file_size_bytes bigint",
    )
    cut.write_bytes(cut.read_bytes()[:-100])
    gone.rename(tmp_path / "elsewhere")
    # Another whole file in its place.
    spark.range(400).coalesce(1).write.parquet(str(tmp_path / "other"))
    grown.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    for crc in path.glob(".*.crc"):
        crc.rename(tmp_path / crc.name.replace(".", "_"))
    got = {r["path"].rsplit("/", 1)[1]: (r["damage"], r["rows_found"]) for r in compact.damage_report(spark, [str(path)], manifest).collect()}
    assert got == {cut.name: ("unreadable", None), gone.name: ("missing", None), grown.name: ("size", 400), fewer.name: ("rows", promised[fewer.name])}
    assert good.name not in got


@pytest.mark.parametrize("where", ["before", "after"])
def test_an_export_that_fails_writes_each_file_once(spark, tmp_path, rows, where):
    """One table fails, before or after it has written; a file lands; the run is repeated."""
    shape = "table_name string, path string, snapshot_id bigint, record_count bigint, file_size_bytes bigint"
    files = spark.createDataFrame([("a", "p0", 0, 1, 9), ("b", "q0", 0, 1, 9)], shape)
    late = files.unionByName(spark.createDataFrame([("a", "p1", 1, 1, 9), ("b", "q1", 1, 1, 9)], shape))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    snapshots = spark.createDataFrame([(n,) for n in range(3)], "snapshot_id bigint").withColumn("commit_time", at)
    state, out, broken = str(tmp_path / "state"), {}, [True]

    def write(table, snapshot, chosen):
        if table == "b" and broken and where == "before":
            raise OSError("disk full")
        out[table, snapshot] = sorted(r["path"] for r in chosen.collect())
        if table == "b" and broken:
            raise OSError("disk full")

    def run(known):
        return sorted(tuple(r) for r in export.run_export(known, snapshots, state, at, write, min_bytes=5).collect())

    assert run(files) == [("a", 0)]
    assert rows(export.open_exports(spark, state), "table_name", "current_snapshot", "attempts", "reason") == [("b", 0, 1, "disk full")]
    # The one that failed is tried again with its own list; it fails again and the other goes on.
    assert run(late) == [("a", 1)]
    assert rows(export.open_exports(spark, state), "attempts") == [(2,)]
    broken.clear()
    assert run(late) == [("b", 0), ("b", 1)] and run(late) == []
    assert out == {("a", 0): ["p0"], ("a", 1): ["p1"], ("b", 0): ["q0"], ("b", 1): ["q1"]}
    assert rows(export.load_state(spark, state), "table_name", "last_exported_snapshot") == [("a", 1), ("b", 1)]
    assert export.open_exports(spark, state).count() == 0


def test_an_export_run_that_is_killed_is_resumed(spark, tmp_path, rows, monkeypatch):
    shape = "table_name string, path string, snapshot_id bigint, record_count bigint, file_size_bytes bigint"
    files = spark.createDataFrame([(t, f"{t}0", 0, 1, 9) for t in "abc"], shape)
    late = files.unionByName(spark.createDataFrame([(t, f"{t}1", 1, 1, 9) for t in "abc"], shape))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    snapshots = spark.createDataFrame([(0,), (1,)], "snapshot_id bigint").withColumn("commit_time", at)
    state, out = str(tmp_path / "state"), []

    def write(table, snapshot, chosen):
        if table == "b" and not out.count(("killed",)):
            out.append(("killed",))
            raise KeyboardInterrupt
        out.append((table, snapshot, [r["path"] for r in chosen.collect()]))

    with pytest.raises(KeyboardInterrupt):
        export.run_export(files, snapshots, state, at, write, min_bytes=5, side_by_side=1)
    # The table that was done counts although the run never saved its state.
    assert rows(export.load_state(spark, state), "table_name") == [("a",)] or rows(export.load_state(spark, state), "table_name") == [("a",), ("c",)]
    export.run_export(late, snapshots, state, at, write, min_bytes=5, side_by_side=1)
    written = [o for o in out if len(o) == 3]
    assert sorted(written) == [(t, n, [f"{t}{n}"]) for t in "abc" for n in (0, 1)]


def test_two_registrations_at_once(spark, tmp_path, rows):
    shape = "table_name string, path string, record_count bigint, file_size_bytes bigint"
    path = str(tmp_path / "registered")
    sets = [spark.createDataFrame([("t", f"p{n}", 1, 9) for n in range(k, k + 6)], shape) for k in (0, 3, 6, 0)]
    threads = [threading.Thread(target=register.register_files, args=(files, path)) for files in sets]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert rows(register.read_registrations(spark, path), "path") == sorted((f"p{n}",) for n in range(12))
    assert register.register_files(sets[1], path) is None


def test_a_registration_that_is_cut_off_is_invisible(spark, tmp_path, rows, monkeypatch):
    shape = "table_name string, path string, record_count bigint, file_size_bytes bigint"
    path = str(tmp_path / "registered")
    one, two = (spark.createDataFrame([("t", f"p{k}", 1, 9)], shape) for k in range(2))
    register.register_files(one, path)
    with monkeypatch.context() as patch:
        patch.setattr(register.commits, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            register.register_files(two, path)
    assert rows(register.read_registrations(spark, path), "path") == [("p0",)]
    monkeypatch.setattr(register, "FOLD_EVERY", 2)
    assert register.register_files(one.unionByName(two), path) == 1
    # The rows are in one folder now.
    assert register.commits.read_history(spark, path).tail == []
    assert rows(register.read_registrations(spark, path), "path") == [("p0",), ("p1",)]
