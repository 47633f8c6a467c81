"""Queries over the file catalog: live files, registration, export and compaction inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import names
from quayside.operators import compact, export, register, transform
from quayside.plans import fixtures as X
from quayside.plans.registered import QUERIES, query
from quayside.session import fresh_dir
from quayside.sources import catalog, commits

NOW = "2001-11-10 00:00:00"


def _root():
    return names.table_root(F.col("is_name"), F.col("table_name"))


def _live(files):
    return catalog.live_files(files, X.tables_of(files), _root())


@query("S8", "SELECT DISTINCT table_name FROM tables", X.FILES_SQL)
def lake_tables(spark, sf_dir):
    return catalog.list_tables(X.tables_of(X.files(spark, sf_dir)))


@query("J5 A2", "SELECT * FROM newest", X.FILES_SQL)
def newest_incarnations(spark, sf_dir):
    return catalog.newest_incarnation(X.tables_of(X.files(spark, sf_dir)))


@query("F7", "SELECT table_id, snapshot_id, path FROM full_files", X.FILES_SQL)
def resolved_paths(spark, sf_dir):
    path = names.resolve_path(F.col("path"), F.col("path_is_relative"), _root())
    return X.files(spark, sf_dir).select("table_id", "snapshot_id", path.alias("path"))


@query("S9 P9 J5", "SELECT * FROM live", X.FILES_SQL)
def live_files(spark, sf_dir):
    return _live(X.stored_files(spark, sf_dir))


@query(
    "A5",
    """SELECT t.table_name, count(l.path) AS files, CAST(coalesce(sum(l.record_count), 0) AS BIGINT) AS rows,
      CAST(coalesce(sum(l.file_size_bytes), 0) AS BIGINT) AS bytes
    FROM newest t LEFT JOIN live l USING (table_name) GROUP BY ALL""",
    X.FILES_SQL,
)
def table_totals(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return catalog.file_totals(_live(files), X.tables_of(files))


@query("P10", "SELECT table_name FROM newest WHERE table_name NOT IN (SELECT table_name FROM live)", X.FILES_SQL)
def empty_tables(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return catalog.empty_tables(_live(files), X.tables_of(files))


@query("A13", "SELECT count(*) AS files FROM files", X.FILES_SQL)
def data_file_count(spark, sf_dir):
    return catalog.file_count(X.files(spark, sf_dir))


@query("A6", "SELECT coalesce(max(snapshot_id), 0) AS snapshot_id FROM snapshots", X.FILES_SQL)
def latest_snapshot(spark, sf_dir):
    return catalog.latest_snapshot(X.snapshots(spark, sf_dir))


@query("O1", "SELECT * FROM snapshots ORDER BY snapshot_id DESC LIMIT 5", X.FILES_SQL)
def recent_snapshots(spark, sf_dir):
    return catalog.recent_snapshots(X.snapshots(spark, sf_dir))


_CHANGES = "'inserted files: ' || files || ', rows: ' || rows"


@query(
    "O2",
    f"""SELECT snapshot_id, {_CHANGES} AS changes_made
    FROM (SELECT snapshot_id, count(*) AS files, sum(record_count) AS rows FROM files GROUP BY 1)
    ORDER BY snapshot_id DESC LIMIT 10""",
    X.FILES_SQL,
)
def recent_changes(spark, sf_dir):
    per_snapshot = X.files(spark, sf_dir).groupBy("snapshot_id")
    counted = per_snapshot.agg(F.count("*").alias("files"), F.sum("record_count").alias("rows"))
    return catalog.recent_changes(counted.select("snapshot_id", F.expr(_CHANGES).alias("changes_made")))


_NEW = "new AS (SELECT table_name, path, record_count, file_size_bytes FROM live WHERE path NOT IN (SELECT path FROM registered))"


@query("J1", "SELECT * FROM new", f"{X.FILES_SQL},\n{_NEW}")
def new_files(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return register.new_files(_live(files), X.registered(files))


@query("J1 K4 S11", "SELECT * FROM registered UNION ALL SELECT * FROM new", f"{X.FILES_SQL},\n{_NEW}")
def registered_files(spark, sf_dir):
    """Commit the new files' metadata to the target, twice, and read the target."""
    files = X.stored_files(spark, sf_dir)
    path = fresh_dir(spark, "registered")
    register.register_files(X.registered(files), path)
    for _ in range(2):
        register.register_files(_live(files), path)
    return register.read_registrations(spark, path)


@query(
    "A1 P10",
    """SELECT table_name, count(*) FILTER (path NOT IN (SELECT path FROM registered)) AS new_files,
      CAST(coalesce(sum(record_count) FILTER (path NOT IN (SELECT path FROM registered)), 0) AS BIGINT) AS new_rows,
      count(*) FILTER (path IN (SELECT path FROM registered)) AS skipped_files
    FROM live GROUP BY table_name""",
    X.FILES_SQL,
)
def registration_report(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return register.registration_report(_live(files), X.registered(files))


@query("J1", "SELECT * FROM registered WHERE path NOT IN (SELECT path FROM live)", X.FILES_SQL)
def stale_registrations(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return register.stale_registrations(_live(files), X.registered(files))


_CANDIDATES = f"""pending AS (
  SELECT files.table_name, known.last_exported_snapshot, files.snapshot_id, file_size_bytes, commit_time
  FROM files JOIN snapshots ON snapshots.snapshot_id = files.snapshot_id
  LEFT JOIN export_state known ON known.table_name = files.table_name
  WHERE known.export_enabled IS NOT FALSE AND known.export_blocked IS NOT TRUE
    AND files.snapshot_id > coalesce(known.last_exported_snapshot, -1)),
candidates AS (
  SELECT table_name, last_exported_snapshot, max(snapshot_id) AS current_snapshot,
    CAST(sum(file_size_bytes) AS BIGINT) AS accumulated_bytes
  FROM pending GROUP BY ALL
  HAVING accumulated_bytes >= 2000 OR min(commit_time) <= TIMESTAMP '{NOW}' - INTERVAL 700 DAY)"""


def _candidates(spark, sf_dir, files):
    return export.export_candidates(
        files,
        X.snapshots(spark, sf_dir),
        X.export_state(files),
        F.lit(NOW).cast("timestamp_ntz"),
        min_bytes=2000,
        max_age_minutes=60 * 24 * 700,
    )


@query("D1", "SELECT * FROM candidates", f"{X.FILES_SQL},\n{_CANDIDATES}")
def export_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir, X.stored_files(spark, sf_dir))


@query(
    "D2",
    """SELECT f.table_name, f.path, f.snapshot_id, f.record_count, f.file_size_bytes FROM full_files f
    JOIN candidates c ON c.table_name = f.table_name AND f.snapshot_id > coalesce(c.last_exported_snapshot, -1)
      AND f.snapshot_id <= c.current_snapshot""",
    f"{X.FILES_SQL},\n{_CANDIDATES}",
)
def files_to_export(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return export.files_since(X.full_paths(files), _candidates(spark, sf_dir, files))


@query(
    "D3",
    f"""SELECT coalesce(e.table_name, c.table_name) AS table_name,
      coalesce(c.current_snapshot, e.last_exported_snapshot) AS last_exported_snapshot,
      CASE WHEN c.table_name IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE e.last_export_time END AS last_export_time,
      coalesce(e.export_enabled, true) AS export_enabled, coalesce(e.export_blocked, false) AS export_blocked,
      e.export_blocked_reason
    FROM export_state e FULL JOIN candidates c ON e.table_name = c.table_name""",
    f"{X.FILES_SQL},\n{_CANDIDATES}",
)
def export_state_after(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return export.record_export(X.export_state(files), _candidates(spark, sf_dir, files), F.lit(NOW).cast("timestamp_ntz"))


_STATE_AFTER = QUERIES["export_state_after"].sql


@query("D3", _STATE_AFTER)
def saved_export_state(spark, sf_dir):
    """The state before and after an export, written as two versions; the newer one is read."""
    files, path = X.stored_files(spark, sf_dir), fresh_dir(spark, "export-state")
    export.save_state(X.export_state(files), path)
    before = export.load_state(spark, path)
    export.save_state(export.record_export(before, _candidates(spark, sf_dir, files), F.lit(NOW).cast("timestamp_ntz")), path)
    return export.load_state(spark, path)


@query(
    "D4",
    """SELECT f.table_name, f.path, f.snapshot_id, f.record_count, f.file_size_bytes
    FROM full_files f JOIN export_state e USING (table_name) WHERE f.snapshot_id <= e.last_exported_snapshot""",
    X.FILES_SQL,
)
def expirable_files(spark, sf_dir):
    files = X.stored_files(spark, sf_dir)
    return export.expirable_files(X.full_paths(files), X.export_state(files))


@query(
    "D15",
    """SELECT l_orderkey, l_linenumber, l_shipdate AS ts, CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT) AS snapshot_id,
      CASE WHEN l_shipdate < TIMESTAMP '2001-06-01' THEN 'history' ELSE 'landed' END AS origin
    FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-06-01' OR l_shipdate >= TIMESTAMP '2001-08-15'""",
)
def fresh_rows(spark, sf_dir):
    """Exported months beside what landed since; the months between are not fresh."""
    rows = X.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_shipdate AS ts",
        "CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT) AS snapshot_id",
    )
    history = rows.filter(F.col("ts") < F.lit("2001-06-01").cast("timestamp_ntz"))
    return transform.fresh_view(rows, history, F.lit("2001-08-15").cast("timestamp_ntz"), F.lit(77))


# --- files of two schema versions -----------------------------------------


def _mixed(spark, sf_dir):
    """Orders as two versions: a whole-number price, then a double and one more column."""
    orders = X.table(spark, sf_dir, "orders")
    old = orders.filter("o_orderkey % 2 = 0").selectExpr("o_orderkey", "CAST(floor(o_totalprice) AS BIGINT) AS o_totalprice")
    new = orders.filter("o_orderkey % 2 <> 0").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return old, new


def _stored_mixed(spark, sf_dir):
    paths, parts = [], []
    for version, part in enumerate(_mixed(spark, sf_dir)):
        paths.append(fresh_dir(spark, f"mixed-{version}"))
        part.write.parquet(paths[-1])
        parts.append(spark.read.parquet(paths[-1]))
    return paths, parts


_MIXED_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 2 <> 0 THEN o_orderdate END AS o_orderdate FROM orders"""


@query("X2 S12", _MIXED_SQL)
def united_versions(spark, sf_dir):
    _, parts = _stored_mixed(spark, sf_dir)
    return compact.union_versions(parts, parts[1].schema)


@query("D5", _MIXED_SQL)
def compacted_rows(spark, sf_dir):
    _, parts = _stored_mixed(spark, sf_dir)
    path = fresh_dir(spark, "compacted")
    compact.compact(compact.union_versions(parts, parts[1].schema), path)
    return spark.read.parquet(path)


@query(
    "D6",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderkey, o_totalprice, o_orderstatus, o_orderdate
    FROM orders WHERE o_orderkey % 2 <> 0 UNION ALL
    SELECT NULL, o_orderkey, floor(o_totalprice), NULL, NULL FROM orders WHERE o_orderkey % 2 = 0""",
)
def compacted_by_time(spark, sf_dir):
    _, parts = _stored_mixed(spark, sf_dir)
    path = fresh_dir(spark, "by-time")
    united = compact.union_versions(parts, parts[1].schema)
    compact.compact(united.withColumn("order_year", F.year("o_orderdate")), path, partition_by="order_year")
    return spark.read.parquet(path)


# Bytes of a whole file that a cut-off copy of it keeps.
CUT_BYTES = 64


def _with_cut_off_copy(spark, path):
    """A folder with the beginning of one of the files of ``path``, as a writer leaves it that was ended."""
    broken = fresh_dir(spark, "broken")
    whole = compact.file_rows(spark, path).agg(F.min("path")).first()[0]
    commits.copy_beginning(spark, whole, f"{broken}/part-cut.parquet", CUT_BYTES)
    return broken


def _damaged(spark, sf_dir):
    """Both versions of the orders, each beside a cut-off file, and what a manifest promises: all rows a second time in the cut-off ones."""
    paths, parts = _stored_mixed(spark, sf_dir)
    broken = [_with_cut_off_copy(spark, path) for path in paths]
    promised = X.table(spark, sf_dir, "orders").agg(F.count("*")).scalar()
    lost = spark.read.format("binaryFile").load(broken).select(
        F.col("_metadata.file_path").alias("path"), promised.alias("record_count"), F.col("_metadata.file_size").cast("bigint").alias("file_size_bytes")
    )
    return paths, parts, broken, compact.file_rows(spark, *paths).unionByName(lost)


@query("D14", _MIXED_SQL)
def rows_without_corrupt_files(spark, sf_dir):
    """A cut-off file among the Parquet files of each version is skipped; all other rows are read."""
    paths, parts, broken, _ = _damaged(spark, sf_dir)
    read = [compact.read_skipping_corrupt(spark, [p, b], part.schema) for p, b, part in zip(paths, broken, parts)]
    return compact.union_versions(read, parts[1].schema)


_LOST = "SELECT 2 * count(*) AS record_count, {rows} AS {name}, 2 AS files FROM orders"


@query("D14", _LOST.format(rows="CAST(0 AS BIGINT)", name="rows_read"))
def files_with_missing_rows(spark, sf_dir):
    """The manifest promises rows that the cut-off files do not give; every row of the others is read."""
    paths, parts, broken, manifest = _damaged(spark, sf_dir)
    short = [
        compact.short_files(
            compact.read_skipping_corrupt(spark, [p, b], part.schema),
            manifest.filter(F.col("path").contains(p) | F.col("path").contains(b)),
        )
        for p, b, part in zip(paths, broken, parts)
    ]
    return short[0].unionByName(short[1]).agg(
        F.sum("record_count").cast("bigint").alias("record_count"),
        F.sum("rows_read").cast("bigint").alias("rows_read"),
        F.count("*").alias("files"),
    )


@query("D14", f"SELECT 'unreadable' AS damage, record_count, CAST(NULL AS BIGINT) AS rows_found, files FROM ({_LOST.format(rows='0', name='n')})")
def damaged_files(spark, sf_dir):
    """The same files found by lengths and footers alone."""
    paths, _, broken, manifest = _damaged(spark, sf_dir)
    return compact.damage_report(spark, [*paths, *broken], manifest).groupBy("damage").agg(
        F.sum("record_count").cast("bigint").alias("record_count"), F.sum("rows_found").cast("bigint").alias("rows_found"), F.count("*").alias("files")
    )


@query(
    "D5",
    """SELECT o_orderkey, 9007199254740992 + o_orderkey AS big FROM orders WHERE o_orderkey % 2 = 1""",
)
def lossy_widenings(spark, sf_dir):
    """Whole numbers beyond 2 to the power 53 that a DOUBLE cannot hold."""
    big = X.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "9007199254740992 + o_orderkey AS big")
    return compact.lossy_widenings(big, "big")
