"""Plans: what is pushed down, what is shuffled, what must not appear."""

import re

from quayside.operators import register, validate
from quayside.plans import fixtures as X
from quayside.sources import catalog
from quayside.sources.topics import decode_json
from quayside.streaming import landing

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_slice_stays_in_the_jvm(spark):
    checked = validate.validate(decode_json(X.topic_log(spark, SF, dirty=True)), X.EVENT_SCHEMA)
    good = plan(validate.conform(validate.accepted(checked), X.EVENT_SCHEMA))
    assert "Python" not in good and "Exchange" not in good
    assert good.count("parseJson") == 1


def test_new_files_is_an_anti_join(spark):
    files = X.files(spark, SF)
    live = catalog.live_files(files, X.tables_of(files))
    text = plan(register.new_files(live, X.registered(files)))
    assert "LeftAnti" in text and "Python" not in text


def test_recent_snapshots_is_top_k(spark):
    assert "TakeOrderedAndProject" in plan(catalog.recent_snapshots(X.snapshots(spark, SF)))


def test_catalog_filters_reach_the_scan(spark, tmp_path):
    X.files(spark, SF).write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    text = plan(catalog.live_files(files, X.tables_of(files)))
    assert "IsNull(end_snapshot)" in text
    assert "ReadSchema: struct<table_id:bigint,snapshot_id:bigint,record_count:bigint,path:string" in text


def test_landed_versions_prune_batches(spark, tmp_path):
    for n in range(3):
        landing.land_batch(X.topic_log(spark, SF), n, str(tmp_path / "t"), X.EVENT_SCHEMA)
    text = plan(landing.read_table(spark, str(tmp_path / "t")).select("event_id"))
    assert "PartitionFilters: [isnotnull(landed_batch" in text and "ReadSchema: struct<event_id:bigint>" in text


def test_registered_batches_are_pruned(spark, tmp_path):
    for n in range(3):
        landing.land_batch(X.topic_log(spark, SF), n, str(tmp_path / "t"), X.EVENT_SCHEMA)
    listed = landing.read_part(spark, str(tmp_path / "t"), "manifest").filter("snapshot_id = 1")
    df = landing.read_registered(spark, str(tmp_path / "t"), listed)
    text = plan(df)
    assert "Join" not in text
    assert re.search(r"PartitionFilters: \[isnotnull\(landed_batch#\d+L\), \(landed_batch#\d+L >= 1\), \(landed_batch#\d+L <= 1\)\]", text)
