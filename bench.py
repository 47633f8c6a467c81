"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (names, comma separated; ``all`` for every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.plans import all_queries  # noqa: E402
from quayside.session import build_session  # noqa: E402

HEADLINE = (
    "landing_summary",
    "accepted_records",
    "dead_letters",
    "landed_rows",
    "landed_from_files",
    "evolved_table",
    "live_files",
    "new_files",
    "registered_files",
    "registration_report",
    "export_candidates",
    "files_to_export",
    "declared_columns",
    "schema_changes",
    "synced_fields",
    "lag_progress",
    "throughput",
    "throughput_history",
    "flush_batches",
    "compacted_rows",
    "compacted_by_time",
    "document_sizes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    known = all_queries()
    names = list(known) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINE)
    spark = build_session(
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    # Start the JVM's code paths and the Python workers before the clock runs.
    known["landing_summary"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(8).mapInPandas(lambda frames: frames, "id bigint").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name:28} {times[name]:8.3f}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
        "events": spark.read.parquet(f"{sf_dir}/events.parquet").count(),
    }
    if "landed_rows" in times:
        line["records_landed_per_second"] = round(line["events"] / times["landed_rows"])
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
