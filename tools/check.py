"""Run the registered queries beside their SQL twins: python tools/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans import all_queries  # noqa: E402
from quayside.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES.split():
        path = f"{sf_dir}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        db.sql(f"CREATE VIEW {name} AS FROM '{files}'")
    return db


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def rows_of(columns: list[str], rows) -> Counter:
    return Counter(tuple(plain(v) for v in r) for r in rows)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark = build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    db, bad = connect(sf_dir), 0
    for name in names:
        query, started = all_queries()[name], time.time()
        try:
            df = query.run(spark, sf_dir)
            columns = sorted(df.columns)
            got = rows_of(columns, df.select(*[f"`{c}`" for c in columns]).collect())
            took, started = time.time() - started, time.time()
            wanted = db.sql(query.sql)
            their = sorted(wanted.columns)
            expected = rows_of(their, wanted.select(*[f'"{c}"' for c in their]).fetchall())
            types = dict(zip(wanted.columns, [str(t) for t in wanted.types]))
            same = columns == their and got == expected
            print(f"{'ok  ' if same else 'DIFF'} {name:28} rows={sum(got.values())} spark={took:.1f}s sql={time.time() - started:.1f}s", flush=True)
            kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            if same and os.environ.get("TYPES"):
                print("      ", {c: (kinds[c], types[c]) for c in columns})
            if not same:
                bad += 1
                print("   ", columns, their, sum(expected.values()))
                print("    spark only", list((got - expected).items())[:4])
                print("    sql only  ", list((expected - got).items())[:4])
        except Exception as failure:
            bad += 1
            print(f"FAIL {name}: {str(failure)[:1500]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
