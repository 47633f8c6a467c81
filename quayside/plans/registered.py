"""The table of queries: name, operator ids, Spark callable and SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.session import prepare


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(ids: str, sql: str | None = None, given: str | None = None):
    """Register a query. ``given`` holds the common table expressions of ``sql``."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(prepare(spark), sf_dir.rstrip("/"))

        text = f"WITH RECURSIVE {given}\n{sql}" if sql and given else sql
        assert run.__name__ not in QUERIES, run.__name__
        QUERIES[run.__name__] = Query(run.__name__, ids, prepared, text)
        return run

    return add
