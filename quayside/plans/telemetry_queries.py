"""Queries over flush and landing logs, and flush batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.config import EMA_ALPHA, MAX_FLUSH_SECONDS, MIN_FLUSH_SECONDS
from quayside.operators import batches, telemetry
from quayside.plans import fixtures as X
from quayside.plans.registered import query

_EMA = f"""samples AS (SELECT topic, seq, bytes / elapsed_seconds AS s,
    row_number() OVER (PARTITION BY topic ORDER BY seq) AS n FROM flush_log WHERE elapsed_seconds > 0),
ema AS (SELECT topic, seq, n, s AS e FROM samples WHERE n = 1
  UNION ALL SELECT x.topic, x.seq, x.n, CASE WHEN ema.e = 0 THEN x.s ELSE {EMA_ALPHA} * x.s + (1 - {EMA_ALPHA}) * ema.e END
  FROM ema JOIN samples x ON x.topic = ema.topic AND x.n = ema.n + 1),
rates AS (SELECT f.topic, f.flushes, coalesce(e.e, 0) AS bytes_per_second
  FROM (SELECT topic, count(*) AS flushes FROM flush_log GROUP BY 1) f
  LEFT JOIN (SELECT topic, arg_max(e, n) AS e FROM ema GROUP BY 1) e USING (topic))"""


@query("W1 D8", "SELECT topic, flushes, round(bytes_per_second, 6) AS bytes_per_second FROM rates", f"{X.FLUSH_SQL},\n{_EMA}")
def throughput(spark, sf_dir):
    rates = telemetry.throughput_ema(X.flush_log(spark, sf_dir))
    return rates.withColumn("bytes_per_second", F.round("bytes_per_second", 6))


@query("W1 D8", "SELECT topic, seq, round(e, 6) AS bytes_per_second FROM ema", f"{X.FLUSH_SQL},\n{_EMA}")
def throughput_history(spark, sf_dir):
    history = telemetry.ema_history(X.flush_log(spark, sf_dir))
    return history.withColumn("bytes_per_second", F.round("bytes_per_second", 6))


@query(
    "F8 F9 A11",
    f"""SELECT topic, round(bytes_per_second, 6) AS bytes_per_second, least(20000 // (SELECT count(*) FROM rates), 3000) AS max_batch_bytes,
      CAST(greatest({MIN_FLUSH_SECONDS}, least({MAX_FLUSH_SECONDS}, CASE WHEN bytes_per_second > 0
        THEN CAST(trunc(least(20000 // (SELECT count(*) FROM rates), 3000) / bytes_per_second) AS INTEGER)
        ELSE {MIN_FLUSH_SECONDS} END)) AS INTEGER) AS interval_seconds
    FROM rates""",
    f"{X.FLUSH_SQL},\n{_EMA}",
)
def flush_budgets(spark, sf_dir):
    log = X.flush_log(spark, sf_dir)
    active = telemetry.active_topics(log, log.select("topic").filter(F.lit(False)))
    budgets = telemetry.flush_budget(
        telemetry.throughput_ema(log),
        20000,
        active.scalar(),
        F.lit(3000),
        F.lit(MIN_FLUSH_SECONDS),
        F.lit(MAX_FLUSH_SECONDS),
    )
    return budgets.withColumn("bytes_per_second", F.round("bytes_per_second", 6))


BATCH_BYTES = 16_384
BATCH_SECONDS = 6 * 3600


@query(
    "W2",
    f"""SELECT topic, "partition", batch_start, max("offset") AS last_offset, count(*) AS records,
      CAST(sum(size) AS BIGINT) AS bytes, min("timestamp") AS first_at, max("timestamp") AS last_at,
      CASE WHEN sum(size) >= {BATCH_BYTES} THEN 'bytes'
           WHEN max(n) = max(total) THEN 'open' ELSE 'age' END AS closed_by
    FROM cut GROUP BY topic, "partition", batch_start""",
    X.TOPIC_SQL
    + f""",
ordered AS (SELECT topic, "partition", "offset", "timestamp", {X.CLEAN_BYTES_SQL} AS size,
    row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS n,
    count(*) OVER (PARTITION BY topic, "partition") AS total FROM topic_log),
cut AS (
  SELECT *, "offset" AS batch_start, "timestamp" AS began, CAST(size AS HUGEINT) AS filled FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.*, CASE WHEN fresh THEN o."offset" ELSE batch_start END, CASE WHEN fresh THEN o."timestamp" ELSE began END,
    CASE WHEN fresh THEN o.size ELSE filled + o.size END
  FROM (SELECT c.topic AS t, c."partition" AS p, c.n AS at, c.batch_start, c.began, c.filled, x AS o,
          c.filled >= {BATCH_BYTES} OR date_diff('microsecond', c.began, x."timestamp") >= {BATCH_SECONDS * 1_000_000} AS fresh
        FROM cut c JOIN ordered x ON x.topic = c.topic AND x."partition" = c."partition" AND x.n = c.n + 1))""",
)
def flush_batches(spark, sf_dir):
    return batches.cut_batches(X.sized_topic(spark, sf_dir), BATCH_BYTES, BATCH_SECONDS)
