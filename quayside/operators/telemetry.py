"""Throughput, flush budgets and counters per topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.config import EMA_ALPHA
from quayside.operators.scan import whole
from quayside.session import cut_lineage

# Flushes folded in one group; groups are folded again, level by level, so no
# group grows with the length of a topic's history.
FOLD = 256
LEVELS = 3

# An estimate moves as e -> z when it is still 0, else as e -> a*e + b. Moves of
# this form compose into one of the same form, which is what lets them be folded
# in groups: (z, a, b) stands for any run of consecutive flushes.
_IDENTITY = "named_struct('z', 0D, 'a', 1D, 'b', 0D)"
_COMPOSED = """aggregate(array_sort(collect_list(struct(idx, z, a, b))), {start}, (m, x) -> named_struct(
    'z', if(m.z = 0D, x.z, x.a * m.z + x.b), 'a', x.a * m.a, 'b', x.a * m.b + x.b))"""
_RUNNING = """aggregate(array_sort(collect_list(struct(idx, z, a, b))),
    named_struct('e', first(e_in), 'out', cast(array() as array<struct<idx:bigint,e_in:double>>)),
    (m, x) -> named_struct(
        'e', if(m.e = 0D, x.z, x.a * m.e + x.b),
        'out', array_append(m.out, named_struct('idx', x.idx, 'e_in', m.e)))).out"""


def _moves(flush_log: DataFrame, alpha: float) -> DataFrame:
    """One move per usable sample; samples that took no time are skipped."""
    sample = F.col("bytes").cast("double") / F.col("elapsed_seconds")
    return flush_log.filter(F.col("elapsed_seconds") > 0).select(
        "topic", F.col("seq").cast("bigint").alias("idx"), sample.alias("z"), F.lit(1.0 - alpha).alias("a"), (sample * alpha).alias("b")
    )


def _grouped(moves: DataFrame) -> DataFrame:
    return moves.withColumn("grp", whole(F.col("idx"), FOLD))


def _fold(moves: DataFrame) -> DataFrame:
    folded = _grouped(moves).groupBy("topic", "grp").agg(F.expr(_COMPOSED.format(start=_IDENTITY)).alias("m"))
    return folded.select("topic", F.col("grp").alias("idx"), "m.z", "m.a", "m.b")


def throughput_ema(flush_log: DataFrame, alpha: float = EMA_ALPHA) -> DataFrame:
    """Current bytes per second of each topic as an exponential moving average.

    ``flush_log``: ``topic, seq, bytes, elapsed_seconds``. The first sample is
    taken as it is, the next ones weigh ``alpha``. A topic without a usable
    sample has the estimate 0.
    """
    moves = _moves(flush_log, alpha)
    for _ in range(LEVELS):
        moves = _fold(moves)
    top = moves.groupBy("topic").agg(F.expr(_COMPOSED.format(start=_IDENTITY)).alias("m"))
    topics = flush_log.groupBy("topic").agg(F.count("*").alias("flushes"))
    return topics.join(top.select("topic", "m.z"), "topic", "left").select(
        "topic", "flushes", F.coalesce("z", F.lit(0.0)).alias("bytes_per_second")
    )


# What a run of batches comes to for each topic; two runs that follow one another merge into one.
ROLLUP = """topic string, batches bigint, records bigint, accepted bigint, rejected bigint, bytes bigint, largest_bytes bigint,
    rate struct<z: double, a: double, b: double>"""
_SUMS = ("batches", "records", "accepted", "rejected", "bytes")


def rollup(landing_log: DataFrame, alpha: float = EMA_ALPHA) -> DataFrame:
    """Counts, sizes and the composed moves of the rate per topic, over the batches of a landing log."""
    batches = landing_log.groupBy("topic", F.col("batch_id").alias("seq")).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in _SUMS[1:]], F.max("elapsed_seconds").alias("elapsed_seconds")
    )
    moves = _moves(batches, alpha)
    for _ in range(LEVELS):
        moves = _fold(moves)
    rates = moves.groupBy("topic").agg(F.expr(_COMPOSED.format(start=_IDENTITY)).alias("rate"))
    sums = [F.sum(c).cast("bigint").alias(c) for c in _SUMS[1:]]
    counts = batches.groupBy("topic").agg(F.count("*").alias("batches"), *sums, F.max("bytes").alias("largest_bytes"))
    return counts.join(rates, "topic", "left").select(
        "topic", *_SUMS, "largest_bytes", F.coalesce("rate", F.expr(_IDENTITY)).alias("rate")
    )


def merge_rollups(first: DataFrame, then: DataFrame) -> DataFrame:
    """The roll-up of two runs of batches of which ``then`` comes later."""
    both = first.select("topic", F.struct("*").alias("m")).join(then.select("topic", F.struct("*").alias("x")), "topic", "full")
    z = F.when(F.col("m.rate.z") == 0, F.col("x.rate.z")).otherwise(F.col("x.rate.a") * F.col("m.rate.z") + F.col("x.rate.b"))
    rate = F.struct(
        z.alias("z"),
        (F.col("x.rate.a") * F.col("m.rate.a")).alias("a"),
        (F.col("x.rate.a") * F.col("m.rate.b") + F.col("x.rate.b")).alias("b"),
    )
    alone = F.col("m").isNull() | F.col("x").isNull()
    return both.select(
        "topic",
        *[(F.coalesce(f"m.{c}", F.lit(0)) + F.coalesce(f"x.{c}", F.lit(0))).cast("bigint").alias(c) for c in _SUMS],
        F.greatest("m.largest_bytes", "x.largest_bytes").alias("largest_bytes"),
        F.when(alone, F.coalesce("m.rate", "x.rate")).otherwise(rate).alias("rate"),
    )


def rates(rolled: DataFrame) -> DataFrame:
    """``topic, flushes, bytes_per_second`` as ``throughput_ema`` gives them, from a roll-up."""
    return rolled.select("topic", F.col("batches").alias("flushes"), F.col("rate.z").alias("bytes_per_second"))


def _estimates_before(moves: DataFrame, levels: int) -> DataFrame:
    """``topic, idx, e_in``: the estimate that each move starts from."""
    if levels:
        carried = _estimates_before(_fold(moves), levels - 1).withColumnRenamed("idx", "grp")
        groups = _grouped(moves).join(carried, ["topic", "grp"]).groupBy("topic", "grp")
    else:
        groups = moves.withColumn("e_in", F.lit(0.0)).groupBy("topic")
    return groups.agg(F.expr(_RUNNING).alias("out")).select("topic", F.inline("out"))


def ema_history(flush_log: DataFrame, alpha: float = EMA_ALPHA) -> DataFrame:
    """The estimate after every usable flush.

    The moves are read once per level, so they are stored first.
    """
    moves = cut_lineage(_moves(flush_log, alpha), "moves")
    e = F.col("e_in")
    return moves.join(_estimates_before(moves, LEVELS), ["topic", "idx"]).select(
        "topic",
        F.col("idx").alias("seq"),
        F.when(e == 0, F.col("z")).otherwise(F.col("a") * e + F.col("b")).alias("bytes_per_second"),
    )


def active_topics(landing_log: DataFrame, stopped: DataFrame) -> DataFrame:
    """Number of topics that are still running, at least one."""
    running = landing_log.select("topic").distinct().join(stopped.select("topic"), "topic", "left_anti")
    return running.agg(F.greatest(F.count("*"), F.lit(1)).cast("bigint").alias("active"))


def flush_budget(
    rates: DataFrame,
    pool_bytes: int,
    active: Column,
    max_batch_bytes: Column,
    min_seconds: Column,
    max_seconds: Column,
    unknown_rate: str = "min",
) -> DataFrame:
    """Byte budget and flush interval per topic from ``(topic, bytes_per_second)``.

    The pool is shared by the active topics and capped by the topic's own limit;
    the interval is the time to fill it in whole seconds, within its bounds. An
    unknown rate gives the shortest interval, or the longest on request.
    """
    budget = F.least(F.floor(F.lit(pool_bytes) / active).cast("bigint"), max_batch_bytes.cast("bigint"))
    fill = F.least(F.col("_budget") / F.col("bytes_per_second"), F.lit(2**31 - 1).cast("double")).cast("int")
    default = min_seconds if unknown_rate == "min" else max_seconds
    return (
        rates.withColumn("_budget", budget)
        .withColumn(
            "interval_seconds",
            F.greatest(
                min_seconds, F.least(max_seconds, F.when(F.col("bytes_per_second") > 0, fill).otherwise(default))
            ).cast("int"),
        )
        .select("topic", "bytes_per_second", F.col("_budget").alias("max_batch_bytes"), "interval_seconds")
    )


def consumed(landing_log: DataFrame) -> DataFrame:
    return landing_log.groupBy("topic").agg(F.sum("records").cast("bigint").alias("records"))


def flushes(landing_log: DataFrame) -> DataFrame:
    return landing_log.groupBy("topic").agg(F.count_distinct("batch_id").alias("flushes"))


def batch_sizes(landing_log: DataFrame, percentiles: tuple[float, ...] = ()) -> DataFrame:
    """Count, sum and maximum of the batch sizes, with approximate percentiles on request."""
    per_batch = landing_log.groupBy("topic", "batch_id").agg(F.sum("bytes").alias("bytes"))
    extra = [F.percentile_approx("bytes", p).alias(f"p{round(p * 100)}") for p in percentiles]
    return per_batch.groupBy("topic").agg(
        F.count("*").alias("batches"),
        F.sum("bytes").cast("bigint").alias("total_bytes"),
        F.max("bytes").cast("bigint").alias("largest_bytes"),
        *extra,
    )


def stop_counts(stops: DataFrame) -> DataFrame:
    """Stopped topics by reason."""
    return stops.groupBy("topic", "reason").agg(F.count("*").alias("stops"))
