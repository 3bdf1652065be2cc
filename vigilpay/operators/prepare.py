"""Stream preparation on tables: watermark, deduplication, late routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vigilpay.functions.scores import same_text
from vigilpay.operators import scans
from vigilpay.session import stage

WATERMARK_SECONDS = 60


def with_watermark(
    events: DataFrame,
    delay_seconds: int = WATERMARK_SECONDS,
    block_bits: int = scans.BLOCK_BITS,
    group_bits: int = scans.GROUP_BITS,
    newest_us: int | None = None,
) -> DataFrame:
    """Add ``watermark_ts``: the largest event time that arrived before the row, less the delay.

    Null for the first arrival, before which there is no watermark.  Where
    ``events`` go on from earlier ones, ``newest_us`` is the largest event time
    of those, in microseconds.
    """
    earlier = F.lit(None).cast("timestamp") if newest_us is None else F.timestamp_micros(F.lit(newest_us))
    return scans.running_max_before(
        events, "event_ts", "_max_before", block_bits=block_bits, group_bits=group_bits
    ).withColumn(
        "watermark_ts", F.greatest("_max_before", earlier) - F.make_dt_interval(secs=F.lit(delay_seconds))
    ).drop("_max_before")


def arrival_clock(
    events: DataFrame, block_bits: int = scans.BLOCK_BITS, group_bits: int = scans.GROUP_BITS
) -> DataFrame:
    """Add ``clock_us``, the clock by which state is forgotten: the largest process time up to each arrival.

    A clock does not go back, process times of single events may.  An unreadable
    process time leaves the clock where it was; before the first readable one it is 0.
    """
    timed = events.withColumn("_us", F.unix_micros(F.try_to_timestamp("process_time")))
    before = scans.running_max_before(timed, "_us", "_before", block_bits=block_bits, group_bits=group_bits)
    return before.withColumn("clock_us", F.coalesce(F.greatest("_before", "_us"), F.lit(0).cast("bigint"))).drop("_us", "_before")


def dedup(events: DataFrame, ttl_us: int | None = None) -> DataFrame:
    """The first arrival of every ``event_id``.

    Spark turns "first row per key" into a limit that already runs before the
    shuffle, so a map task sends at most one row per id, also for an id whose
    copies make up a large part of the data.

    With ``ttl_us`` an id is forgotten that many microseconds after the arrival
    that was let through, by ``clock_us`` (``arrival_clock``): the first arrival
    later than that is let through again.  Only ids seen over a longer time than
    that take the further steps, see ``scans.spaced_after_first``.
    """
    order = Window.partitionBy("event_id").orderBy("arrival_seq")
    first = events.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").drop("_copy")
    if ttl_us is None:
        return first
    # of arrivals at one time only the first can be let through
    points = events.groupBy(F.col("event_id").alias("key"), F.col("clock_us").alias("at")).agg(F.min("arrival_seq").alias("seq"))
    points = stage(points, "sights")
    again = scans.spaced_after_first(points.select("key", "at"), ttl_us + 1).join(points, ["key", "at"])
    again = again.select(F.col("key").alias("event_id"), F.col("seq").alias("arrival_seq"))
    return first.unionByName(events.join(again, ["event_id", "arrival_seq"]).select(*events.columns))


def flag_late(
    events: DataFrame,
    delay_seconds: int = WATERMARK_SECONDS,
    block_bits: int = scans.BLOCK_BITS,
    group_bits: int = scans.GROUP_BITS,
    newest_us: int | None = None,
    ttl_us: int | None = None,
) -> DataFrame:
    """Deduplicated events with ``is_late``: strictly behind the watermark on arrival.

    The watermark follows every parsed arrival, copies included.  It is worked
    out on three narrow columns; only the late ids (few) meet the full rows,
    which are shuffled once, by ``event_id``.  ``ttl_us``: see ``dedup``.
    """
    narrow = events.select("event_id", "arrival_seq", "event_ts")
    behind = with_watermark(narrow, delay_seconds, block_bits, group_bits, newest_us).filter(
        F.col("event_ts") < F.col("watermark_ts")
    )
    if ttl_us is not None:
        # an id may pass several times, each time late or not
        flags = behind.select("event_id", "arrival_seq", F.lit(True).alias("_late"))
        flagged = dedup(events, ttl_us).join(flags, ["event_id", "arrival_seq"], "left")
        return flagged.select(*events.columns, F.coalesce("_late", F.lit(False)).alias("is_late"))
    late = (
        # an id's first arrival is its smallest number, so the smallest late
        # number equals it exactly when that first arrival was late
        behind.groupBy("event_id")
        .agg(F.min("arrival_seq").alias("_late_seq"))
    )
    return (
        dedup(events)
        .join(late, "event_id", "left")
        .withColumn("is_late", F.coalesce(F.col("_late_seq") == F.col("arrival_seq"), F.lit(False)))
        .drop("_late_seq")
    )


def on_time_events(events: DataFrame, delay_seconds: int = WATERMARK_SECONDS, **blocks) -> DataFrame:
    return flag_late(events, delay_seconds, **blocks).filter(~F.col("is_late")).drop("is_late")


def late_events(events: DataFrame, delay_seconds: int = WATERMARK_SECONDS, **blocks) -> DataFrame:
    return flag_late(events, delay_seconds, **blocks).filter("is_late").drop("is_late")


def successful_payments(events: DataFrame) -> DataFrame:
    return events.filter(same_text(F.col("transaction_status"), "SUCCESS"))
