"""Users of a key per minute, kept as tables, and the windows that close with a micro-batch.

As state of Spark, every user of every window of a key is a row in memory: ten
rows for one appearance, and nearly every event is a new appearance.  Here a
micro-batch writes its appearances (key, user, minute) once, into a folder of
its number, and the windows that it closes are counted from the folders that
reach into them, as on tables (``windows.seen_windows``).  Folders that no open
window reaches go.

A row per micro-batch carries on the newest event time, up to which minute windows
are closed, and which folders are needed.  A micro-batch that runs again looks
only at folders of earlier numbers and its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilpay.operators import windows
from vigilpay.streaming import tables

_MINUTE_US = 60_000_000
_PROGRESS = "newest_us bigint, closed bigint, held array<struct<batch_id: bigint, newest_us: bigint>>"


@dataclass
class Progress:
    newest_us: int | None
    #: Windows that end up to this minute are closed.
    closed: int | None
    #: The folders that open windows reach, each with the largest event time up to it.
    held: list[tuple[int, int]]


def _progress(spark: SparkSession, path: str, batch_id: int) -> Progress:
    """As the batch before left it."""
    if batch_id == 0:
        return Progress(None, None, [])
    stored = tables.read_batch(spark, f"{path}/progress", batch_id - 1, _PROGRESS)
    row = stored.first() if stored is not None else None
    if row is None:
        raise RuntimeError(f"no progress of batch {batch_id - 1} in {path}")
    return Progress(row["newest_us"], row["closed"], [tuple(h) for h in row["held"]])


def add(batch: DataFrame, path: str, batch_id: int, key: str, minutes: int, delay_seconds: int) -> tuple[Progress, Progress]:
    """Store who used which key in which minute in a micro-batch; the progress before it and after it.

    ``batch`` has the key, ``user_id``, ``event_ts`` and ``arrival_seq``.  Events of later
    micro-batches are not older than the newest one so far by more than ``delay_seconds``.
    """
    spark = batch.sparkSession
    before = _progress(spark, path, batch_id)
    tables.write_batch(windows.appearances(batch, key), f"{path}/seen", batch_id)
    newest = batch.agg(F.max(F.unix_micros("event_ts"))).first()[0]
    newest = max((n for n in (newest, before.newest_us) if n is not None), default=None)
    now = None if newest is None else (newest - delay_seconds * 1_000_000) // _MINUTE_US
    closed = max((n for n in (now, before.closed) if n is not None), default=None)
    # a window that was open before this batch ends after what was closed
    held = [h for h in before.held if before.closed is None or h[1] // _MINUTE_US > before.closed - minutes]
    if tables.read_batch(spark, f"{path}/seen", batch_id, _seen(key)) is not None:
        held.append((batch_id, newest))
    return before, Progress(newest, closed, held)


def _seen(key: str) -> str:
    return f"{key} string, user_id string, pane bigint, first_seq bigint"


def closing(
    spark: SparkSession, path: str, key: str, minutes: int, threshold: int, before: Progress, after: Progress
) -> DataFrame | None:
    """Windows with more than ``threshold`` users that a micro-batch closes, or none if it closes no window.

    Columns of ``windows.distinct_user_windows``.
    """
    first, last = before.closed, after.closed
    if not after.held or first == last:
        return None
    rows = tables.read_batches(spark, f"{path}/seen", [i for i, _ in after.held], _seen(key)).filter(F.col("pane") < last)
    starts = F.col("first_pane") <= last - minutes
    if first is not None:
        rows, starts = rows.filter(F.col("pane") > first - minutes), starts & (F.col("first_pane") > first - minutes)
    # a user of a key stays with one task, which puts together the batches and finds the pane before
    rows = rows.repartition(key, "user_id").groupBy(key, "user_id", "pane").agg(F.min("first_seq").alias("first_seq"))
    return windows.seen_windows(rows, key, minutes, threshold, starts)


def done(spark: SparkSession, path: str, batch_id: int, before: Progress, after: Progress) -> None:
    """Store the progress of a micro-batch whose windows are written, and remove what no open window reaches."""
    row = spark.createDataFrame([(after.newest_us, after.closed, after.held)], _PROGRESS)
    tables.write_batch(row.coalesce(1), f"{path}/progress", batch_id, keep_empty=True)
    # the batch before may still be needed if this one runs again; older ones are not
    tables.drop_batch(spark, f"{path}/progress", batch_id - 2)
    for i, _ in before.held:
        if i not in {h[0] for h in after.held}:
            tables.drop_batch(spark, f"{path}/seen", i)
