"""The ids let through in the last day, kept as tables, and what of a micro-batch is let through.

An id is remembered by a row of a table, not by state of its own: state of
Python rules costs milliseconds for every key, and nearly every event is a new
one.  A micro-batch looks up its ids in the rows of the last day by a join, and
writes those it lets through into a folder of its number.  From time to time
folders are folded into one; folded ones go when all in them is forgotten.
A micro-batch that runs again looks only at folders of earlier numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilpay import config
from vigilpay.operators import prepare
from vigilpay.streaming import tables

FOLD_EVERY = 20
_SIGHT = "event_id string, seen_ms bigint"


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """``event_id`` and ``seen_ms`` of what earlier micro-batches let through."""
    folded = tables.batch_ids(spark, f"{path}/folded")
    last = max(folded, default=-1)
    added = [i for i in tables.batch_ids(spark, f"{path}/added") if last < i < batch_id]
    parts = [tables.read_batches(spark, f"{path}/{name}", ids, _SIGHT) for name, ids in (("folded", folded), ("added", added)) if ids]
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def first_sights(batch: DataFrame, path: str, batch_id: int, ttl_us: int = config.DEDUP_TTL_US) -> DataFrame:
    """The first arrival of every ``event_id``, and again the first one later than ``ttl_us`` after it.

    ``batch`` has ``event_id``, ``arrival_seq`` and ``ingest_ms``, the clock of
    the rule.  On tables: ``prepare.dedup`` with a time to live.
    """
    ttl_ms, at = ttl_us // 1000, F.col("ingest_ms")
    low, high = batch.agg(F.min(at), F.max(at)).first()
    if low is None:
        return batch
    before = _before(batch.sparkSession, path, batch_id)
    if before is not None:
        own = batch.select("event_id").distinct()
        seen = before.filter(F.col("seen_ms") >= low - ttl_ms).join(own, "event_id", "left_semi")
        seen = seen.groupBy("event_id").agg(F.max("seen_ms").alias("seen_ms"))
        forgotten = F.col("seen_ms").isNull() | (at - F.col("seen_ms") > ttl_ms)
        batch = batch.join(seen, "event_id", "left").filter(forgotten).select(*batch.columns)
    # within the time to live only the first of an id can be let through
    rows = batch.withColumn("clock_us", at * 1000)
    return prepare.dedup(rows, ttl_us if high - low > ttl_ms else None).select(*batch.columns)


def remember(passed: DataFrame, path: str, batch_id: int, ttl_us: int = config.DEDUP_TTL_US, fold_every: int = FOLD_EVERY) -> None:
    """Store what a micro-batch lets through; fold what was stored before it when there is enough."""
    tables.write_batch(passed.select("event_id", F.col("ingest_ms").alias("seen_ms")), f"{path}/added", batch_id)
    if batch_id and batch_id % fold_every == 0:
        now = passed.agg(F.min("ingest_ms")).first()[0]
        _fold(passed.sparkSession, path, batch_id - 1, None if now is None else now - ttl_us // 1000)


def _fold(spark: SparkSession, path: str, batch_id: int, oldest_ms: int | None) -> None:
    """Fold what was added up to a micro-batch since the fold before; remove folds with nothing from ``oldest_ms`` on."""
    last = max(tables.batch_ids(spark, f"{path}/folded"), default=-1)
    there = tables.batch_ids(spark, f"{path}/added")
    rows = tables.read_batches(spark, f"{path}/added", [i for i in there if last < i <= batch_id], _SIGHT)
    if rows is not None:
        # adaptive execution makes files of a size; without it there is one for every partition
        tables.write_batch(rows.repartition("event_id"), f"{path}/folded", batch_id)
    folded = tables.batch_ids(spark, f"{path}/folded")
    for i in there:
        if i <= max(folded, default=-1):
            tables.drop_batch(spark, f"{path}/added", i)
    # folds follow each other in time; the newest says which batches are folded and stays
    for i in folded[:-1]:
        newest = tables.read_batch(spark, f"{path}/folded", i, _SIGHT).agg(F.max("seen_ms")).first()[0]
        if oldest_ms is None or newest >= oldest_ms:
            break
        tables.drop_batch(spark, f"{path}/folded", i)
