"""Counts per user and rule that grow while alerts arrive, each micro-batch counted once.

What a micro-batch adds is written into a folder of its number, once.  From time
to time all that was added is folded into one folder, named by the last
micro-batch in it; a reader takes the newest of those and what was added since.
A micro-batch that runs again finds its folder, or is behind the fold, and adds
nothing; a fold is written aside and appears whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigilpay.config import RULE_IDS
from vigilpay.streaming import tables

_KEYS = ["user_id", "rule_id"]


def _folded(spark: SparkSession, path: str) -> int:
    """The last micro-batch that is folded, or -1."""
    return max(tables.batch_ids(spark, f"{path}/folded"), default=-1)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """``user_id``, ``rule_id``, ``n`` over all micro-batches so far."""
    last = _folded(spark, path)
    rows = spark.createDataFrame([], "user_id string, rule_id string, n bigint")
    if last >= 0:
        rows = rows.unionByName(tables.read_batch(spark, f"{path}/folded", last))
    since = [i for i in tables.batch_ids(spark, f"{path}/added") if i > last]
    added = tables.read_batches(spark, f"{path}/added", since)
    rows = rows if added is None else rows.unionByName(added)
    return rows.groupBy(*_KEYS).agg(F.sum("n").alias("n"))


def features(spark: SparkSession, path: str) -> DataFrame:
    """One row per user, a column per rule."""
    return counts(spark, path).groupBy("user_id").pivot("rule_id", RULE_IDS).agg(F.sum("n")).fillna(0, RULE_IDS)


def add(alerts: DataFrame, path: str, batch_id: int, fold_every: int = 20) -> None:
    """Count the alerts of a micro-batch; a sink for ``foreachBatch``."""
    spark = alerts.sparkSession
    if batch_id <= _folded(spark, path):
        return
    rows = alerts.filter("user_id IS NOT NULL").groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n"))
    tables.write_batch(rows, f"{path}/added", batch_id)
    if (batch_id + 1) % fold_every == 0:
        fold(spark, path, batch_id)


def fold(spark: SparkSession, path: str, batch_id: int) -> None:
    """Fold all up to a micro-batch; the folds before the last one, and what they hold, are removed."""
    before = _folded(spark, path)
    tables.write_batch(counts(spark, path), f"{path}/folded", batch_id, keep_empty=True)
    for i in tables.batch_ids(spark, f"{path}/folded"):
        if i < before:
            tables.drop_batch(spark, f"{path}/folded", i)
    for i in tables.batch_ids(spark, f"{path}/added"):
        if i <= before:
            tables.drop_batch(spark, f"{path}/added", i)
