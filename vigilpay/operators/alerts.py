"""Alert rows: construction, idempotent merge, uniqueness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay.config import Rule
from vigilpay.functions.ids import stable_id
from vigilpay.functions.times import millis
from vigilpay.schemas import ALERT
from vigilpay.session import stage

_WINDOW_KEYS = ["user_id", "device_id", "card_id", "merchant_id"]


def evidence(**entries: Column | str) -> Column:
    """Evidence is a map of texts, numbers included."""
    pairs = []
    for name, value in entries.items():
        pairs += [F.lit(name), value.cast("string") if isinstance(value, Column) else F.lit(value)]
    return F.create_map(*pairs)


def _shape(hits: DataFrame, rule: Rule, given: dict[str, Column]) -> DataFrame:
    constant = {
        "rule_id": F.lit(rule.rule_id), "rule_name": F.lit(rule.name),
        "risk_level": F.lit(rule.level), "reason": F.lit(rule.reason),
    }
    given = {**constant, **given}
    if "rule_version" in hits.columns:
        version = F.create_map(F.lit("rule_version"), F.col("rule_version").cast("string"))
        given["evidence"] = F.map_concat(given["evidence"], version)
    return hits.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ALERT.fields]
    )


def event_alerts(hits: DataFrame, rule: Rule, proof: Column) -> DataFrame:
    """Alerts of a rule that fires on one event."""
    ids = ["event_id", "transaction_id", "user_id", "account_id", "card_id", "merchant_id", "device_id"]
    given = {name: F.col(name) for name in ids + ["amount", "event_time"]}
    given |= {
        "alert_id": stable_id(F.lit(rule.rule_id), F.col("event_id")),
        "alert_time": F.col("event_ts"),
        "evidence": proof,
    }
    return _shape(hits, rule, given)


def window_alerts(hits: DataFrame, rule: Rule, key: str, proof: Column) -> DataFrame:
    """Alerts of a rule that fires on a window of one key; only that key is filled."""
    assert key in _WINDOW_KEYS
    start, end = F.col("window_start"), F.col("window_end")
    given = {
        "alert_id": stable_id(
            F.lit(rule.rule_id), F.lit(key), F.col(key),
            millis(start).cast("string"), millis(end).cast("string"),
        ),
        key: F.col(key),
        "window_start": start,
        "window_end": end,
        # event time of a window result: the last millisecond of the window
        "alert_time": end - F.expr("INTERVAL '0.001' SECOND"),
        "evidence": proof,
    }
    return _shape(hits, rule, given)


def alert_event_time() -> Column:
    """Event time of an alert, for windows over alerts."""
    last_milli = F.col("window_end") - F.expr("INTERVAL '0.001' SECOND")
    return F.coalesce(last_milli, F.try_to_timestamp(F.col("event_time")))


def union_alerts(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge by ``alert_id``: a known alert takes only the new evidence and alert time."""
    return _merged(old, latest(new))


def _merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """``upsert`` of new alerts that have one row per id."""
    taken = {"evidence", "alert_time"}
    o, n = old.alias("o"), new.alias("n")
    columns = []
    for name in old.columns:
        a, b = (("n", "o") if name in taken else ("o", "n"))
        whole = F.when(F.col(f"{a}.alert_id").isNotNull(), F.col(f"{a}.{name}")).otherwise(
            F.col(f"{b}.{name}")
        )
        columns.append(whole.alias(name))
    return o.join(n, F.col("o.alert_id") == F.col("n.alert_id"), "full_outer").select(*columns)


#: Alerts of a stored file.
_FILE_ROWS = 250_000


def _by_day(alerts: DataFrame) -> DataFrame:
    """Alerts with the day of their event time, which an update of the alert does not change."""
    day = F.date_format(alert_event_time(), "yyyy-MM-dd")
    return alerts.withColumn("day", F.coalesce(day, F.lit("unknown")))


def merge_into(path: str, new: DataFrame, batch_id: int | None = None) -> None:
    """Merge alerts into the table at ``path`` as ``upsert`` does; a sink for ``foreachBatch`` too.

    The table is partitioned by the day of the alert's event time.  Only days
    that ``new`` touches are read and replaced, in as many files as their rows
    ask for, and a merge that runs again changes nothing.
    """
    spark = new.sparkSession
    merged = stage(_by_day(latest(new)), "merge-new")
    days = {r["day"]: r["n"] for r in merged.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per day
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        # the day is a text also where all of them look like dates
        stored = spark.read.schema(merged.schema).parquet(path).filter(F.col("day").isin(list(days)))
        # written aside first: the partitions read are the partitions replaced
        merged = stage(_by_day(_merged(stored.drop("day"), merged.drop("day"))), "merge-done")
        days = {r["day"]: r["n"] for r in merged.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
    # ranges are of one size, also where one day has nearly all alerts
    files = sum(-(-n // _FILE_ROWS) for n in days.values())
    (
        merged.repartitionByRange(max(1, min(files, 10_000)), "day", F.xxhash64("alert_id")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    )


def latest(alerts: DataFrame) -> DataFrame:
    """One row per ``alert_id``: the one with the newest alert time, of equal ones that with the larger evidence."""
    order = Window.partitionBy("alert_id").orderBy(F.desc("alert_time"), F.desc(F.to_json("evidence")), F.desc("reason"))
    return alerts.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def uniqueness_violations(alerts: DataFrame) -> DataFrame:
    """Window alerts that share rule, keys and window."""
    keys = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in _WINDOW_KEYS]
    return (
        alerts.filter(F.col("window_start").isNotNull())
        .groupBy("rule_id", *keys, "window_start", "window_end")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
