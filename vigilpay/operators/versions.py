"""Rules by time: every window and event is judged by the version of its rule that was valid then.

A rule table has a row for each version: ``rule_id``, ``version``, ``threshold``,
``valid_from`` and, if it has such a column, ``enabled``.  A version is valid
until the next one of its rule begins; of several that begin at one time the
largest version counts.  Before its first version a rule finds nothing.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay import config
from vigilpay.config import RuleConfig
from vigilpay.operators import rules, windows
from vigilpay.operators.alerts import union_alerts
from vigilpay.operators.prepare import successful_payments
from vigilpay.session import stage

_JUDGED = ["rule_version", "threshold"]


def validity(rule_table: DataFrame) -> DataFrame:
    """Versions with ``valid_to``, null for the last one of a rule."""
    enabled = F.col("enabled") if "enabled" in rule_table.columns else F.lit(True)
    rows = rule_table.select(
        "rule_id", F.col("version").cast("bigint").alias("rule_version"), F.col("threshold").cast("double").alias("threshold"),
        F.col("valid_from").cast("timestamp").alias("valid_from"), F.coalesce(enabled, F.lit(True)).alias("enabled"),
    )
    one = rows.groupBy("rule_id", "valid_from").agg(F.max(F.struct("rule_version", "threshold", "enabled")).alias("v"))
    until = F.lead("valid_from").over(Window.partitionBy("rule_id").orderBy("valid_from"))
    return one.select("rule_id", "v.*", "valid_from", until.alias("valid_to"))


def judged(rows: DataFrame, at: Column, versions: DataFrame) -> DataFrame:
    """``rows`` with ``rule_version`` and ``threshold`` of the version valid at ``at``; without one, or with a disabled one, left out.

    ``versions`` are those of one rule.  A version that ended is spread over the
    days it was valid on, and rows meet it by day and then by time, so the join
    has an equality and each row at most a day's versions to compare.  The last
    version has no end: it is one row, and goes into the expression.
    """
    last = versions.filter("valid_to IS NULL").first()
    if last is None:
        return rows.withColumns({"rule_version": F.lit(None).cast("bigint"), "threshold": F.lit(None).cast("double")}).limit(0)
    days = F.sequence(F.to_date("valid_from"), F.to_date("valid_to"))
    ended = versions.filter("valid_to IS NOT NULL").select(
        F.explode(days).alias("_day"), "valid_from", "valid_to", F.struct("rule_version", "threshold", "enabled").alias("_past")
    )
    timed = rows.withColumn("_at", at).withColumn("_day", F.to_date("_at"))
    met = (timed["_day"] == ended["_day"]) & (F.col("_at") >= F.col("valid_from")) & (F.col("_at") < F.col("valid_to"))
    found = timed.join(ended, met, "left")
    now = F.struct(
        F.lit(last["rule_version"]).alias("rule_version"), F.lit(last["threshold"]).cast("double").alias("threshold"),
        F.lit(last["enabled"]).alias("enabled"),
    )
    valid = F.when(F.col("_at") >= F.lit(last["valid_from"]), now).otherwise(F.col("_past"))
    picked = found.select(*[timed[c] for c in rows.columns], valid.alias("_valid")).filter("_valid.enabled")
    return picked.select(*rows.columns, "_valid.rule_version", "_valid.threshold")


def alerts_by_version(
    events: DataFrame, rule_table: DataFrame, cfg: RuleConfig = rules.DEFAULTS, hot: DataFrame | None = None,
    merchant_windows: DataFrame | None = None,
) -> DataFrame:
    """Alerts of all eight rules over on-time events, thresholds by time; evidence names the ``rule_version``.

    Windows are judged at their last moment, events at their own time.
    ``cfg`` gives what has no version: how much history the mean rules need.
    Stage the events first: each rule scans them.
    """
    versions = stage(validity(rule_table), "rule-versions")
    least = {r["rule_id"]: r["least"] for r in versions.groupBy("rule_id").agg(F.min("threshold").alias("least")).collect()}  # a row per rule
    end = F.col("window_end") - F.expr("INTERVAL '0.001' SECOND")
    whole, money, ratio = (F.col("threshold").cast(kind) for kind in ("bigint", "decimal(18,2)", "decimal(9,1)"))

    def by_time(rule: config.Rule, rows: DataFrame, at: Column) -> DataFrame:
        return judged(rows, at, versions.filter(F.col("rule_id") == rule.rule_id))

    if merchant_windows is None:
        merchant_windows = windows.merchant_window_amount(successful_payments(events))
    shared = []
    for rule, key in ((config.R003, "device_id"), (config.R004, "card_id")):
        # no version fires below the smallest threshold
        counted = windows.distinct_user_windows(events, key, 10, int(least.get(rule.rule_id) or 0))
        shared.append(rules.shared_key_alerts(by_time(rule, counted, end), rule, key, whole))
    amounts = rules.user_amount_windows(events, least.get("R002") and F.lit(least["R002"]).cast("decimal(18,2)"))
    return union_alerts(
        rules.frequency_alerts(by_time(config.R001, rules.user_frequency_windows(events), end), replace(cfg, user_txn_count=whole)),
        rules.amount_alerts(by_time(config.R002, amounts, end), replace(cfg, user_amount=money)),
        *shared,
        rules.failure_alerts(
            by_time(config.R005, rules.failure_runs(events, hot), F.col("event_ts")), replace(cfg, consecutive_failures=whole)
        ),
        rules.r006_black_device(by_time(config.R006, events, F.col("event_ts"))),
        rules.user_spike_alerts(
            by_time(config.R007, rules.payment_history(events, hot), F.col("event_ts")), replace(cfg, user_spike_multiplier=ratio)
        ),
        rules.merchant_spike_alerts(
            by_time(config.R008, rules.merchant_history(merchant_windows), end), replace(cfg, merchant_spike_multiplier=ratio)
        ),
    )
