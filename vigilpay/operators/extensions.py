"""Operators the design documents describe beyond the eight rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay import config
from vigilpay.config import RULE_IDS, RuleConfig
from vigilpay.operators import rules, scans, windows
from vigilpay.operators.alerts import alert_event_time, upsert
from vigilpay.operators.prepare import successful_payments
from vigilpay.functions.times import minute_of
from vigilpay.session import stage

_WINDOW_RULES = [
    # rule, key, window minutes
    (config.R001, "user_id", 1), (config.R002, "user_id", 5),
    (config.R003, "device_id", 10), (config.R004, "card_id", 10),
]


def city_amount_topn_5m(events: DataFrame, n: int = 3) -> DataFrame:
    """The cities with the largest successful amount in every five-minute window."""
    paid = windows.panes(successful_payments(events), ["city"], F.sum("amount").alias("amount"))
    slid = windows.slide(paid, ["city"], 5, F.sum("amount").alias("amount"))
    order = Window.partitionBy("window_start", "window_end").orderBy(F.desc("amount"), "city")
    return slid.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def consecutive_failure_users(alerts: DataFrame) -> DataFrame:
    """Distinct users per minute hit by the failure rule."""
    hits = alerts.filter(F.col("rule_id") == "R005").withColumn("event_ts", alert_event_time())
    counted = windows.panes(hits, [], F.count_distinct("user_id").alias("users"))
    return windows.add_bounds(counted.withColumnRenamed("pane", "first_pane"), 1)


def rules_from_config(rule_table: DataFrame) -> RuleConfig:
    """Thresholds from a table of ``(version, rule_id, threshold)``, newest version per rule.

    ``R007.min_samples`` and ``R008.min_windows`` set how much history those
    rules need.  The result is one number per rule, at most ten rows.
    """
    newest = (
        rule_table.filter(F.col("rule_id").isin([*RULE_IDS, "R007.min_samples", "R008.min_windows"]))
        .groupBy("rule_id")
        .agg(F.max_by("threshold", "version").alias("threshold"), F.max("version").alias("version"))
        .collect()
    )
    thresholds = {r["rule_id"]: r["threshold"] for r in newest}
    return RuleConfig().with_thresholds(thresholds, max((r["version"] for r in newest), default=0))


def blacklist_join(
    events: DataFrame, devices: DataFrame | None = None, cards: DataFrame | None = None
) -> DataFrame:
    """Events on a listed device or card, with the two flags set from the lists.

    The lists are distinct ids.  No broadcast is forced: a short list is
    broadcast by its measured size, a long one is shuffled and a hot device
    split by the runtime skew handling.
    """
    for key, flag, listed in (
        ("device_id", "is_black_device", devices), ("card_id", "is_black_card", cards)
    ):
        if listed is not None:
            known = listed.select(key).distinct().withColumn("_listed", F.lit(True))
            events = events.join(known, key, "left").withColumn(
                flag, F.coalesce(F.col("_listed"), F.col(flag), F.lit(False))
            ).drop("_listed")
    return events.filter(F.col("is_black_device") | F.col("is_black_card"))


def follows_key() -> Column:
    """What an alert's cool-down is kept by: its rule and the key the rule follows."""
    # a window alert fills only the key its rule counts by; event rules follow
    # the user, except the device rule
    key = F.when(F.col("rule_id") == "R006", F.col("device_id")).otherwise(
        F.coalesce("user_id", "device_id", "card_id", "merchant_id")
    )
    return F.concat_ws("|", "rule_id", key)


def alert_cooldown(alerts: DataFrame, minutes: int = 10) -> DataFrame:
    """Alerts that are not within ``minutes`` after an emitted alert of the same rule and key.

    Of alerts of a rule and key at one time, that with the smallest id counts.
    Of the alerts, key, time and id alone are worked on
    (``scans.spaced_after_first``), and a key with any share of all alerts is
    spread over all tasks.
    """
    timed = alerts.select(follows_key().alias("key"), F.unix_micros("alert_time").alias("at"), "alert_id")
    points = stage(timed.groupBy("key", "at").agg(F.min("alert_id").alias("alert_id")), "alert-times")
    first = points.groupBy("key").agg(F.min(F.struct("at", "alert_id"))["alert_id"].alias("alert_id")).select("alert_id")
    again = scans.spaced_after_first(points.select("key", "at"), minutes * 60_000_000)
    emitted = first.unionByName(again.join(points, ["key", "at"]).select("alert_id"))
    return alerts.join(emitted, "alert_id", "left_semi")


def feature_stream(alerts: DataFrame) -> DataFrame:
    """Hits per user and rule, as features."""
    return (
        alerts.filter(F.col("user_id").isNotNull())
        .groupBy("user_id").pivot("rule_id", RULE_IDS).agg(F.count(F.lit(1)))
        .fillna(0, RULE_IDS)
    )


def merchant_amount_two_stage(events: DataFrame, salts: int = 32) -> DataFrame:
    """Merchant window amounts with hot merchants spread over ``salts`` first."""
    paid = successful_payments(events).withColumn(
        "_salt", F.pmod(F.xxhash64("event_id"), F.lit(salts))
    )
    salted = windows.panes(paid, ["merchant_id", "_salt"], F.sum("amount").alias("amount"))
    merged = salted.groupBy("merchant_id", "pane").agg(F.sum("amount").alias("amount"))
    return windows.slide(merged, ["merchant_id"], 5, F.sum("amount").alias("amount"))


def _affected(late: DataFrame, key: str, minutes: int) -> DataFrame:
    """First panes of the windows that hold a late event, per key."""
    pane = minute_of(F.col("event_ts"))
    return (
        late.select(key, F.explode(F.sequence(pane - (minutes - 1), pane)).alias("first_pane"))
        .distinct()
    )


def _recompute(
    on_time: DataFrame, late: DataFrame, rule: config.Rule, key: str, minutes: int, cfg: RuleConfig
) -> DataFrame:
    affected = _affected(late, key, minutes)
    panes = affected.select(
        key, F.explode(F.sequence(F.col("first_pane"), F.col("first_pane") + (minutes - 1))).alias("_pane")
    ).distinct()
    base = (
        on_time.withColumn("_pane", minute_of(F.col("event_ts")))
        .join(panes, [key, "_pane"], "left_semi")
        .drop("_pane")
    )
    rule_of = {
        "R001": rules.r001_user_frequency, "R002": rules.r002_user_amount,
        "R003": rules.r003_device_users, "R004": rules.r004_card_users,
    }[rule.rule_id]
    fired = rule_of(base.unionByName(late), cfg)
    # windows beside the affected ones saw only part of their events
    first = F.floor(F.unix_seconds("window_start") / 60)
    return fired.withColumn("first_pane", first).join(
        affected, [key, "first_pane"], "left_semi"
    ).drop("first_pane").select(*fired.columns)


def late_replay(
    on_time: DataFrame, late: DataFrame, alerts: DataFrame, cfg: RuleConfig = rules.DEFAULTS
) -> DataFrame:
    """Alerts after late events are counted in: only windows they touch are computed again."""
    parts = [_recompute(on_time, late, *spec, cfg) for spec in _WINDOW_RULES]
    changed = parts[0]
    for part in parts[1:]:
        changed = changed.unionByName(part)
    return upsert(alerts, changed)
