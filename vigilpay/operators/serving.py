"""Reports over the output tables.

Reports of the latest minutes or of the largest keys end in ``orderBy().limit()``,
which keeps the k best rows per task and merges those.  Ties are broken by the
key.  Reports over "the last hour" take the present time as ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigilpay.operators import metrics


def per_minute(rows: DataFrame, time: str, count_name: str, limit: int = 60) -> DataFrame:
    """Rows per minute, newest first."""
    minute = F.date_trunc("minute", F.col(time)).alias("minute_bucket")
    return (
        rows.groupBy(minute).agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.desc("minute_bucket")).limit(limit)
    )


def alert_volume_by_minute(alerts: DataFrame) -> DataFrame:
    return per_minute(alerts, "alert_time", "alert_count")


def alerts_by_level_1h(alerts: DataFrame, as_of: Column) -> DataFrame:
    recent = alerts.filter(F.col("alert_time") >= as_of - F.expr("INTERVAL 1 HOUR"))
    return (
        recent.groupBy("risk_level").agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("alert_count"), "risk_level")
    )


def top_users_by_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return (
        alerts.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("alert_count"), F.max("alert_time").alias("last_alert_time"))
        .orderBy(F.desc("alert_count"), "user_id")
        .limit(limit)
    )


def merchant_peak_amount(metric_rows: DataFrame, limit: int = 20) -> DataFrame:
    """Largest window amount per merchant (the published name says latest, the value is the peak)."""
    return (
        metric_rows.filter(F.col("metric_name") == metrics.MERCHANT_AMOUNT)
        .groupBy(F.col("dimensions")["merchant_id"].alias("merchant_id"))
        .agg(F.max("value").alias("latest_5m_amount"), F.max("window_end").alias("last_window_end"))
        .orderBy(F.desc("latest_5m_amount"), "merchant_id")
        .limit(limit)
    )


def channel_success_rate_30m(metric_rows: DataFrame, as_of: Column) -> DataFrame:
    """Mean of the window rates per channel; windows overlap and count equally."""
    recent = metric_rows.filter(
        (F.col("metric_name") == metrics.CHANNEL_SUCCESS_RATE)
        & (F.col("window_end") >= as_of - F.expr("INTERVAL 30 MINUTES"))
    )
    return (
        recent.groupBy(F.col("dimensions")["channel"].alias("channel"))
        .agg(F.avg("value").alias("avg_success_rate"))
        .orderBy("avg_success_rate", "channel")
    )


def late_by_minute(late: DataFrame) -> DataFrame:
    return per_minute(late, "created_at", "late_event_count")


def dead_letter_by_minute(dead: DataFrame) -> DataFrame:
    return per_minute(dead, "created_at", "dead_letter_count")
