"""The six real-time metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vigilpay.functions.ids import stable_id
from vigilpay.functions.scores import same_text
from vigilpay.functions.times import millis
from vigilpay.operators import windows
from vigilpay.operators.alerts import alert_event_time, evidence
from vigilpay.operators.prepare import successful_payments
from vigilpay.schemas import METRIC

TRANSACTION_COUNT = "transaction_count_1m"
TRANSACTION_AMOUNT = "transaction_amount_5m"
CHANNEL_SUCCESS_RATE = "channel_success_rate_5m"
MERCHANT_AMOUNT = "merchant_realtime_amount_5m"
ALERT_COUNT = "risk_alert_count_1m"
HIGH_ALERT_COUNT = "high_risk_alert_count_1m"


def as_metric(
    rows: DataFrame, name: str, value: Column, count: Column, key: str | None = None,
    dimensions: Column | None = None, emit_time: Column | None = None,
) -> DataFrame:
    """Metric rows with an id that is the same on every run, so writes can be repeated.

    The id covers name, key and window; ``emit_time`` defaults to the window's end.
    """
    start, end = F.col("window_start"), F.col("window_end")
    key_part = [F.col(key)] if key else []
    given = {
        "metric_id": stable_id(
            F.lit(name), *key_part, millis(start).cast("string"), millis(end).cast("string")
        ),
        "metric_name": F.lit(name),
        "dimensions": F.create_map() if dimensions is None else dimensions,
        "value": value, "count": count, "window_start": start, "window_end": end,
        "emit_time": end if emit_time is None else emit_time,
    }
    return rows.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in METRIC.fields])


def _per_minute(rows: DataFrame) -> DataFrame:
    counted = windows.panes(rows, [], F.count(F.lit(1)).alias("n"))
    return windows.add_bounds(counted.withColumnRenamed("pane", "first_pane"), 1)


def transaction_count_1m(events: DataFrame) -> DataFrame:
    return as_metric(_per_minute(events), TRANSACTION_COUNT, F.col("n"), F.col("n"))


def transaction_amount_5m(events: DataFrame) -> DataFrame:
    paid = windows.panes(successful_payments(events), [], F.sum("amount").alias("amount"))
    slid = windows.slide(paid, [], 5, F.sum("amount").alias("amount"))
    return as_metric(slid, TRANSACTION_AMOUNT, F.col("amount"), F.lit(0))


def channel_success_rate_5m(events: DataFrame) -> DataFrame:
    success = same_text(F.col("transaction_status"), "SUCCESS")
    counted = windows.panes(
        events, ["channel"], F.count(F.lit(1)).alias("total"), F.count_if(success).alias("success")
    )
    slid = windows.slide(
        counted, ["channel"], 5, F.sum("total").alias("total"), F.sum("success").alias("success")
    )
    dims = evidence(channel=F.col("channel"), success=F.col("success"), total=F.col("total"))
    rate = F.col("success") / F.col("total")
    return as_metric(slid, CHANNEL_SUCCESS_RATE, rate, F.col("total"), "channel", dims)


def merchant_amount_5m(merchant_windows: DataFrame) -> DataFrame:
    """From ``windows.merchant_window_amount``."""
    dims = evidence(merchant_id=F.col("merchant_id"))
    return as_metric(merchant_windows, MERCHANT_AMOUNT, F.col("amount"), F.lit(0), "merchant_id", dims)


def _timed(alerts: DataFrame) -> DataFrame:
    return alerts.select("risk_level", alert_event_time().alias("event_ts"))


def risk_alert_count_1m(alerts: DataFrame) -> DataFrame:
    return as_metric(_per_minute(_timed(alerts)), ALERT_COUNT, F.col("n"), F.col("n"))


def high_risk_alert_count_1m(alerts: DataFrame) -> DataFrame:
    high = _timed(alerts).filter(same_text(F.col("risk_level"), "HIGH"))
    return as_metric(_per_minute(high), HIGH_ALERT_COUNT, F.col("n"), F.col("n"))


def realtime_metrics(
    events: DataFrame, alerts: DataFrame, merchant_windows: DataFrame | None = None
) -> DataFrame:
    if merchant_windows is None:
        merchant_windows = windows.merchant_window_amount(successful_payments(events))
    return reduce(
        DataFrame.unionByName,
        [
            transaction_count_1m(events), transaction_amount_5m(events),
            channel_success_rate_5m(events), merchant_amount_5m(merchant_windows),
            risk_alert_count_1m(alerts), high_risk_alert_count_1m(alerts),
        ],
    )
