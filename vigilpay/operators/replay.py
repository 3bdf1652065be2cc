"""Replay of late events: alerts and metrics as if none had been late.

Nothing is computed again that a late event cannot have changed.  Window rules
take the windows that hold one (``extensions.late_replay``).  A run of failures
is taken up at the last event before the late ones that ended a run, and left at
the first one after them.  Histories of payments and of merchant windows start
at the first late one from the sums of what lies before.  Alerts found there
replace the old ones, which may be withdrawn, and metrics take differences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vigilpay.config import RuleConfig
from vigilpay.functions.scores import same_text
from vigilpay.operators import metrics as mt, rules, windows
from vigilpay.operators.alerts import alert_event_time, evidence, union_alerts
from vigilpay.operators.extensions import late_replay
from vigilpay.operators.prepare import successful_payments
from vigilpay.session import stage

DEFAULTS = rules.DEFAULTS


def _without(alerts: DataFrame, rule_id: str, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``alerts`` without those of a rule whose ``keys`` are among ``gone``."""
    own = alerts.filter(F.col("rule_id") == rule_id).join(gone.select(*keys).distinct(), keys, "left_anti")
    return alerts.filter(F.col("rule_id") != rule_id).unionByName(own.select(*alerts.columns))


def failure_stretch(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """On-time and late events of each user with late ones, from one end of a run before them to the next after them.

    Outside of it no run changes.
    """
    ended = ~same_text(F.col("transaction_status"), "FAILED")
    seq = F.col("arrival_seq")
    spans = late.groupBy("user_id").agg(F.min("arrival_seq").alias("_from"), F.max("arrival_seq").alias("_to"))
    near = on_time.join(spans, "user_id")
    edges = near.groupBy("user_id").agg(
        F.max(F.when(ended & (seq < F.col("_from")), seq)).alias("_after"),
        F.min(F.when(ended & (seq > F.col("_to")), seq)).alias("_before"),
    )
    inside = (F.col("_after").isNull() | (seq > F.col("_after"))) & (F.col("_before").isNull() | (seq < F.col("_before")))
    return on_time.join(edges, "user_id").filter(inside).select(*late.columns).unionByName(late)


def replay_failures(
    on_time: DataFrame, late: DataFrame, alerts: DataFrame, cfg: RuleConfig = DEFAULTS, hot: DataFrame | None = None
) -> DataFrame:
    """Alerts with those of the failure rule as if no event had been late."""
    stretch = stage(failure_stretch(on_time, late), "replay-failures")
    found = rules.r005_consecutive_failure(stretch, cfg, hot)
    return _without(alerts, "R005", stretch, ["event_id"]).unionByName(found)


def replay_payments(
    on_time: DataFrame, late: DataFrame, alerts: DataFrame, cfg: RuleConfig = DEFAULTS, hot: DataFrame | None = None
) -> DataFrame:
    """Alerts with those of the payment rule as if no event had been late."""
    paid, behind = successful_payments(on_time), successful_payments(late)
    starts = behind.groupBy("user_id").agg(F.min("arrival_seq").alias("_from"))
    near = paid.join(starts, "user_id")
    before = near.filter(F.col("arrival_seq") < F.col("_from")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_total")
    )
    onward = near.filter(F.col("arrival_seq") > F.col("_from")).select(*late.columns).unionByName(behind)
    onward = stage(onward, "replay-payments")
    history = rules.payment_history(onward, hot).join(before, "user_id", "left")
    history = history.withColumn("history_count", F.col("history_count") + F.coalesce("_n", F.lit(0))).withColumn(
        "history_total", (F.col("history_total") + F.coalesce("_total", F.lit(0))).cast("decimal(30,2)")
    )
    return _without(alerts, "R007", onward, ["event_id"]).unionByName(rules.user_spike_alerts(history, cfg))


def replay_merchants(
    merchant_windows: DataFrame, late: DataFrame, alerts: DataFrame, cfg: RuleConfig = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Merchant windows, and alerts with those of the merchant rule, as if no event had been late.

    A window that changes, or that only late events make, is part of all later
    means of its merchant.
    """
    bounds = ["merchant_id", "window_start", "window_end"]
    more = stage(windows.merchant_window_amount(successful_payments(late)), "replay-windows")
    starts = more.groupBy("merchant_id").agg(F.min("window_end").alias("_from"))
    known = merchant_windows.join(starts, "merchant_id", "left")
    onward = known.filter(F.col("window_end") >= F.col("_from")).select(*bounds, "amount").unionByName(more.select(*bounds, "amount"))
    onward = stage(onward.groupBy(*bounds).agg(F.sum("amount").alias("amount")), "replay-merchants")
    untouched = known.filter(F.col("_from").isNull() | (F.col("window_end") < F.col("_from")))
    before = untouched.filter(F.col("_from").isNotNull()).groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_total")
    )
    history = rules.merchant_history(onward).join(before, "merchant_id", "left")
    history = history.withColumn("history_count", F.col("history_count") + F.coalesce("_n", F.lit(0))).withColumn(
        "history_total", (F.col("history_total") + F.coalesce("_total", F.lit(0))).cast("decimal(32,2)")
    )
    changed = _without(alerts, "R008", onward, bounds).unionByName(rules.merchant_spike_alerts(history, cfg))
    return untouched.select(*bounds, "amount").unionByName(onward), changed


def replay_alerts(
    on_time: DataFrame, late: DataFrame, alerts: DataFrame, merchant_windows: DataFrame,
    cfg: RuleConfig = DEFAULTS, hot: DataFrame | None = None,
) -> DataFrame:
    """The alerts of all rules as if no event had been late.  Stage the inputs first: each rule reads them."""
    windowed = ["R001", "R002", "R003", "R004"]
    counted = late_replay(on_time, late, alerts.filter(F.col("rule_id").isin(windowed)), cfg)
    follow = alerts.filter(F.col("rule_id").isin(["R005", "R007"]))
    follow = replay_failures(on_time, late, follow, cfg, hot)
    follow = replay_payments(on_time, late, follow, cfg, hot)
    _, spikes = replay_merchants(merchant_windows, late, alerts.filter("rule_id = 'R008'"), cfg)
    black = alerts.filter("rule_id = 'R006'").unionByName(rules.r006_black_device(late))
    return union_alerts(counted.select(*alerts.columns), follow, spikes, black)


_ADDED = ["_value", "_count", "_success", "_total"]


def _summands(rows: DataFrame) -> DataFrame:
    """Metric rows with what adds up in them; amounts are exact, as they have two places."""
    text = lambda name: F.col("dimensions")[name].cast("bigint")
    return rows.withColumns({
        "_value": F.col("value").cast("decimal(28,2)"), "_count": F.col("count"),
        "_success": F.coalesce(text("success"), F.lit(0)), "_total": F.coalesce(text("total"), F.lit(0)),
    })


def _alert_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Alert counts to add: one for each new alert, minus one for each withdrawn one."""
    def signed(rows: DataFrame, others: DataFrame, sign: int) -> DataFrame:
        return rows.join(others.select("alert_id"), "alert_id", "left_anti").select(
            "risk_level", alert_event_time().alias("event_ts"), F.lit(sign).cast("bigint").alias("n")
        )

    changes = signed(after, before, 1).unionByName(signed(before, after, -1))
    n = F.sum("n").alias("n")

    def counted(rows: DataFrame, name: str) -> DataFrame:
        minutes = windows.add_bounds(windows.panes(rows, [], n).withColumnRenamed("pane", "first_pane"), 1)
        return mt.as_metric(minutes, name, F.col("n"), F.col("n"))

    high = changes.filter(same_text(F.col("risk_level"), "HIGH"))
    return counted(changes, mt.ALERT_COUNT).unionByName(counted(high, mt.HIGH_ALERT_COUNT))


def metric_replay(metrics: DataFrame, late: DataFrame, alerts_before: DataFrame, alerts_after: DataFrame) -> DataFrame:
    """The six metrics as if no event had been late, from the stored ones and what late events add.

    Late events become metrics of their own panes and windows, new and withdrawn
    alerts signed counts; metrics of one id are summed.  A count that falls to
    nothing is withdrawn.  Metrics without a difference are passed on as they are.
    """
    amounts = windows.merchant_window_amount(successful_payments(late))
    more = stage(reduce(DataFrame.unionByName, [
        mt.transaction_count_1m(late), mt.transaction_amount_5m(late), mt.channel_success_rate_5m(late),
        mt.merchant_amount_5m(amounts), _alert_differences(alerts_before, alerts_after),
    ]), "metric-differences")
    touched = more.select("metric_id").distinct()
    both = _summands(metrics.join(touched, "metric_id", "left_semi").unionByName(more.select(*metrics.columns)))
    same = ["metric_name", "window_start", "window_end", "emit_time", "dimensions"]
    summed = both.groupBy("metric_id").agg(*[F.any_value(c).alias(c) for c in same], *[F.sum(c).alias(c) for c in _ADDED])
    is_rate = F.col("metric_name") == mt.CHANNEL_SUCCESS_RATE
    counts = F.col("metric_name").isin(mt.TRANSACTION_COUNT, mt.ALERT_COUNT, mt.HIGH_ALERT_COUNT)
    dims = evidence(channel=F.col("dimensions")["channel"], success=F.col("_success"), total=F.col("_total"))
    value = F.when(is_rate, F.col("_success") / F.col("_total")).otherwise(F.col("_value").cast("double"))
    changed = summed.filter(~(counts & (F.col("_count") == 0))).withColumns({
        "dimensions": F.when(is_rate, dims).otherwise(F.col("dimensions")), "value": value, "count": F.col("_count"),
    })
    kept = metrics.join(touched, "metric_id", "left_anti").select(*metrics.columns)
    return kept.unionByName(changed.select(*metrics.columns))
