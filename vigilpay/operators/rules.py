"""The eight fraud rules over on-time events.

Rules that count in windows use panes (see ``windows``).  Rules that follow a
key in arrival order use running windows per key; a key too large for one task
is cut into stretches of the arrival order and carried across them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay import config
from vigilpay.config import RuleConfig
from vigilpay.functions.scores import fixed2, same_text
from vigilpay.operators import scans, windows
from vigilpay.operators.alerts import evidence, event_alerts, union_alerts, window_alerts
from vigilpay.operators.prepare import successful_payments
from vigilpay.session import stage

_START = Window.unboundedPreceding
EVENT_COLUMNS = [
    "event_id", "transaction_id", "account_id", "card_id", "merchant_id", "device_id",
    "amount", "event_time", "event_ts",
]
DEFAULTS = RuleConfig()


def _shown(threshold, places: int = 0):
    """A threshold as evidence: of the configuration, or of the rule version that a row was judged by."""
    if not isinstance(threshold, Column):
        return f"{threshold:.{places}f}" if places else str(threshold)
    return threshold.cast(f"decimal(30,{places})" if places else "bigint").cast("string")


def user_frequency_windows(events: DataFrame) -> DataFrame:
    counted = windows.panes(events, ["user_id"], F.count(F.lit(1)).alias("transaction_count"))
    return windows.add_bounds(counted.withColumnRenamed("pane", "first_pane"), 1)


def r001_user_frequency(events: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    """More than ``user_txn_count`` events of a user in a minute, whatever their status."""
    return frequency_alerts(user_frequency_windows(events), cfg)


def frequency_alerts(counted: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    hits = counted.filter(F.col("transaction_count") > cfg.user_txn_count)
    proof = evidence(
        user_id=F.col("user_id"), transaction_count=F.col("transaction_count"),
        threshold=_shown(cfg.user_txn_count), window="1 minute tumbling event-time window",
    )
    return window_alerts(hits, config.R001, "user_id", proof)


def user_amount_windows(events: DataFrame, above=None) -> DataFrame:
    """Successful amount per user in five minutes; ``above`` drops windows not above it early."""
    paid = windows.panes(successful_payments(events), ["user_id"], F.sum("amount").alias("amount"))
    total = F.sum("amount").alias("total_amount")
    if above is None:
        return windows.slide(paid, ["user_id"], 5, total)
    # Amounts are not negative, so a pane whose neighbourhood stays at or below
    # the threshold can be in no window above it.
    near = paid.withColumn("_near", windows.near_total("amount", "user_id", 5))
    near = near.filter(F.col("_near") > F.lit(above)).drop("_near")
    slid = windows.slide(near, ["user_id"], 5, total, placed=True)
    return slid.filter(F.col("total_amount") > F.lit(above))


def r002_user_amount(events: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    """A user's successful payments in a five-minute window sum to more than ``user_amount``."""
    return amount_alerts(user_amount_windows(events, cfg.user_amount), cfg)


def amount_alerts(summed: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    hits = summed.filter(F.col("total_amount") > F.lit(cfg.user_amount))
    proof = evidence(
        user_id=F.col("user_id"), total_amount=fixed2(F.col("total_amount")),
        threshold=_shown(cfg.user_amount, 2), window="5 minute sliding event-time window",
    )
    return window_alerts(hits, config.R002, "user_id", proof)


def _shared_key(events: DataFrame, rule: config.Rule, key: str, threshold: int) -> DataFrame:
    return shared_key_alerts(windows.distinct_user_windows(events, key, 10, threshold), rule, key, threshold)


def shared_key_alerts(counted: DataFrame, rule: config.Rule, key: str, threshold) -> DataFrame:
    """Alerts of ``windows.distinct_user_windows``."""
    hits = counted.filter(F.col("distinct_user_count") > threshold)
    proof = evidence(
        **{key: F.col(key)}, distinct_user_count=F.col("distinct_user_count"),
        threshold=_shown(threshold), sample_user_ids=F.array_join("users", ","),
        window="10 minute sliding event-time window",
    )
    return window_alerts(hits, rule, key, proof)


def r003_device_users(events: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    """More than ``device_users`` distinct users on one device in ten minutes."""
    return _shared_key(events, config.R003, "device_id", cfg.device_users)


def r004_card_users(events: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    """More than ``card_users`` distinct users on one card in ten minutes."""
    return _shared_key(events, config.R004, "card_id", cfg.card_users)


def _hot(events: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    return scans.hot_keys(events, key) if hot is None else hot


def _positions(rows: DataFrame, ttl_us: int | None) -> DataFrame:
    """Add the place of a row in its stretch and the last place up to it after which a run starts anew.

    A run ends with an event that did not fail, and before a failure that came
    more than ``ttl_us`` after the event before it.
    """
    order = Window.partitionBy("user_id", "_blk").orderBy("arrival_seq")
    rows = rows.withColumn("_pos", F.row_number().over(order))
    ended = F.when(~F.col("failed"), F.col("_pos"))
    if ttl_us is not None:
        rows = rows.withColumn("_gap", scans.gap_above("clock_us", ttl_us, order))
        ended = ended.when(F.col("_gap"), F.col("_pos") - 1)
    return rows.withColumn("_ended", F.max(ended).over(order.rowsBetween(_START, 0)))


def _with_cuts(stretches: DataFrame, ttl_us: int | None) -> DataFrame:
    """Add ``_cut``: whether a stretch of a hot user begins more than ``ttl_us`` after the one before it ended."""
    by_user = Window.partitionBy("user_id").orderBy("_blk")
    if ttl_us is None:
        return stretches.withColumn("_cut", F.lit(False))
    return stretches.withColumn(
        "_cut", F.coalesce(F.col("_first") - F.lag("_last").over(by_user) > F.lit(ttl_us), F.lit(False))
    )


def _clocks(ttl_us: int | None) -> list:
    """When a stretch begins and ends, by arrival."""
    if ttl_us is None:
        return []
    return [F.min_by("clock_us", "arrival_seq").alias("_first"), F.max_by("clock_us", "arrival_seq").alias("_last")]


def _clock_columns(ttl_us: int | None) -> list[str]:
    return [] if ttl_us is None else ["clock_us"]


def failure_runs(
    events: DataFrame, hot: DataFrame | None = None, bits: int = scans.HOT_BLOCK_BITS, ttl_us: int | None = None
) -> DataFrame:
    """Failed events with ``failed_run``: the user's failures in a row up to here, by arrival.

    ``hot`` names the users to split; by default those found in ``events``.
    With ``ttl_us`` a run is forgotten once the user's last failure lies more
    than that many microseconds back by ``clock_us``, a column of ``events``
    that does not fall along a user's arrivals (see ``prepare.arrival_clock``).
    """
    failed = same_text(F.col("transaction_status"), "FAILED")
    # Events that did not fail only end runs; they travel without their columns.
    payload = F.when(failed, F.struct(*EVENT_COLUMNS))
    rows = events.select(
        "user_id", "arrival_seq", failed.alias("failed"), payload.alias("event"), *_clock_columns(ttl_us)
    )
    rows, hot_rows = scans.split_hot(rows, "user_id", _hot(events, "user_id", hot), bits=bits)
    rows = _positions(rows, ttl_us)

    # Hot users only: what each stretch hands on to the next.
    stretches = (
        _positions(hot_rows.drop("event"), ttl_us)
        .groupBy("user_id", "_blk")
        .agg(F.max("_pos").alias("_n"), F.max("_ended").alias("_ended"), *_clocks(ttl_us))
        .withColumn("_carry", F.col("_n") - F.coalesce(F.col("_ended"), F.lit(0)))
        .withColumn("_reset", F.col("_ended").isNotNull())
    )
    carry = scans.segmented_before(_with_cuts(stretches, ttl_us), "user_id", "_blk", "_reset", ["_carry"], "_cut")

    run = F.when(F.col("_ended").isNotNull(), F.col("_pos") - F.col("_ended")).otherwise(
        F.col("_pos") + F.coalesce(F.col("_carry"), F.lit(0))
    )
    return (
        rows.filter("failed")
        .join(carry, ["user_id", "_blk"], "left")
        .select("user_id", "arrival_seq", "event.*", run.cast("bigint").alias("failed_run"))
    )


def r005_consecutive_failure(
    events: DataFrame, cfg: RuleConfig = DEFAULTS, hot: DataFrame | None = None, ttl_us: int | None = None
) -> DataFrame:
    """A user's ``consecutive_failures``-th failure in a row, and every further one."""
    return failure_alerts(failure_runs(events, hot, ttl_us=ttl_us), cfg)


def failure_alerts(runs: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    hits = runs.filter(F.col("failed_run") >= cfg.consecutive_failures)
    proof = evidence(
        user_id=F.col("user_id"), consecutive_failed_count=F.col("failed_run"),
        threshold=_shown(cfg.consecutive_failures),
    )
    return event_alerts(hits, config.R005, proof)


def r006_black_device(events: DataFrame) -> DataFrame:
    """An event whose device is flagged."""
    proof = evidence(device_id=F.col("device_id"), is_black_device="true", source="event_flag")
    return event_alerts(events.filter("is_black_device"), config.R006, proof)


def payment_history(
    events: DataFrame, hot: DataFrame | None = None, bits: int = scans.HOT_BLOCK_BITS, ttl_us: int | None = None
) -> DataFrame:
    """Successful payments with the count and total of the user's earlier ones, by arrival.

    With ``ttl_us`` the history is forgotten at a payment that comes more than
    that many microseconds after the user's payment before it, by ``clock_us``.
    """
    paid = successful_payments(events).select("user_id", "arrival_seq", *EVENT_COLUMNS, *_clock_columns(ttl_us))
    rows, hot_rows = scans.split_hot(paid, "user_id", _hot(events, "user_id", hot), bits=bits)

    def segmented(part: DataFrame) -> DataFrame:
        """Number the histories of a stretch; 0 is the one it may share with the stretch before."""
        if ttl_us is None:
            return part.withColumn("_seg", F.lit(0))
        order = Window.partitionBy("user_id", "_blk").orderBy("arrival_seq")
        gaps = part.withColumn("_gap", scans.gap_above("clock_us", ttl_us, order).cast("int"))
        return gaps.withColumn("_seg", F.sum("_gap").over(order.rowsBetween(_START, 0))).drop("_gap")

    earlier = (
        Window.partitionBy("user_id", "_blk", "_seg").orderBy("arrival_seq").rowsBetween(_START, -1)
    )
    zero = F.lit(0).cast("decimal(28,2)")
    rows = segmented(rows).withColumn("_n", F.count(F.lit(1)).over(earlier)).withColumn(
        "_total", F.coalesce(F.sum("amount").over(earlier), zero)
    )
    # the last history of each stretch is what it hands on
    segments = segmented(hot_rows).groupBy("user_id", "_blk", "_seg").agg(
        F.count(F.lit(1)).alias("_cn"), F.sum("amount").alias("_ct"), *_clocks(ttl_us)
    )
    held = ["_cn", "_ct"] + (["_last"] if ttl_us is not None else [])
    stretches = segments.groupBy("user_id", "_blk").agg(
        (F.max("_seg") > 0).alias("_reset"), *[F.max_by(c, "_seg").alias(c) for c in held],
        *([F.min_by("_first", "_seg").alias("_first")] if ttl_us is not None else []),
    )
    carry = scans.segmented_before(_with_cuts(stretches, ttl_us), "user_id", "_blk", "_reset", ["_cn", "_ct"], "_cut")
    joined = rows.join(carry, ["user_id", "_blk"], "left")
    brought = lambda c, none: F.when(F.col("_seg") == 0, F.coalesce(F.col(c), none)).otherwise(none)
    return joined.withColumn("history_count", F.col("_n") + brought("_cn", F.lit(0))).withColumn(
        "history_total", (F.col("_total") + brought("_ct", zero)).cast("decimal(30,2)")
    ).drop("_blk", "_seg", "_n", "_total", "_cn", "_ct", "clock_us")


def _exceeds_mean(amount: str, count: str, total: str, multiplier) -> F.Column:
    """``amount > multiplier * total / count`` without dividing, exact in decimals."""
    return (F.col(total) > 0) & (
        F.col(amount) * F.col(count) > F.col(total) * F.lit(multiplier)
    )


def r007_user_amount_spike(
    events: DataFrame, cfg: RuleConfig = DEFAULTS, hot: DataFrame | None = None, ttl_us: int | None = None
) -> DataFrame:
    """A payment above ``user_spike_multiplier`` times the user's mean so far."""
    return user_spike_alerts(payment_history(events, hot, ttl_us=ttl_us), cfg)


def user_spike_alerts(history: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    hits = history.filter(
        (F.col("history_count") >= cfg.user_spike_min_samples)
        & _exceeds_mean("amount", "history_count", "history_total", cfg.user_spike_multiplier)
    )
    proof = evidence(
        user_id=F.col("user_id"), current_amount=fixed2(F.col("amount")),
        historical_avg_amount=fixed2(F.col("history_total") / F.col("history_count")),
        history_count=F.col("history_count"), multiplier=_shown(cfg.user_spike_multiplier, 1),
    )
    return event_alerts(hits, config.R007, proof)


def merchant_history(merchant_windows: DataFrame, ttl_us: int | None = None) -> DataFrame:
    """Windows of ``windows.merchant_window_amount`` with count and total of the merchant's earlier ones.

    A merchant has one row per window, so its history is bounded by the time the
    data spans.  With ``ttl_us`` the history is forgotten at a window that ends
    more than that many microseconds after the merchant's window before it.
    """
    by_end = Window.partitionBy("merchant_id").orderBy("window_end")
    keys = ["merchant_id"]
    if ttl_us is not None:
        rows = merchant_windows.withColumn("_end", F.unix_micros("window_end"))
        gap = scans.gap_above("_end", ttl_us, by_end).cast("int")
        merchant_windows = rows.withColumn("_gap", gap).withColumn("_seg", F.sum("_gap").over(by_end.rowsBetween(_START, 0)))
        keys.append("_seg")
    earlier = Window.partitionBy(*keys).orderBy("window_end").rowsBetween(_START, -1)
    total = F.coalesce(F.sum("amount").over(earlier), F.lit(0)).cast("decimal(32,2)")
    return merchant_windows.withColumn("history_count", F.count(F.lit(1)).over(earlier)).withColumn(
        "history_total", total
    ).drop("_end", "_gap", "_seg")


def r008_merchant_spike(merchant_windows: DataFrame, cfg: RuleConfig = DEFAULTS, ttl_us: int | None = None) -> DataFrame:
    """A merchant's window above ``merchant_spike_multiplier`` times its mean window so far."""
    return merchant_spike_alerts(merchant_history(merchant_windows, ttl_us), cfg)


def merchant_spike_alerts(history: DataFrame, cfg: RuleConfig = DEFAULTS) -> DataFrame:
    hits = history.filter(
        (F.col("history_count") >= cfg.merchant_spike_min_windows)
        & _exceeds_mean("amount", "history_count", "history_total", cfg.merchant_spike_multiplier)
    )
    proof = evidence(
        merchant_id=F.col("merchant_id"), current_window_amount=fixed2(F.col("amount")),
        historical_avg_window_amount=fixed2(F.col("history_total") / F.col("history_count")),
        history_window_count=F.col("history_count"),
        multiplier=_shown(cfg.merchant_spike_multiplier, 1),
    )
    return window_alerts(hits, config.R008, "merchant_id", proof)


def risk_alerts(
    events: DataFrame,
    cfg: RuleConfig = DEFAULTS,
    hot_users: DataFrame | None = None,
    merchant_windows: DataFrame | None = None,
) -> DataFrame:
    """All rules over on-time events.  Stage the events first: each rule scans them.

    The users too frequent for one task are worked out once for both rules that
    follow users, and merchant windows can be given if others need them, too.
    """
    if hot_users is None:
        hot_users = stage(scans.hot_keys(events, "user_id"), "hot-users")
    if merchant_windows is None:
        merchant_windows = windows.merchant_window_amount(successful_payments(events))
    return union_alerts(
        r001_user_frequency(events, cfg),
        r002_user_amount(events, cfg),
        r003_device_users(events, cfg),
        r004_card_users(events, cfg),
        r005_consecutive_failure(events, cfg, hot_users),
        r006_black_device(events),
        r007_user_amount_spike(events, cfg, hot_users),
        r008_merchant_spike(merchant_windows, cfg),
    )
