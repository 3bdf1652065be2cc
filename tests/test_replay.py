"""Replayed alerts and metrics equal those of a run in which nothing was late; rules judged by time."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.events import START, event, frame
from vigilpay.config import RuleConfig
from vigilpay.operators import metrics as mt, prepare, replay, rules, scans, versions, windows
from vigilpay.session import stage

CFG = RuleConfig(consecutive_failures=2, user_spike_min_samples=2, merchant_spike_min_windows=1)


def scenario(seed):
    rng = random.Random(seed)
    rows = [
        event(n, n * 7, user_id=rng.choice(["u1", "u1", "u2", "u3"]), merchant_id=rng.choice(["m1", "m2"]),
              device_id=rng.choice(["d1", "d2"]), card_id=rng.choice(["c1", "c2"]), amount=f"{rng.choice([1, 5, 900, 9000])}.50",
              transaction_status=rng.choice(["FAILED", "FAILED", "SUCCESS"]), is_black_device=rng.random() < 0.1,
              channel=rng.choice(["APP", "POS"]))
        for n in range(120)
    ]
    for n in rng.sample(range(10, 110), 14):  # late: far back in time, at their place of arrival
        back = max(0, n * 7 - rng.choice([70, 200, 500]))
        rows[n] = event(n, back, **{k: rows[n][k] for k in (
            "user_id", "merchant_id", "device_id", "card_id", "amount", "transaction_status", "is_black_device", "channel")})
    return rows


def table(df):
    return sorted((tuple(r.asDict().items()) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_a_run_without_late_events(spark, seed):
    every = stage(frame(spark, scenario(seed)), "every")
    flagged = stage(prepare.flag_late(every), "flagged")
    good, late = flagged.filter("NOT is_late").drop("is_late"), flagged.filter("is_late").drop("is_late")
    assert late.count() > 3
    none = scans.hot_keys(every, "user_id", hot_rows=30)  # u1 is split
    amounts = stage(windows.merchant_window_amount(prepare.successful_payments(good)), "amounts")
    before = stage(rules.risk_alerts(good, CFG, none, amounts), "alerts")
    after = stage(replay.replay_alerts(good, late, before, amounts, CFG, none), "after")
    whole = stage(rules.risk_alerts(every, CFG, none), "whole")
    columns = ["alert_id", "rule_id", "event_id", "window_end", "alert_time", "evidence"]
    expected = table(whole.select(*columns))
    assert table(after.select(*columns)) == expected
    assert expected != table(before.select(*columns))
    # some alerts of the rules that follow a key are withdrawn
    gone = before.join(whole, "alert_id", "left_anti").select("rule_id").distinct().collect()
    assert {r.rule_id for r in gone} & {"R005", "R007", "R008"}
    stored = mt.realtime_metrics(good, before, amounts)
    assert table(replay.metric_replay(stored, late, before, after)) == table(mt.realtime_metrics(every, whole))


def test_nothing_late_changes_nothing(spark):
    good = frame(spark, scenario(3)[:10])
    late = good.limit(0)
    amounts = windows.merchant_window_amount(prepare.successful_payments(good))
    before = rules.risk_alerts(good, CFG, merchant_windows=amounts)
    assert table(replay.replay_alerts(good, late, before, amounts, CFG)) == table(before)


def version_table(spark, rows):
    return spark.createDataFrame(
        [(r, v, t, START + s, on) for r, v, t, s, on in rows],
        "rule_id string, version int, threshold double, valid_from timestamp, enabled boolean",
    )


def test_rules_by_time(spark):
    table_ = version_table(spark, [
        ("R005", 1, 3.0, timedelta(seconds=0), True), ("R005", 2, 1.0, timedelta(seconds=10), True), ("R005", 3, 2.0, timedelta(seconds=10), True),
        ("R005", 4, 1.0, timedelta(days=3), False), ("R006", 1, 0.0, timedelta(seconds=20), None), ("R006", 2, 0.0, timedelta(seconds=30), False),
        ("R006", 3, 0.0, timedelta(days=2), True),
    ])
    fail = dict(transaction_status="FAILED")
    rows = [event(i, s, **fail) for i, s in enumerate([0, 1, 5, 9])]  # the first version asks for three
    rows += [event(10 + i, s, user_id="u2", **fail) for i, s in enumerate([10, 11])]  # of two at one time the larger version: two
    rows += [event(30 + i, 86_400 * 3 + i, user_id="u3", **fail) for i in range(4)]  # off
    rows += [event(40 + i, s, user_id=f"b{i}", is_black_device=True) for i, s in enumerate([19, 20, 29.5, 30, 86_400 * 2])]
    got = versions.alerts_by_version(frame(spark, rows), table_).collect()
    found = sorted((r.rule_id, r.event_id, r.evidence["rule_version"], r.evidence.get("threshold")) for r in got)
    assert found == [
        ("R005", "evt-000002", "1", "3"), ("R005", "evt-000003", "1", "3"), ("R005", "evt-000011", "3", "2"),
        ("R006", "evt-000041", "1", None), ("R006", "evt-000042", "1", None), ("R006", "evt-000044", "3", None),
    ]


def test_versions_join_by_day_and_time(spark):
    plan = versions.judged(
        frame(spark, [event(1)]), F.col("event_ts"),
        versions.validity(version_table(spark, [("R001", i, 1.0, timedelta(days=i), True) for i in range(3)])),
    )._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
