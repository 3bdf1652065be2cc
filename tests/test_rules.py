"""Boundaries of each rule: the last row below and the first above."""

import random
from decimal import Decimal

import pytest

from tests.events import event, frame
from vigilpay.operators import prepare, rules, scans, windows


def alerts(spark, rows, rule):
    return rule(frame(spark, rows)).collect()


def test_frequency(spark):
    rows = [event(i, i) for i in range(10)]
    later = [event(20, 60)]  # the next minute
    assert alerts(spark, rows + later, rules.r001_user_frequency) == []
    hit = alerts(spark, rows + [event(11, 59)], rules.r001_user_frequency)
    assert [h.evidence["transaction_count"] for h in hit] == ["11"]


def test_user_amount(spark):
    exact = [event(1, 0, amount="19999.99"), event(2, 10, amount="0.01")]
    failed = [event(3, 20, amount="500.00", transaction_status="FAILED")]
    assert alerts(spark, exact + failed, rules.r002_user_amount) == []
    hit = alerts(spark, exact + [event(4, 30, amount="0.01", transaction_status="success")], rules.r002_user_amount)
    # all in one minute: every one of the five windows that hold it fires
    assert [h.evidence["total_amount"] for h in hit] == ["20000.01"] * 5
    # spread so that only one window sees all
    spread = [event(1, 0, amount="15000.00"), event(2, 240, amount="5000.01")]
    assert len(alerts(spark, spread, rules.r002_user_amount)) == 1
    assert alerts(spark, [event(1, 0, amount="15000.00"), event(2, 300, amount="9000.00")], rules.r002_user_amount) == []


@pytest.mark.parametrize(
    "rule, key, most", [(rules.r003_device_users, "device_id", 5), (rules.r004_card_users, "card_id", 3)]
)
def test_shared_key(spark, rule, key, most):
    rows = [event(i, i, user_id=f"user-{9 - i}", **{key: "shared"}) for i in range(most)]
    again = [event(50, 30, user_id="user-9", **{key: "shared"})]
    assert alerts(spark, rows + again, rule) == []
    hit = alerts(spark, rows + again + [event(60, 40, user_id="user-x", **{key: "shared"})], rule)
    assert len(hit) == 10
    users = ",".join([f"user-{9 - i}" for i in range(most)] + ["user-x"])
    assert {h.evidence["sample_user_ids"] for h in hit} == {users}


def test_consecutive_failure(spark):
    fail = dict(transaction_status="FAILED")
    assert alerts(spark, [event(i, i, **fail) for i in range(4)], rules.r005_consecutive_failure) == []
    broken = [event(i, i, **fail) for i in range(4)] + [event(5, 5, transaction_status="PENDING"), event(6, 6, **fail)]
    assert alerts(spark, broken, rules.r005_consecutive_failure) == []
    hit = alerts(spark, [event(i, i, **fail) for i in range(7)], rules.r005_consecutive_failure)
    assert sorted(h.evidence["consecutive_failed_count"] for h in hit) == ["5", "6", "7"]


def test_black_device(spark):
    rows = [event(1, is_black_card=True), event(2, is_black_device=True)]
    hit = alerts(spark, rows, rules.r006_black_device)
    assert [h.event_id for h in hit] == ["evt-000002"]


def test_user_spike(spark):
    calm = [event(i, i, amount="10.00") for i in range(1, 6)]
    assert alerts(spark, calm[:4] + [event(9, 9, amount="900.00")], rules.r007_user_amount_spike) == []
    assert alerts(spark, calm + [event(9, 9, amount="50.00")], rules.r007_user_amount_spike) == []
    hit = alerts(spark, calm + [event(9, 9, amount="50.01")], rules.r007_user_amount_spike)
    assert [h.evidence["historical_avg_amount"] for h in hit] == ["10.00"]
    # the spike raises the mean for the next payment
    assert len(alerts(spark, calm + [event(9, 9, amount="600.00"), event(10, 10, amount="500.00")], rules.r007_user_amount_spike)) == 1
    zeros = [event(i, i, amount="0.00") for i in range(6)]
    assert alerts(spark, zeros + [event(9, 9, amount="1.00")], rules.r007_user_amount_spike) == []


def merchant(spark, amounts):
    rows = [event(i, 600 * i, amount=a) for i, a in enumerate(amounts)]
    # one window per payment keeps the arithmetic plain
    sums = windows.panes(frame(spark, rows), ["merchant_id"], rules.F.sum("amount").alias("amount"))
    return rules.r008_merchant_spike(windows.add_bounds(sums.withColumnRenamed("pane", "first_pane"), 5)).collect()


def test_merchant_spike(spark):
    assert merchant(spark, ["10.00", "10.00", "90.00"]) == []
    assert merchant(spark, ["10.00"] * 3 + ["30.00"]) == []
    assert len(merchant(spark, ["10.00"] * 3 + ["30.01"])) == 1


def brute(rows):
    """Failure runs and payment history by a plain loop."""
    runs, history, state, money = {}, {}, {}, {}
    for r in sorted(rows, key=lambda r: r["arrival_seq"]):
        user = r["user_id"]
        if r["transaction_status"] == "FAILED":
            state[user] = state.get(user, 0) + 1
            runs[r["event_id"]] = state[user]
        else:
            state[user] = 0
            n, total = money.get(user, (0, Decimal(0)))
            history[r["event_id"]] = (n, total)
            money[user] = (n + 1, total + Decimal(r["amount"]))
    return runs, history


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_users_split_over_blocks(spark, seed):
    rng = random.Random(seed)
    rows = [
        event(n, n, user_id=rng.choice(["hot", "hot", "hot", "a", "b"]), amount=f"{rng.randint(0, 900)}.25",
              transaction_status=rng.choice(["FAILED", "FAILED", "FAILED", "SUCCESS"]))
        for n in rng.sample(range(1000), 300)
    ]
    events = frame(spark, rows)
    hot = scans.hot_keys(events, "user_id", hot_rows=100)
    assert [r.user_id for r in hot.collect()] == ["hot"]
    runs, history = brute(rows)
    # stretches of four arrivals: runs cross many of them
    got = rules.failure_runs(events, hot, bits=2).collect()
    assert {r.event_id: r.failed_run for r in got} == runs
    got = rules.payment_history(events, hot, bits=2).collect()
    assert {r.event_id: (r.history_count, r.history_total) for r in got} == history


@pytest.mark.parametrize("seed", [3, 4])
def test_distinct_users_match_counting(spark, seed):
    rng = random.Random(seed)
    rows = [
        event(n, rng.randint(0, 2400), user_id=f"u{rng.randint(0, 9)}", device_id=f"d{rng.randint(0, 1)}")
        for n in range(120)
    ]
    expected = {}
    for r in rows:
        minute = int(r["event_ts"].timestamp()) // 60
        for start in range(minute - 9, minute + 1):
            firsts = expected.setdefault((r["device_id"], start), {})
            firsts[r["user_id"]] = min(firsts.get(r["user_id"], 10**9), r["arrival_seq"])
    expected = {
        k: (len(v), sorted(v, key=v.get)[:8]) for k, v in expected.items() if len(v) > 3
    }
    got = windows.distinct_user_windows(frame(spark, rows), "device_id", 10, 3).collect()
    assert {
        (r.device_id, int(r.window_start.timestamp()) // 60): (r.distinct_user_count, r.users) for r in got
    } == expected


def test_order_within_watermark_does_not_matter(spark):
    rng = random.Random(5)
    rows = [event(n, n * 3, user_id=f"user-{n % 2}", device_id="d") for n in range(60)]
    # arrivals swapped by at most some seconds, never beyond the watermark
    seqs = sorted(range(60), key=lambda n: n * 3 + rng.uniform(0, 50))
    moved = [{**rows[n], "arrival_seq": i} for i, n in enumerate(seqs)]
    for rule in (rules.r001_user_frequency, rules.r002_user_amount, rules.r003_device_users):
        ids = [
            sorted(a.alert_id for a in rule(prepare.on_time_events(frame(spark, r))).collect())
            for r in (rows, moved)
        ]
        assert ids[0] == ids[1]
