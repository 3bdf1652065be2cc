"""State that is forgotten: gaps on tables, across stretches of hot users, and in the stream; points kept apart."""

import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.events import event, frame
from vigilpay import config
from vigilpay.operators import extensions as ext, prepare, rules, scans, windows
from vigilpay.streaming import state

TTL = 50


def rows_with_clock(seed):
    """Arrivals of a hot user and of others, with pauses below, at and above the time to live."""
    rng, rows, clock = random.Random(seed), [], 0
    for n in sorted(rng.sample(range(600), 260)):
        clock += rng.choice([0, 1, 5, 10, TTL, TTL + 1, 200])
        rows.append(dict(event(
            n, n, user_id=rng.choice(["hot", "hot", "hot", "a", "b"]), amount=f"{rng.randint(0, 900)}.25",
            transaction_status=rng.choice(["FAILED", "FAILED", "FAILED", "SUCCESS", "SUCCESS"]),
        ), clock_us=clock))
    return rows


def plain(rows):
    """Runs and histories by a loop that looks at the time of the last write."""
    runs, history, last, money = {}, {}, {}, {}
    for r in rows:
        user, now = r["user_id"], r["clock_us"]
        if r["transaction_status"] == "FAILED":
            n, written = last.get(user, (0, now))
            n = n if now - written <= TTL else 0
            runs[r["event_id"]] = n + 1
            last[user] = (n + 1, now)
        else:
            last.pop(user, None)
            n, total, written = money.get(user, (0, Decimal(0), now))
            if now - written > TTL:
                n, total = 0, Decimal(0)
            history[r["event_id"]] = (n, total)
            money[user] = (n + 1, total + Decimal(r["amount"]), now)
    return runs, history


def clocked(spark, rows):
    clocks = spark.createDataFrame([(r["event_id"], r["clock_us"]) for r in rows], "event_id string, clock_us bigint")
    return frame(spark, rows).join(clocks, "event_id")


@pytest.mark.parametrize("seed, hot_rows, bits", [(1, 60, 2), (2, 60, 5), (3, 10**6, 20)])
def test_gaps_across_stretches(spark, seed, hot_rows, bits):
    rows = rows_with_clock(seed)
    events = clocked(spark, rows)
    hot = scans.hot_keys(events, "user_id", hot_rows=hot_rows)
    runs, history = plain(rows)
    got = rules.failure_runs(events, hot, bits=bits, ttl_us=TTL).collect()
    assert {r.event_id: r.failed_run for r in got} == runs
    got = rules.payment_history(events, hot, bits=bits, ttl_us=TTL).collect()
    assert {r.event_id: (r.history_count, r.history_total) for r in got} == history


@pytest.mark.parametrize("cuts", [[], [40, 41, 120]])
def test_the_stream_forgets_what_tables_forget(cuts):
    """The folds of the stream over any cut into micro-batches give the plain runs and histories."""
    rows = rows_with_clock(4)
    runs, history = plain(rows)
    for user in ("hot", "a"):
        own = [r for r in rows if r["user_id"] == user]
        table = pd.DataFrame({
            "id": [r["event_id"] for r in own], "failed": [r["transaction_status"] == "FAILED" for r in own],
            "clock": [r["clock_us"] for r in own], "cents": [int(Decimal(r["amount"]) * 100) for r in own],
        })
        found, n, written = {}, 0, 0
        edges = [0, *[c for c in cuts if c < len(table)], len(table)]
        for part in (table.iloc[a:b] for a, b in zip(edges, edges[1:])):
            clock, failed = part["clock"].to_numpy(), part["failed"].to_numpy()
            got = state.fold_failures(failed, clock, n if clock[0] - written <= TTL else 0, TTL)
            n, written = int(got[-1]), int(clock[-1])
            found |= {i: int(x) for i, x, f in zip(part["id"], got, failed) if f}
        assert found == {i: n for i, n in runs.items() if i in set(table["id"])}
        paid, found, count, total, written = table[~table["failed"]], {}, 0, 0, None
        edges = [0, *[c for c in cuts if c < len(paid)], len(paid)]
        for part in (paid.iloc[a:b] for a, b in zip(edges, edges[1:])):
            clock = part["clock"].to_numpy()
            if written is not None and clock[0] - written > TTL:
                count, total = 0, 0
            counts, totals, count, total = state.fold_history(part["cents"].to_numpy(dtype=np.int64), clock, count, total, TTL)
            written = clock[-1]
            found |= {i: (int(c), Decimal(t) / 100) for i, c, t in zip(part["id"], counts, totals)}
        assert found == {i: h for i, h in history.items() if i in set(table["id"])}


def test_merchants_are_forgotten_after_a_gap(spark):
    minute = 60
    rows = [event(i, second, amount="10.00") for i, second in enumerate([0, 10 * minute, 30 * minute, 51 * minute, 60 * minute])]
    sums = windows.panes(frame(spark, rows), ["merchant_id"], F.sum("amount").alias("amount"))
    ends = windows.add_bounds(sums.withColumnRenamed("pane", "first_pane"), 5)
    got = rules.merchant_history(ends, ttl_us=20 * minute * 1_000_000).orderBy("window_end").collect()
    # a gap of exactly the time to live is no gap
    assert [r.history_count for r in got] == [0, 1, 2, 0, 1]
    assert [r.history_total for r in got] == [Decimal(0), Decimal("10.00"), Decimal("20.00"), Decimal(0), Decimal("10.00")]


def test_the_clock_does_not_go_back(spark):
    times = ["2026-05-10T02:00:05Z", "2026-05-10T02:00:01Z", "no time", "2026-05-10T02:00:09Z"]
    rows = [event(i, i, process_time=t) for i, t in enumerate(times)]
    got = prepare.arrival_clock(frame(spark, rows), block_bits=1, group_bits=1).orderBy("arrival_seq").collect()
    first = got[0].clock_us
    assert [r.clock_us - first for r in got] == [0, 0, 0, 4_000_000]


def plain_spaced(points, spacing):
    last, taken = {}, []
    for key, at in sorted(points):
        if key not in last:
            last[key] = at
        elif at >= last[key] + spacing:
            last[key] = at
            taken.append((key, at))
    return taken


@pytest.mark.parametrize("cell_rows", [1 << 16, 3])
def test_points_kept_apart(spark, cell_rows):
    rng, points = random.Random(2), set()
    for k in range(20):
        at = rng.randrange(-50, 50)
        for _ in range(rng.choice([1, 2, 5, 80])):
            at += rng.choice([0, 1, 1, 2, 3, 9, 10, 11, 25])
            points.add((f"k{k}", at))
    got = scans.spaced_after_first(spark.createDataFrame(list(points), "key string, at bigint"), 10, cell_rows)
    assert sorted(map(tuple, got.collect())) == plain_spaced(points, 10)


def test_steps_of_long_chains_shrink_from_round_to_round(spark, monkeypatch):
    staged, stage = [], scans.stage
    monkeypatch.setattr(scans, "stage", lambda df, name: staged.append((name, stage(df, name))) or staged[-1][1])
    # many points in each stretch, and points that are nearly all taken
    points = {("dense", at) for at in range(0, 2560, 2)} | {("sparse", at) for at in range(3, 16003, 12)}
    got = scans.spaced_after_first(spark.createDataFrame(list(points), "key string, at bigint"), 10)
    assert sorted(map(tuple, got.collect())) == plain_spaced(points, 10)
    assert sum(rows.count() for name, rows in staged if name == "jumps") < 2.2 * 1280


def test_points_of_an_empty_table(spark):
    assert scans.spaced_after_first(spark.createDataFrame([], "key string, at bigint"), 10).count() == 0


def test_ids_pass_again_after_a_day(spark):
    hour = 3_600_000_000
    hours = [("a", 0), ("b", 0), ("a", 23), ("a", 24), ("a", 25), ("a", 25), ("a", 48), ("a", 50), ("b", 24)]
    rows = [event(i, i, event_id=name) for i, (name, _) in enumerate(hours)]
    clocks = spark.createDataFrame([(i, h * hour) for i, (_, h) in enumerate(hours)], "arrival_seq bigint, clock_us bigint")
    events = frame(spark, rows).join(clocks, "arrival_seq")
    got = prepare.dedup(events, config.DEDUP_TTL_US).collect()
    # exactly a day later is still remembered; of two at one time the first; 25 h after 25 h
    assert sorted((r.event_id, r.arrival_seq) for r in got) == [("a", 0), ("a", 4), ("a", 7), ("b", 1)]
    late = prepare.flag_late(events, ttl_us=config.DEDUP_TTL_US)
    assert sorted((r.event_id, r.arrival_seq, r.is_late) for r in late.collect()) == [
        ("a", 0, False), ("a", 4, False), ("a", 7, False), ("b", 1, False)
    ]


def test_cooldown_of_one_hot_key(spark):
    rng = random.Random(7)
    seconds = sorted(rng.choice(range(20_000)) for _ in range(400))
    rows = [event(i, s, user_id="hot", is_black_device=True, device_id="d") for i, s in enumerate(seconds)]
    alerts = rules.r006_black_device(frame(spark, rows))
    got = ext.alert_cooldown(alerts, minutes=10).collect()
    ids = {r.event_id: r.alert_id for r in alerts.collect()}
    last, expected = None, set()
    for s, alert in sorted((s, ids[rows[i]["event_id"]]) for i, s in enumerate(seconds)):
        if last is None or s - last >= 600:
            last = s
            expected.add(alert)
    assert {r.alert_id for r in got} == expected and len(got) == len(expected)
