"""Users of keys in windows of the stream: counted from tables, over cuts into micro-batches, repeated ones and silent minutes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.events import event, frame
from tests.test_streaming import read_json
from vigilpay.config import stream_config
from vigilpay.operators import rules, windows
from vigilpay.session import new_dir
from vigilpay.streaming import job, shared, tables


def arrivals(seed):
    """Events that are at most a minute behind, some minutes long silent, users that come back."""
    rng, second, rows = random.Random(seed), 0, []
    for n in range(500):
        second += rng.choice([0, 1, 2, 5, 11]) if n % 90 else 1500
        rows.append(event(n, max(0, second - rng.choice([0, 0, 20, 60])), user_id=f"u{rng.randrange(25)}", device_id=f"d{rng.randrange(3)}", card_id=f"c{rng.randrange(4)}"))
    return rows


@pytest.mark.parametrize("cuts, key", [([500], "device_id"), ([1, 2, 60, 61, 200, 380, 500], "device_id"), ([*range(50, 501, 50)], "card_id")])
def test_windows_of_the_stream_are_those_of_tables(spark, cuts, key):
    rows, path, got = arrivals(len(cuts)), new_dir(spark, "shared"), []
    for batch_id, (a, b) in enumerate(zip([0, *cuts], cuts)):
        batch = frame(spark, rows[a:b]).select(key, "user_id", "event_ts", "arrival_seq").repartition(3)
        for again in range(2):  # each runs again; the first time it ends before its progress is stored
            before, after = shared.add(batch, path, batch_id, key, 10, 60)
            found = shared.closing(spark, path, key, 10, 3, before, after)
            found = [] if found is None else found.collect()
            if again:
                shared.done(spark, path, batch_id, before, after)
        got += found
    newest = max(r["event_ts"] for r in rows).timestamp()
    whole = windows.distinct_user_windows(frame(spark, rows), key, 10, 3).collect()
    expected = [r.asDict() for r in whole if r.window_end.timestamp() <= (newest - 60) // 60 * 60]
    plain = lambda found: sorted((r[key], r["window_start"], r["window_end"], r["distinct_user_count"], r["users"]) for r in found)
    assert plain(r.asDict() for r in got) == plain(expected) and len(expected) > 60
    if len(cuts) > 5:
        # what no open window reaches is gone
        assert len(tables.batch_ids(spark, f"{path}/seen")) < len(cuts) and len(tables.batch_ids(spark, f"{path}/progress")) == 2


@pytest.mark.parametrize("name, rule, key", [("device_users", rules.r003_device_users, "device_id"), ("card_users", rules.r004_card_users, "card_id")])
def test_no_user_of_a_window_is_a_row_of_state(spark, tmp_path, name, rule, key):
    stream = job.RiskStream(spark, stream_config(f"{tmp_path}/out", state_partitions=2))
    rows = [event(i, i, user_id=f"u{i}", **{key: "one"}) for i in range(600)] + [event(600, 7200)]
    events = frame(spark, rows)
    for batch_id, part in enumerate((events.filter("arrival_seq < 300"), events.filter("arrival_seq >= 300"))):
        tables.write_batch(part.withColumn("ingest_ms", F.lit(0).cast("bigint")).select(*job._ON_TIME.names), stream._table("on_time"), batch_id)
        query = stream.start(next(s for s in stream.stages() if s.name == name), every=0)
        try:
            query.processAllAvailable()
            assert [p for p in query.recentProgress if p["numInputRows"]]
            # as state there were ten rows for each of 600 users
            assert sum(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) == 0
        finally:
            query.stop()
    # the last window is open
    closed = {r.alert_id: r.evidence for r in rule(events).collect() if r.window_end.timestamp() <= rows[-1]["event_ts"].timestamp() - 60}
    found = read_json(tmp_path / f"out/alerts/{name}")
    assert {r["alert_id"]: r["evidence"] for r in found} == closed and len(found) == len(closed) == 19
