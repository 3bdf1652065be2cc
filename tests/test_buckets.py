"""State of many keys that is kept together: the same runs, histories and cooled alerts as key by key."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from tests.test_streaming import FakeState
from vigilpay.streaming import state

TTL = 50


def folds(spark, monkeypatch, build, schema):
    """The function of one key and that of a bucket."""
    frame = spark.createDataFrame([], schema)
    found = []
    kept = lambda self, fold, output, *rest: found.append(fold) or spark.createDataFrame([], output)
    monkeypatch.setattr(type(frame.groupBy()), "applyInPandasWithState", kept)
    build(frame, 0)
    build(frame, 1)
    return found


def run(fold, batches, key, held):
    """Rows that come out when the micro-batches go through one function of a state per ``held(key)``."""
    states, out = {}, []
    for now, batch in batches:
        for group, rows in batch.groupby(batch[key].map(held), sort=False):
            own = states.setdefault(group, FakeState())
            own.now = now
            # in several frames, out of order
            rows = rows.sample(frac=1, random_state=now % 1000)
            out += [part.drop(columns="_code", errors="ignore") for part in fold((group,), iter([rows.iloc[::2], rows.iloc[1::2]] if len(rows) > 1 else [rows]), own)]
    found = pd.concat([o for o in out if len(o)])
    return sorted(map(tuple, found[sorted(found.columns)].itertuples(index=False))), states


def events(seed, most=10**6):
    rng, clock, rows = random.Random(seed), 0, []
    for n in range(400):
        clock += rng.choice([0, 0, 1, 5, TTL, TTL + 1]) if n % 40 else 3 * TTL
        rows.append((rng.choice("aaaabbcd") + str(n // 150 if n % 3 else 0), n, rng.random() < 0.7, rng.randint(0, most), clock))
    table = pd.DataFrame(rows, columns=["user_id", "arrival_seq", "failed", "cents", "clock_ms"])
    return [(i, table.iloc[a:a + 60].reset_index(drop=True)) for i, a in enumerate(range(0, 400, 60))]


SCHEMA = "user_id string, arrival_seq bigint, failed boolean, cents bigint, clock_ms bigint"


# the largest amounts do not fit into 64 bits when they are summed
@pytest.mark.parametrize("seed, most", [(1, 10**6), (2, 10**6), (3, 10**18 - 1)])
def test_a_bucket_gives_what_its_keys_give(spark, monkeypatch, seed, most):
    batches = events(seed, most)
    rules = [
        lambda rows, n: state.failure_runs(rows, 2, TTL, buckets=n),
        lambda rows, n: state.amount_history(rows, "user_id", "arrival_seq", 3, TTL, buckets=n),
    ]
    for build in rules:
        with monkeypatch.context() as patched:
            one, many = folds(spark, patched, build, SCHEMA)
        alone, _ = run(one, batches, "user_id", lambda k: k)
        together, states = run(many, batches, "user_id", lambda k: "all")
        assert alone == together and len(alone) > 20
        # of keys that came long ago nothing is kept
        kept = state._read(states["all"])
        assert {k for k in kept if k.endswith("2")} and not any(b[1]["clock_ms"].min() - v[2] > TTL for v in kept.values() for b in batches[-1:])
        states["all"].hasTimedOut = True
        assert list(many(("all",), iter([]), states["all"])) == [] and not states["all"].exists


def test_rows_near_the_mean_are_left_out(spark, monkeypatch):
    """A payment of exactly the multiple, or above it, comes out; one plainly below does not."""
    with monkeypatch.context() as patched:
        _, many = folds(spark, patched, lambda rows, n: state.amount_history(rows, "user_id", "arrival_seq", 1, TTL, n, 5.0), SCHEMA)
    cents = [100, 500, 1500, 3499, 2**61, 2**62]
    rows = pd.DataFrame({"user_id": "u", "arrival_seq": range(6), "failed": False, "cents": cents, "clock_ms": 0})
    out = pd.concat(many(("all",), iter([rows]), FakeState()))
    assert out["cents"].tolist() == [500, 1500, 2**61, 2**62]
    assert out["history_cents"].tolist() == ["100", "600", "5599", str(5599 + 2**61)]


def test_cooled_alerts_of_a_bucket(spark, monkeypatch):
    rng = random.Random(4)
    batches, n = [], 0
    for i in range(8):
        rows = [(rng.choice("abcde"), i * 40 + rng.randrange(-15, 60), f"a{n + j:04d}", "x") for j in range(30)]
        n += 30
        batches.append((i * 1000, pd.DataFrame(rows, columns=["key", "at", "alert_id", "alert"])))
    with monkeypatch.context() as patched:
        one, many = folds(spark, patched, lambda rows, b: state.cooled(rows, 10, buckets=b), "key string, at bigint, alert_id string, alert string")
    alone, _ = run(one, batches, "key", lambda k: k)
    together, states = run(many, batches, "key", lambda k: "all")
    assert alone == together and len(alone) > 30
    # a key that was silent for a day is no longer held
    later = 8000 + state.COOLDOWN_KEPT_MS
    states["all"].now = later
    out = pd.concat(many(("all",), iter([pd.DataFrame({"key": ["z"], "at": [0], "alert_id": ["b"], "alert": ["x"]})]), states["all"]))
    assert out["key"].tolist() == ["z"] and list(state._read(states["all"])) == ["z"]


def test_the_job_calls_python_for_few_groups(spark, tmp_path, monkeypatch):
    """A key of its own for every event, and yet no more calls than buckets."""
    from tests.events import as_json, event
    from vigilpay.config import stream_config
    from vigilpay.streaming.job import _NO_EMPTY_BATCHES, RiskStream, text_source

    monkeypatch.setattr(state, "BUCKETS", 3)
    (tmp_path / "source").mkdir()
    rows = [event(i, i, user_id=f"u{i % 40}", transaction_status="FAILED") for i in range(240)]
    (tmp_path / "source/part-0.json").write_text("\n".join(as_json(r) for r in rows))
    job = RiskStream(spark, stream_config(f"{tmp_path}/out", state_partitions=2), text_source(spark, f"{tmp_path}/source"))
    job.catch_up(["ingest", "route"])
    query = job.start(next(s for s in job.stages() if s.name == "consecutive_failure"), every=0, settings=_NO_EMPTY_BATCHES)
    try:
        query.processAllAvailable()
        # rows of state, one for every group
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 3
    finally:
        query.stop()
    from tests.test_streaming import read_json

    # six failures of each user, the fifth and the sixth are alerts
    found = read_json(tmp_path / "out/alerts/consecutive_failure")
    assert sorted(r["event_id"] for r in found) == [event(i, 0)["event_id"] for i in range(160, 240)]
