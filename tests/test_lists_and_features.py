"""Lists by time, user features that count each micro-batch once, and the fold of the streaming cool-down."""

import random
from datetime import timedelta

import pandas as pd

from tests.events import START, event, frame
from tests.test_streaming import FakeState, fold_of
from vigilpay.operators import lists
from vigilpay.streaming import features, state

CHANGES = "list string, id string, listed boolean, at timestamp"


def at(seconds):
    return START + timedelta(seconds=seconds)


def test_intervals(spark):
    rows = [
        ("device", "a", True, at(0)), ("device", "a", True, at(5)), ("device", "a", False, at(10)), ("device", "a", True, at(20)),
        ("device", "b", False, at(3)), ("device", "b", True, at(4)), ("device", "b", False, at(4)),  # a removal counts
        ("card", "a", True, at(1)), ("device", None, True, at(1)), ("device", "c", True, None),
    ]
    got = lists.intervals(spark.createDataFrame(rows, CHANGES)).collect()
    zone = lambda t: None if t is None else t.replace(tzinfo=None)
    assert sorted((r["list"], r.id, r.valid_from, r.valid_to is None) for r in got) == [
        ("card", "a", zone(at(1)), True), ("device", "a", zone(at(0)), False), ("device", "a", zone(at(20)), True),
    ]


def test_listed_at_equals_the_last_change(spark):
    rng = random.Random(4)
    changes = [
        (rng.choice(["device", "card"]), f"x{rng.randrange(6)}", rng.random() < 0.5, at(rng.randrange(0, 400_000, 1000))) for _ in range(60)
    ]
    rows = [event(i, rng.randrange(400_000), device_id=f"x{rng.randrange(7)}", card_id=f"x{rng.randrange(7)}", is_black_card=i % 17 == 0) for i in range(150)]

    def was(name, key, when):
        known = [(t, listed) for n, i, listed, t in changes if n == name and i == key and t <= when]
        return bool(known) and min(listed for t, listed in known if t == max(k[0] for k in known))

    expected = {
        r["event_id"]: (was("device", r["device_id"], r["event_ts"]), was("card", r["card_id"], r["event_ts"]) or r["is_black_card"]) for r in rows
    }
    got = lists.listed_at(frame(spark, rows), spark.createDataFrame(changes, CHANGES)).collect()
    assert len(got) == len(rows)
    assert {r.event_id: (r.is_black_device, r.is_black_card) for r in got} == expected
    assert got[0].asDict().keys() == rows[0].keys()


def test_features_count_a_batch_once(spark, tmp_path):
    path = f"{tmp_path}/features"
    batch = lambda *rows: spark.createDataFrame(list(rows), "user_id string, rule_id string")
    batches = [batch(("u", "R001"), ("u", "R001"), ("v", "R005")), batch((None, "R003")), batch(("u", "R005")), batch(("v", "R005")), batch(("w", "R007"))]
    for i, rows in enumerate(batches):
        for _ in range(2):  # each micro-batch runs twice
            features.add(rows, path, i, fold_every=2)
    features.add(batches[0], path, 0, fold_every=2)  # long folded
    got = sorted(map(tuple, features.counts(spark, path).collect()))
    assert got == [("u", "R001", 2), ("u", "R005", 1), ("v", "R005", 2), ("w", "R007", 1)]
    # what the fold before the last holds is gone
    kept = sorted(p.name for p in (tmp_path / "features/added").iterdir() if p.name.startswith("batch"))
    assert kept == ["batch-000000000002", "batch-000000000003", "batch-000000000004"]
    wide = {r.user_id: r.asDict() for r in features.features(spark, path).collect()}
    assert wide["u"]["R001"] == 2 and wide["u"]["R008"] == 0


def test_cooldown_fold(spark):
    fold = fold_of(lambda rows: state.cooled(rows, 10), spark, "key string, at long, alert_id string, alert string")
    given = FakeState()
    run = lambda *times: [
        a for part in fold(("k",), iter([pd.DataFrame({"at": times, "alert_id": [f"a{t}" for t in times]})]), given) for a in part["at"]
    ]
    assert run(12, 5, 9, 15, 24, 25) == [5, 15, 25]
    assert run(34, 30) == [] and run(35, 44, 45) == [35, 45]
    # older than the last one by a period or more: it counts, and does not move the last one back
    assert run(20, 40) == [20] and run(54) == [] and run(55) == [55]
    given.hasTimedOut = True
    assert list(fold(("k",), iter([]), given)) == [] and not given.exists
