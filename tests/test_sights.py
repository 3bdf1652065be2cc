"""Ids let through once in their time to live, over micro-batches, folds and repeated batches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from vigilpay.session import new_dir
from vigilpay.streaming import sights, state, tables

TTL_MS = 1000
SCHEMA = "event_id string, arrival_seq bigint, ingest_ms bigint, text string"


def _greedy(rows):
    seen, passed = {}, []
    for event_id, seq, at, _ in rows:
        if event_id not in seen or at - seen[event_id] > TTL_MS:
            seen[event_id] = at
            passed.append(seq)
    return passed


def test_first_sights_follow_the_rule_over_batches(spark):
    pick, clock, rows = random.Random(5), 0, []
    for seq in range(240):
        # pauses of exactly the time to live, beyond it, and none
        clock += pick.choice([0, 0, 0, 7, 90, 400, 1000]) if seq % 30 else 1001
        rows.append((f"e{pick.randrange(12)}", seq, clock, None if seq % 7 == 0 else f"t{seq}"))
    path, got = new_dir(spark, "sights"), []
    for batch_id in range(8):
        batch = spark.createDataFrame(rows[batch_id * 30:(batch_id + 1) * 30], SCHEMA).repartition(5)
        for _ in range(2):  # each runs again, after it was remembered
            passed = sights.first_sights(batch, path, batch_id, TTL_MS * 1000).orderBy("arrival_seq").collect()
            sights.remember(spark.createDataFrame(passed, SCHEMA), path, batch_id, TTL_MS * 1000, fold_every=3)
        got += passed
    assert [r.arrival_seq for r in got] == _greedy(rows)
    assert [tuple(r) for r in got] == [rows[r.arrival_seq] for r in got]
    # folds of batches 0-2 and 3-5, the older one forgotten as a whole
    assert tables.batch_ids(spark, f"{path}/folded") == [5]
    assert tables.batch_ids(spark, f"{path}/added") == [6, 7]


def test_files_of_a_batch_follow_its_rows_not_the_partitions_of_state(spark):
    path = new_dir(spark, "few-files")
    tables.write_batch(spark.range(0, 100, 1, 50), path, 0, stateful=True)
    tables.write_batch(spark.range(0, 0, 1, 50), path, 1, stateful=True)
    found = tables.read_batch(spark, path, 0)
    assert found.count() == 100 and len(found.inputFiles()) == 1
    assert tables.batch_ids(spark, path) == [0]


def test_packed_columns_come_back_as_they_were(spark):
    rows = spark.createDataFrame(
        [("u", 1, 'a "quoted"\n\\ text', None, True, 2**62), ("u", 2, "", "{}", None, None), ("v", 3, "ü𐍈", "null", False, -1)],
        "user_id string, arrival_seq bigint, a string, b string, c boolean, d bigint",
    ).withColumn("at", F.timestamp_micros(F.col("arrival_seq") + 1_700_000_000_000_001))
    packed, unpacked = state._packed(rows, "user_id", "arrival_seq")
    assert packed.columns == ["user_id", "arrival_seq", "at", "_rest"]
    back = unpacked(packed.withColumn("added", F.lit(1)))
    assert back.columns == [*rows.columns, "added"]
    assert sorted(back.drop("added").collect()) == sorted(rows.collect())
