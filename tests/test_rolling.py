"""Rolled outputs hold every row once, whoever reads and whatever breaks off."""

import os
import time

import pytest

from vigilpay.streaming import rolling, tables

DAY_MS = 86_400_000


def batch(spark, path, number, fmt="json", rows=3):
    df = spark.range(rows).selectExpr(f"id + {number} * 100 AS n", "CAST(NULL AS STRING) AS note")
    tables.write_batch(df, path, number, fmt)
    return [number * 100 + i for i in range(rows)]


def numbers(spark, path, fmt="json"):
    return sorted(r.n for r in rolling.read_output(spark, path, spark.range(0).selectExpr("id AS n", "'' AS note").schema, fmt).collect())


def now():
    return time.time_ns() // 1_000_000


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_every_row_once_before_during_and_after(spark, tmp_path, fmt):
    path, rows = f"{tmp_path}/out", []
    assert numbers(spark, path, fmt) == [] and rolling.roll(spark, path, fmt, roll_seconds=0) == 0
    for i in (0, 1, 3):  # a batch without rows has no folder
        rows += batch(spark, path, i, fmt)
    half = tmp_path / "out-rolled/_writing-000000000000-000000000003"
    half.mkdir(parents=True)
    (half / f"part-half.{fmt}").write_text("cut off")
    assert numbers(spark, path, fmt) == rows
    assert rolling.roll(spark, path, fmt, roll_seconds=0) == 3
    assert numbers(spark, path, fmt) == rows  # with both copies there
    assert rolling.roll(spark, path, fmt, roll_seconds=0) == 0
    rows += batch(spark, path, 4, fmt)
    assert numbers(spark, path, fmt) == rows
    assert rolling.retire(spark, path) == 0  # not old enough
    assert rolling.retire(spark, path, now_ms=now() + DAY_MS + 60_000) == 3
    assert tables.batch_ids(spark, path) == [4] and numbers(spark, path, fmt) == rows
    assert rolling.roll(spark, path, fmt, roll_seconds=0) == 1
    # the newest batch stays, as its query may run it again and must find it
    assert rolling.retire(spark, path, keep_seconds=0, now_ms=now() + 1000) == 0
    batch(spark, path, 4, fmt)
    assert numbers(spark, path, fmt) == rows
    rolled = sorted(p.name for p in (tmp_path / "out-rolled").iterdir() if not p.name.startswith((".", "_")))
    assert rolled == ["rolled-000000000000-000000000003", "rolled-000000000004-000000000004"]


def test_when_a_roll_is_due(spark, tmp_path):
    path = f"{tmp_path}/out"
    batch(spark, path, 0)
    batch(spark, path, 1)
    last = max(os.stat(f"{path}/{f}").st_mtime_ns // 1_000_000 for f in os.listdir(path))
    assert rolling.roll(spark, path, now_ms=last + 1000) == 0
    assert rolling.roll(spark, path, now_ms=last + 31_000) == 2  # nothing came for 30 seconds
    batch(spark, path, 2)
    at = os.stat(f"{path}/batch-000000000002").st_mtime_ns // 1_000_000
    assert rolling.roll(spark, path, now_ms=at + 119_000, idle_seconds=1000) == 0
    assert rolling.roll(spark, path, now_ms=at + 120_001, idle_seconds=1000) == 1  # two minutes old
    batch(spark, path, 3)
    assert rolling.roll(spark, path, target_bytes=10, now_ms=now()) == 1  # large enough


def test_files_have_about_the_target_size(spark, tmp_path):
    path, rows = f"{tmp_path}/out", []
    for i in range(6):
        rows += batch(spark, path, i, rows=90)
    total = sum(f.stat().st_size for f in (tmp_path / "out").rglob("*.json"))
    assert rolling.roll(spark, path, target_bytes=total // 2 + 1, roll_seconds=0) == 6
    assert len(list((tmp_path / "out-rolled").rglob("part-*"))) <= 2 < len(list((tmp_path / "out").rglob("part-*.json")))
    assert numbers(spark, path) == rows


def test_a_running_stream_reads_every_row_once(spark, tmp_path):
    path, rows, seen = f"{tmp_path}/out", batch(spark, f"{tmp_path}/out", 0), []
    schema = spark.range(0).selectExpr("id AS n", "'' AS note").schema
    query = tables.stream(spark, path, schema, "json").writeStream.option(
        "checkpointLocation", f"{tmp_path}/check").foreachBatch(lambda df, i: seen.extend(r.n for r in df.collect())).start()
    try:
        for i in (1, 2, 3):
            query.processAllAvailable()
            rolling.roll(spark, path, roll_seconds=0)
            rows += batch(spark, path, i)
            rolling.retire(spark, path, keep_seconds=0, now_ms=now() + 1000)
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    assert sorted(seen) == rows and numbers(spark, path) == rows
