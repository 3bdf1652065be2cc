"""Partitions of state, runs that catch up with queries that have timers, and outputs without rows."""

from __future__ import annotations

import os
import time

from tests.events import as_json, event
from vigilpay import schemas
from vigilpay.config import stream_config
from vigilpay.streaming import tables
from vigilpay.streaming.job import RiskStream, text_source
from tests.test_streaming import read_json

RUN = ["ingest", "route", "consecutive_failure"]


def failures(first, n):
    return "\n".join(as_json(event(first + i, 10 + first + i, user_id="u", transaction_status="FAILED")) for i in range(n))


def job_at(spark, root, **options):
    (root / "source").mkdir()
    return RiskStream(spark, stream_config(f"{root}/out", **options), text_source(spark, f"{root}/source"))


def test_state_has_the_partitions_asked_for(spark, tmp_path):
    job = job_at(spark, tmp_path, state_partitions=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    (tmp_path / "source/part-0.json").write_text(failures(0, 6))
    job.catch_up(RUN + ["user_frequency"])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"
    for name in ("consecutive_failure", "user_frequency"):
        parts = [n for n in os.listdir(tmp_path / f"out/checkpoint/queries/{name}/state/0") if n.isdigit()]
        assert sorted(parts) == ["0", "1", "2"]
    # no micro-batch without input
    log = tmp_path / "out/checkpoint/queries/consecutive_failure/offsets"
    assert [n for n in os.listdir(log) if n.isdigit()] == ["0"]
    assert len(read_json(tmp_path / "out/alerts")) == 2  # the fifth and the sixth failure


def test_a_run_goes_on_after_an_empty_micro_batch_that_was_cut_off(spark, tmp_path):
    job = job_at(spark, tmp_path)
    (tmp_path / "source/part-0.json").write_text(failures(0, 4))
    job.catch_up(RUN[:2])
    log = tmp_path / "out/checkpoint/queries/consecutive_failure"
    # a live query makes micro-batches without input; the last one did not end
    live = job.start(next(s for s in job.stages() if s.name == "consecutive_failure"), every=0)
    end = time.time() + 60
    while not (live.lastProgress and live.lastProgress["batchId"] >= 1) and time.time() < end:
        time.sleep(0.05)
    live.stop()
    last = max(int(n) for n in os.listdir(log / "offsets") if n.isdigit())
    assert last >= 1
    for name in (f"{last}", f".{last}.crc"):
        if (log / "commits" / name).exists():
            (log / "commits" / name).unlink()
    (tmp_path / "source/part-1.json").write_text(failures(4, 2))
    job.catch_up(RUN)
    assert len(read_json(tmp_path / "out/alerts")) == 2


def test_an_output_without_batches_has_no_rows(spark, tmp_path):
    assert tables.read_output(spark, f"{tmp_path}/none", schemas.ALERT_JSON, "json").count() == 0
