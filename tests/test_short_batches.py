"""A micro-batch of ingest and routing is a few jobs, and the settings for that stay with its query."""

from __future__ import annotations

from tests.events import as_json, event
from tests.test_streaming import read_json
from vigilpay import schemas
from vigilpay.config import stream_config
from vigilpay.streaming import job, tables


def jobs_of(spark, stream, name):
    """The number of jobs of a stage that reads what is there, all in one micro-batch."""
    query = stream.start(next(s for s in stream.stages() if s.name == name), every=0)
    try:
        query.processAllAvailable()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId)))
    finally:
        query.stop()


def test_ingest_and_route_take_few_jobs(spark, tmp_path):
    cfg = stream_config(f"{tmp_path}/out", state_partitions=3)
    rows = [event(i, 10 * i) for i in range(40)] + [event(7, 70), event(50, 5)]  # a copy, and a late event
    lines = [as_json(r) for r in rows] + ["{broken"]
    numbered = spark.createDataFrame([(text, n) for n, text in enumerate(lines)], "value string, arrival_seq bigint")
    numbered.coalesce(1).write.parquet(f"{tmp_path}/source")
    stream = job.RiskStream(spark, cfg, job.numbered_source(spark, f"{tmp_path}/source"))
    before = {k: spark.conf.get(k) for k in job._PLANNED_ONCE}
    assert jobs_of(spark, stream, "ingest") <= 6  # 16 when every shuffle was planned by itself
    assert jobs_of(spark, stream, "route") <= 8
    assert {k: spark.conf.get(k) for k in job._PLANNED_ONCE} == before
    # the raw text goes to the dead letters, and only there
    assert [r["raw_event"] for r in read_json(cfg.dead_letter_output)] == ["{broken"]
    assert [r["event_id"] for r in read_json(cfg.late_output)] == ["evt-000050"]
    on_time = tables.read_batch(spark, stream._table("on_time"), 0, job._ON_TIME)
    assert sorted(r.event_id for r in on_time.collect()) == [f"evt-{i:06d}" for i in range(40)]


def test_a_json_batch_without_rows_makes_no_folder(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.TRANSACTION_TEXT).repartition(3)
    tables.write_batch(empty, f"{tmp_path}/late", 0, "json")
    assert tables.batch_ids(spark, f"{tmp_path}/late") == [] and not tables.folder_names(spark, f"{tmp_path}/late")
