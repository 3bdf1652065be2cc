"""Batches of the tables between streaming queries are read whole, and by all cores."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.events import event, frame
from tests.test_streaming import read_json
from vigilpay.config import stream_config
from vigilpay.plans import catalog
from vigilpay.sources import adapter
from vigilpay.streaming import job, tables

SMALL = "/root/testdata/sf0.001"


def on_time_rows(spark, seconds):
    """Failures of one user at these seconds, in the order of arrival, as the job stores those on time."""
    rows = [event(i, second, user_id="u", transaction_status="FAILED") for i, second in enumerate(seconds)]
    return frame(spark, rows).withColumn("ingest_ms", F.lit(0).cast("bigint")).select(*job._ON_TIME.names)


@pytest.mark.parametrize("stage, out", [("transaction_count", "metrics"), ("consecutive_failure", "alerts")])
def test_a_batch_of_many_files_is_not_cut(spark, tmp_path, stage, out):
    stream = job.RiskStream(spark, stream_config(f"{tmp_path}/out", max_files_per_trigger=1))
    # every file has an early and a late event; user u fails eight times in a row
    rows = on_time_rows(spark, [0, 1800, 1, 1801, 2, 1802, 3, 1803]).withColumn("_f", (F.col("arrival_seq") / 2).cast("int"))
    rows = rows.repartitionByRange(4, "_f").drop("_f")
    tables.write_batch(rows, stream._table("on_time"), 0)
    stream.catch_up([stage])
    found = read_json(tmp_path / f"out/{out}/{stage}")
    if stage == "transaction_count":
        assert [r["count"] for r in found] == [4]  # the second window is open
    else:
        assert sorted(r["event_id"] for r in found) == [event(i, 0)["event_id"] for i in range(4, 8)]


def test_a_micro_batch_has_a_file_for_every_core():
    assert catalog._batch_files(100, 12) == 1
    assert catalog._batch_files(110_000, 12) == 3
    assert catalog._batch_files(660_000, 12) == 12
    # files have an upper size, whatever the number of cores
    assert catalog._batch_files(60_000_000, 12) == 50


def test_raw_lines_in_ranges_are_the_same_lines(spark):
    plain = adapter.raw_lines(spark, SMALL).select("value", "arrival_seq")
    dealt = adapter.raw_lines(spark, SMALL, ranges=5).select("value", "arrival_seq")
    assert plain.exceptAll(dealt).isEmpty() and plain.count() == dealt.count()
    spans = dealt.groupBy(F.spark_partition_id()).agg(F.min("arrival_seq"), F.max("arrival_seq")).collect()
    spans = sorted((low, high) for _, low, high in spans)
    assert len(spans) == 5 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
