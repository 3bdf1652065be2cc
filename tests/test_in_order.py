"""Sorted files are written by tasks that sort a bounded number of rows, and rows of a part of them stay where they are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilpay import schemas
from vigilpay.sources import files


def test_ranges_in_order_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(files, "_SORTED_ROWS", 100)
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).cast("string").alias("a"), F.col("id").alias("b"))
    done = files.in_order(rows, "a", "b").withColumn("part", F.spark_partition_id()).collect()
    assert [(r.a, r.b) for r in done] == sorted((r.a, r.b) for r in rows.collect())
    sizes = [sum(r.part == p for r in done) for p in {r.part for r in done}]
    assert len(sizes) >= 25 and max(sizes) <= 200


def test_rows_of_a_part_do_not_move(spark, tmp_path):
    rows = spark.range(500).select(*[F.format_string("%04d", "id").alias(n) for n in schemas.AML_ROW.names])
    files.write_aml_csv(files.in_order(rows, "record_key"), f"{tmp_path}/csv")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        part = files.read_aml_csv(spark, f"{tmp_path}/csv", skip=100, limit=50)
        assert sorted(r.record_key for r in part.collect()) == [f"{i:04d}" for i in range(100, 150)]
        # the table of files and splits is still put together by a join of its own
        assert "BroadcastHashJoin [_file" in part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
